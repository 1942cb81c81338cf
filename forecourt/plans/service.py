"""Service views at appointment grain; repair orders join one to one by appointment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import ADVISOR_ROLE
from forecourt.functions.keys import date_key
from forecourt.functions.numeric import CENTS, one_if, percent, ratio, total, whole
from forecourt.plans.sales import calendar_attributes, dealership_attributes, full_name

GROUPED = {
    "vw_monthly_service_performance": ("calendar_year", "month_number", "month_name"),
    "vw_service_type_performance": ("service_key", "service_type", "service_category"),
    "vw_dealership_service_performance": (
        "dealership_key", "dealership_id", "dealership_name", "region", "state",
    ),
}
TERMINAL = ("Completed", "Cancelled", "No Show")
MONEY_COLUMNS = ("labor_revenue", "parts_revenue", "discount_amount", "service_revenue")
# Kept next to the view columns for the semantic model; not part of the view.
MODEL_ONLY = ("order_status", "vehicle_type", "vehicle_model_year")


def visit_counts(status: Column) -> list[Column]:
    return [
        F.lit(1).cast("smallint").alias("appointment_count"),
        one_if(status == "Completed").alias("completed_appointment_count"),
        one_if(status == "Cancelled").alias("cancellation_count"),
        one_if(status == "No Show").alias("no_show_count"),
        one_if(status.isin(*TERMINAL)).alias("completion_eligible_count"),
    ]


def amounts() -> dict[str, Column]:
    """Amounts of a repair order, 0 without one; costs are not known."""
    return {
        **{c: F.coalesce(F.col(c), F.lit(0)).cast(CENTS) for c in MONEY_COLUMNS},
        "service_cost": F.lit(None).cast(CENTS), "service_profit": F.lit(None).cast(CENTS), "service_cost_available": F.lit(False),
    }


def build_detail(w) -> DataFrame:
    """One row per staged appointment that resolves its customer, vehicle, dealership, advisor and service."""
    visits = w.table("service_appointments").select(
        "appointment_id", "customer_id", "vehicle_id", "dealership_id", "service_advisor_id",
        F.col("appointment_date").cast("date").alias("appointment_date"),
        "appointment_time", "service_type", "appointment_status",
    )
    orders = w.table("fact_service").select(
        "appointment_id", "service_fact_key", "service_order_id", "repair_order_quantity", "technician_key",
        "payer_type", "opened_at", "promised_at", "completed_at", "completed_on_time", "turnaround_hours",
        "order_status", *MONEY_COLUMNS,
    )
    customers = w.table("dim_customer").where("is_current").select("customer_id", "customer_key")
    vehicles = w.table("dim_vehicle").select(
        "vehicle_id", "vehicle_key", "vin",
        F.col("make").alias("vehicle_brand"), F.col("model").alias("vehicle_model"),
        F.col("body_type").alias("vehicle_type"), F.col("model_year").alias("vehicle_model_year"),
    )
    staff = w.table("dim_employee")
    advisors = staff.where((F.col("role") == ADVISOR_ROLE) & F.col("is_current")).select(
        F.col("employee_id").alias("service_advisor_id"), "dealership_key",
        F.col("employee_key").alias("service_advisor_key"), full_name().alias("service_advisor_name"),
    )
    technicians = staff.select(
        F.col("employee_key").alias("technician_key"),
        F.col("employee_id").alias("technician_id"), full_name().alias("technician_name"),
    )
    services = w.table("dim_service").select("service_type", "service_key", "service_category")
    status = F.col("appointment_status")

    # Orders first: both sides are bucketed by appointment, so this join needs no shuffle.
    return (
        visits.join(orders, "appointment_id", "left")
        .join(calendar_attributes(w, "appointment_date_key", "appointment_date"), "appointment_date")
        .join(dealership_attributes(w), "dealership_id")
        .join(advisors, ["service_advisor_id", "dealership_key"])
        .join(services, "service_type")
        .join(technicians, "technician_key", "left")
        .join(customers, "customer_id")
        .join(vehicles, "vehicle_id")
        .select(
            "appointment_id", date_key("appointment_date").alias("appointment_date_key"), "appointment_date",
            "calendar_year", "quarter_number", "month_number", "month_name", "appointment_time",
            "customer_key", "customer_id", "vehicle_key", "vehicle_id", "vin", "vehicle_brand", "vehicle_model",
            "dealership_key", "dealership_id", "dealership_name", "region", "state",
            "service_advisor_key", "service_advisor_id", "service_advisor_name",
            "service_key", "service_type", "service_category", "appointment_status",
            *visit_counts(status),
            "service_fact_key", "service_order_id", "repair_order_quantity",
            "technician_key", "technician_id", "technician_name", "payer_type",
            "opened_at", "promised_at", "completed_at", "completed_on_time", "turnaround_hours",
            *[column.alias(name) for name, column in amounts().items()],
            *MODEL_ONLY,
        )
    )


def wide_detail(w) -> DataFrame:
    return w.table("service_detail")


def detail(w) -> DataFrame:
    return wide_detail(w).drop(*MODEL_ONLY)


def service_block(cost_flag: bool = False) -> list[Column]:
    """The measures shared by the service aggregates; empty input gives NULL sums."""
    orders = F.count("service_order_id")
    block = [
        whole("appointment_count").alias("appointments"),
        whole("completed_appointment_count").alias("completed_appointments"),
        whole("cancellation_count").alias("cancellations"),
        whole("no_show_count").alias("no_shows"),
        percent(F.sum("completed_appointment_count"), F.sum("completion_eligible_count"))
        .alias("completion_rate_percent"),
        orders.alias("repair_orders"),
        *_money_totals(),
    ]
    if cost_flag:
        block.append(F.bool_and("service_cost_available").alias("service_cost_available"))
    return block + [
        ratio(F.sum("service_revenue"), orders).alias("average_repair_order"),
        F.count(F.lit(1)).alias("detail_row_count"),
        F.count_distinct("appointment_id").alias("distinct_appointment_count"),
    ]


def _money_totals() -> list[Column]:
    return [total(c).alias(c) for c in ("service_revenue", "service_cost", "service_profit")]


def kpis(w) -> DataFrame:
    return detail(w).agg(*service_block(cost_flag=True))


def grouped(w, view: str) -> DataFrame:
    extra = [F.min("appointment_date").alias("month_start_date")] if view.startswith("vw_monthly") else []
    return detail(w).groupBy(*GROUPED[view]).agg(*extra, *service_block())


def monthly(w) -> DataFrame:
    """By appointment month; ``month_start_date`` is the first appointment seen in the month."""
    return grouped(w, "vw_monthly_service_performance")


def service_types(w) -> DataFrame:
    return grouped(w, "vw_service_type_performance")


def dealerships(w) -> DataFrame:
    return grouped(w, "vw_dealership_service_performance")


def technicians(w) -> DataFrame:
    """Technician by dealership over appointments that have a repair order."""
    orders = F.count("service_order_id")
    return (
        detail(w).where(F.col("service_order_id").isNotNull())
        .groupBy("technician_key", "technician_id", "technician_name",
                 "dealership_key", "dealership_id", "dealership_name")
        .agg(
            orders.alias("repair_orders"),
            *_money_totals(),
            ratio(F.sum("service_revenue"), orders).alias("average_repair_order"),
            ratio(F.sum("turnaround_hours"), F.count("turnaround_hours")).alias("average_turnaround_hours"),
            percent(F.count_if("completed_on_time"), orders).alias("on_time_completion_rate_percent"),
            F.count(F.lit(1)).alias("detail_row_count"),
            F.count_distinct("service_order_id").alias("distinct_service_order_count"),
        )
    )

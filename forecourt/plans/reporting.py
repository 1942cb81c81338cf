"""Business-facing views: projections of the details, and the dealership scorecard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.functions.numeric import TOTAL, percent, ratio, total, whole
from forecourt.plans import customer, inventory, sales, service
from forecourt.plans.inventory import stock_block

# Output columns of the reporting views, in order.
SALES_COLUMNS = (
    "sale_id", "sale_date", "sale_year", "sale_quarter", "sale_month_number", "sale_month_name",
    "customer_key", "vehicle_id", "vin", "brand", "model", "model_year", "vehicle_type", "fuel_type",
    "vehicle_condition", "dealership_id", "dealership_name", "region", "state", "salesperson_id",
    "salesperson_name", "sales_channel", "payment_type", "sale_status", "units_sold", "list_price",
    "discount_amount", "revenue", "vehicle_cost", "gross_profit", "gross_margin_percent",
    "average_selling_price",
)
INVENTORY_COLUMNS = (
    "inventory_id", "snapshot_date", "vehicle_id", "vin", "brand", "model", "model_year", "vehicle_type",
    "fuel_type", "vehicle_condition", "dealership_id", "dealership_name", "region", "state",
    "acquired_date", "inventory_status", "inventory_units", "inventory_value", "days_in_inventory",
    "aging_bucket", "aging_bucket_sort", "is_slow_moving",
)
SERVICE_COLUMNS = (
    "appointment_id", "appointment_date", "appointment_year", "appointment_quarter",
    "appointment_month_number", "appointment_month_name", "appointment_time", "customer_key", "vehicle_id",
    "vin", "vehicle_brand", "vehicle_model", "dealership_id", "dealership_name", "region", "state",
    "service_advisor_id", "service_advisor_name", "service_type", "service_category", "appointment_status",
    "appointment_count", "completed_appointment_count", "cancellation_count", "no_show_count",
    "completion_eligible_count", "service_order_id", "technician_id", "technician_name", "payer_type",
    "completed_on_time", "turnaround_hours", "labor_revenue", "parts_revenue", "discount_amount",
    "service_revenue", "service_cost", "service_profit", "service_cost_available",
)
CUSTOMER_HIDDEN = ("customer_key", "email", "phone")
CALENDAR_NAMES = {"calendar_year": "year", "quarter_number": "quarter",
                  "month_number": "month_number", "month_name": "month_name"}


def sales_performance(w) -> DataFrame:
    """One row per recognised sale with its own margin and price."""
    renamed = sales.detail(w).withColumnsRenamed({k: f"sale_{v}" for k, v in CALENDAR_NAMES.items()})
    return renamed.withColumns({
        "gross_margin_percent": percent(F.col("gross_profit"), F.col("revenue")),
        "average_selling_price": ratio(F.col("revenue"), F.col("units_sold")),
    }).select(*SALES_COLUMNS)


def inventory_aging(w) -> DataFrame:
    return inventory.detail(w).select(*INVENTORY_COLUMNS)


def service_performance(w) -> DataFrame:
    names = {k: f"appointment_{v}" for k, v in CALENDAR_NAMES.items()}
    return service.detail(w).withColumnsRenamed(names).select(*SERVICE_COLUMNS)


def customer_value(w) -> DataFrame:
    return customer.detail(w).drop(*CUSTOMER_HIDDEN)


def _scorecard_parts(w) -> list[DataFrame]:
    """Four independent per-dealership aggregates; facts are never joined to facts."""
    sold, stock, visits = sales.detail(w), inventory.detail(w), service.detail(w)
    latest = stock.agg(F.max("snapshot_date_key").alias("k")).scalar()
    by_sales = sold.groupBy("dealership_key").agg(
        whole("units_sold").alias("units_sold"),
        total("revenue").alias("sales_revenue"),
        total("gross_profit").alias("sales_gross_profit"),
        F.count(F.lit(1)).alias("sales_fact_rows"),
    )
    by_stock = stock.where(F.col("snapshot_date_key") == latest).groupBy("dealership_key").agg(
        F.max("snapshot_date").alias("inventory_snapshot_date"),
        *stock_block()[:5],
    ).withColumnRenamed("average_age_days", "average_inventory_age_days")
    by_service = visits.groupBy("dealership_key").agg(
        whole("appointment_count").alias("appointments"),
        whole("completed_appointment_count").alias("completed_appointments"),
        whole("cancellation_count").alias("cancellations"),
        whole("no_show_count").alias("no_shows"),
        whole("completion_eligible_count").alias("eligible_appointments"),
        F.count("service_order_id").alias("repair_orders"),
        total("service_revenue").alias("service_revenue"),
        F.count(F.lit(1)).alias("service_detail_rows"),
    )
    # Distinct on each side first: hot customers and dealerships collapse before the union shuffles.
    pair = ("dealership_key", "customer_key")
    by_customer = (
        sold.select(*pair).distinct().union(visits.select(*pair).distinct()).distinct()
        .groupBy("dealership_key").agg(F.count(F.lit(1)).alias("unique_customers"))
    )
    return [by_sales, by_stock, by_service, by_customer]


def dealership_performance(w) -> DataFrame:
    """Scorecard per current dealership; counts and money default to 0, ratios and age stay NULL."""
    card = w.table("dim_dealership").where("is_current")
    for part in _scorecard_parts(w):
        card = card.join(part, "dealership_key", "left")

    def count_of(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias(name)

    def money_of(name: str):
        return F.coalesce(F.col(name), F.lit(0)).cast(TOTAL).alias(name)

    return card.select(
        "dealership_id", "dealership_name", "city", "state", "postal_code", "region",
        count_of("units_sold"), money_of("sales_revenue"), money_of("sales_gross_profit"),
        percent(F.col("sales_gross_profit"), F.col("sales_revenue")).alias("sales_gross_margin_percent"),
        ratio(F.col("sales_revenue"), F.col("units_sold")).alias("average_selling_price"),
        count_of("sales_fact_rows"),
        "inventory_snapshot_date", count_of("inventory_units"), money_of("inventory_value"),
        "average_inventory_age_days", count_of("slow_moving_units"), money_of("slow_moving_value"),
        *[count_of(c) for c in ("appointments", "completed_appointments", "cancellations", "no_shows")],
        percent(F.col("completed_appointments"), F.col("eligible_appointments"))
        .alias("service_completion_rate_percent"),
        count_of("repair_orders"), money_of("service_revenue"),
        ratio(F.col("service_revenue"), F.col("repair_orders")).alias("average_repair_order"),
        count_of("service_detail_rows"), count_of("unique_customers"),
        (F.coalesce(F.col("sales_revenue"), F.lit(0)) + F.coalesce(F.col("service_revenue"), F.lit(0)))
        .cast(TOTAL).alias("total_revenue"),
    )

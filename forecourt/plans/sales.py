"""Sales views. Returns are signed once, in the detail; nothing downstream signs again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import RECOGNISED_SALES
from forecourt.functions.numeric import CENTS, percent, ratio, total, total_or_zero, whole, whole_or_zero

GROUPED = {
    "vw_monthly_sales": ("calendar_year", "month_number", "month_name"),
    "vw_brand_model_performance": ("brand", "model", "model_year"),
    "vw_salesperson_performance": (
        "salesperson_key", "salesperson_id", "salesperson_name",
        "dealership_key", "dealership_id", "dealership_name",
    ),
    "vw_sales_dealership_performance": (
        "dealership_key", "dealership_id", "dealership_name", "region", "state",
    ),
    "vw_vehicle_type_performance": ("vehicle_type", "vehicle_condition", "fuel_type"),
    "vw_payment_method_performance": ("payment_type",),
}


def vehicle_attributes(w) -> DataFrame:
    return w.table("dim_vehicle").select(
        "vehicle_key", "vehicle_id", "vin",
        F.col("make").alias("brand"), "model", "model_year",
        F.col("body_type").alias("vehicle_type"), "fuel_type", "vehicle_condition",
    )


def dealership_attributes(w) -> DataFrame:
    return w.table("dim_dealership").select(
        "dealership_key", "dealership_id", "dealership_name", "region", "state"
    )


def calendar_attributes(w, key: str, day: str) -> DataFrame:
    return w.table("dim_date").select(
        F.col("date_key").alias(key), F.col("full_date").alias(day),
        "calendar_year", "quarter_number", "month_number", "month_name",
    )


def full_name() -> Column:
    return F.concat("first_name", F.lit(" "), "last_name")


def signed_amounts() -> dict[str, Column]:
    """Amounts of a fact row that count against a return."""
    return {name: (F.col(of) * F.col("unit_quantity")).cast(CENTS)
            for name, of in (("revenue", "sale_price"), ("vehicle_cost", "vehicle_cost"), ("gross_profit", "gross_profit"))}


def build_detail(w) -> DataFrame:
    """One row per completed or returned sale."""
    sellers = w.table("dim_employee").select(
        F.col("employee_key").alias("salesperson_key"),
        F.col("employee_id").alias("salesperson_id"),
        full_name().alias("salesperson_name"),
    )

    return (
        w.table("fact_sales").where(F.col("sale_status").isin(*RECOGNISED_SALES))
        .join(calendar_attributes(w, "sale_date_key", "sale_date"), "sale_date_key")
        .join(dealership_attributes(w), "dealership_key")
        .join(sellers, "salesperson_key")
        .join(vehicle_attributes(w), "vehicle_key")
        .select(
            "sales_key", "sale_id", "sale_date_key", "sale_date",
            "calendar_year", "quarter_number", "month_number", "month_name",
            "customer_key", "vehicle_key", "vehicle_id", "vin", "brand", "model", "model_year",
            "vehicle_type", "fuel_type", "vehicle_condition",
            "dealership_key", "dealership_id", "dealership_name", "region", "state",
            "salesperson_key", "salesperson_id", "salesperson_name",
            "sales_channel", "payment_type", "sale_status",
            F.col("unit_quantity").alias("units_sold"),
            "list_price", "discount_amount",
            *[amount.alias(name) for name, amount in signed_amounts().items()],
        )
    )


def detail(w) -> DataFrame:
    return w.table("sales_detail")


def _ratios() -> list[Column]:
    revenue, units = F.sum("revenue"), F.sum("units_sold")
    return [
        percent(F.sum("gross_profit"), revenue).alias("gross_margin_percent"),
        ratio(revenue, units).alias("average_selling_price"),
        F.count(F.lit(1)).alias("fact_row_count"),
        F.count_distinct("sale_id").alias("distinct_sale_count"),
    ]


def sales_block() -> list[Column]:
    """The measures shared by every grouped sales view."""
    return [
        whole("units_sold").alias("units_sold"),
        total("revenue").alias("revenue"),
        total("gross_profit").alias("gross_profit"),
        *_ratios(),
    ]


def kpis(w) -> DataFrame:
    """One row; totals are 0, ratios NULL, when there are no sales."""
    return detail(w).agg(
        whole_or_zero("units_sold").alias("units_sold"),
        total_or_zero("revenue").alias("revenue"),
        total_or_zero("gross_profit").alias("gross_profit"),
        *_ratios(),
    )


def grouped(w, view: str) -> DataFrame:
    keys = GROUPED[view]
    extra = [F.min("sale_date").alias("month_start_date")] if view == "vw_monthly_sales" else []
    return detail(w).groupBy(*keys).agg(*extra, *sales_block())


def monthly(w) -> DataFrame:
    """By calendar month; ``month_start_date`` is the first sale seen in the month."""
    return grouped(w, "vw_monthly_sales")


def brand_models(w) -> DataFrame:
    return grouped(w, "vw_brand_model_performance")


def salespeople(w) -> DataFrame:
    return grouped(w, "vw_salesperson_performance")


def dealerships(w) -> DataFrame:
    return grouped(w, "vw_sales_dealership_performance")


def vehicle_types(w) -> DataFrame:
    return grouped(w, "vw_vehicle_type_performance")


def payment_methods(w) -> DataFrame:
    return grouped(w, "vw_payment_method_performance")

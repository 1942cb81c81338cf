"""Inventory views. Every aggregate keeps the snapshot date: stock is never summed across snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import AGING_BUCKETS, OPEN_BUCKET, SLOW_DAYS
from forecourt.functions.numeric import TOTAL, ratio, total, whole
from forecourt.plans.sales import dealership_attributes, vehicle_attributes

SNAPSHOT = ("snapshot_date_key", "snapshot_date")
GROUPED = {
    "vw_inventory_aging_buckets": (*SNAPSHOT, "aging_bucket", "aging_bucket_sort"),
    "vw_brand_model_inventory": (*SNAPSHOT, "brand", "model", "model_year"),
    "vw_dealership_inventory": (
        *SNAPSHOT, "dealership_key", "dealership_id", "dealership_name", "region", "state",
    ),
}
SLOW_COLUMNS = (
    "inventory_key", "inventory_id", *SNAPSHOT, "vehicle_key", "vehicle_id", "vin", "brand", "model",
    "model_year", "vehicle_type", "fuel_type", "vehicle_condition", "dealership_key", "dealership_id",
    "dealership_name", "region", "state", "acquired_date", "inventory_status", "inventory_units",
    "inventory_value", "days_in_inventory", "aging_bucket", "aging_bucket_sort",
)


def aging(days: Column, labels: bool = True) -> Column:
    """Bucket label or sort order; anything outside the closed ranges is the open bucket."""
    result = F.lit(OPEN_BUCKET if labels else len(AGING_BUCKETS) + 1)
    for order, (label, low, high) in reversed(list(enumerate(AGING_BUCKETS, start=1))):
        result = F.when(days.between(low, high), label if labels else order).otherwise(result)
    return result


def derived() -> dict[str, Column]:
    """What the age of a stock row says."""
    days = F.col("days_in_inventory")
    return {"aging_bucket": aging(days), "aging_bucket_sort": aging(days, labels=False), "is_slow_moving": days > SLOW_DAYS}


def build_detail(w) -> DataFrame:
    """One row per vehicle, dealership and snapshot."""
    calendar = w.table("dim_date").select(
        F.col("date_key").alias("snapshot_date_key"), F.col("full_date").alias("snapshot_date")
    )
    return (
        w.table("fact_inventory")
        .join(calendar, "snapshot_date_key")
        .join(dealership_attributes(w), "dealership_key")
        .join(vehicle_attributes(w), "vehicle_key")
        .select(
            "inventory_key", "inventory_id", *SNAPSHOT,
            "vehicle_key", "vehicle_id", "vin", "brand", "model", "model_year",
            "vehicle_type", "fuel_type", "vehicle_condition",
            "dealership_key", "dealership_id", "dealership_name", "region", "state",
            "acquired_date", "inventory_status",
            F.col("on_hand_quantity").alias("inventory_units"),
            F.col("carrying_cost").alias("inventory_value"),
            "days_in_inventory",
            *[column.alias(name) for name, column in derived().items()],
        )
    )


def detail(w) -> DataFrame:
    return w.table("inventory_detail")


def stock_days() -> Column:
    return F.sum(F.col("days_in_inventory").cast("bigint") * F.col("inventory_units"))


def stock_block(slow: bool = True, days: bool = False) -> list[Column]:
    """The measures shared by the inventory aggregates."""

    def slow_only(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("is_slow_moving"), F.col(name))), F.lit(0))

    block = [whole("inventory_units").alias("inventory_units"), total("inventory_value").alias("inventory_value")]
    if days:
        block.append(stock_days().alias("total_inventory_days"))
    block.append(ratio(stock_days(), F.sum("inventory_units")).alias("average_age_days"))
    if slow:
        block += [
            slow_only("inventory_units").cast("bigint").alias("slow_moving_units"),
            slow_only("inventory_value").cast(TOTAL).alias("slow_moving_value"),
        ]
    return block + [
        F.count(F.lit(1)).alias("fact_row_count"),
        F.count_distinct("inventory_key").alias("distinct_inventory_count"),
    ]


def kpis(w) -> DataFrame:
    return detail(w).groupBy(*SNAPSHOT).agg(*stock_block(days=True))


def grouped(w, view: str) -> DataFrame:
    return detail(w).groupBy(*GROUPED[view]).agg(*stock_block(slow=view != "vw_inventory_aging_buckets"))


def aging_buckets(w) -> DataFrame:
    return grouped(w, "vw_inventory_aging_buckets")


def brand_models(w) -> DataFrame:
    return grouped(w, "vw_brand_model_inventory")


def dealerships(w) -> DataFrame:
    return grouped(w, "vw_dealership_inventory")


def slow_moving(w) -> DataFrame:
    return detail(w).where(F.col("days_in_inventory") > SLOW_DAYS).select(*SLOW_COLUMNS)

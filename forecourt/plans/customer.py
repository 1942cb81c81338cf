"""Customer views: facts are reduced to one row per customer before any join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import CLV_METHOD, INACTIVE_DAYS, RECOGNISED_SALES
from forecourt.functions.keys import key_date
from forecourt.functions.numeric import TOTAL, percent, ratio, whole

FREQUENCY_ORDER = ("No Service", "One-time Service", "Occasional Service", "Frequent Service", "Loyal Service")


def sales_by_customer(w) -> DataFrame:
    """Completed count and dates; signed units and revenue over completed and returned sales."""
    completed = F.col("sale_status") == "Completed"
    completed_day = F.when(completed, F.col("sale_date_key"))
    return (
        w.table("fact_sales").where(F.col("sale_status").isin(*RECOGNISED_SALES))
        .groupBy("customer_key")
        .agg(
            F.count_if(completed).alias("sales_transaction_count"),
            whole("unit_quantity").alias("net_units_purchased"),
            F.sum(F.col("sale_price") * F.col("unit_quantity")).cast(TOTAL).alias("sales_revenue"),
            key_date(F.min(completed_day)).alias("first_sale_date"),
            key_date(F.max(completed_day)).alias("last_sale_date"),
        )
    )


def service_by_customer(w) -> DataFrame:
    day = F.col("completed_at").cast("date")
    return (
        w.table("fact_service").where(F.col("order_status") == "Completed")
        .groupBy("customer_key")
        .agg(
            F.count(F.lit(1)).alias("service_order_count"),
            F.sum("service_revenue").cast(TOTAL).alias("service_revenue"),
            F.min(day).alias("first_service_date"),
            F.max(day).alias("last_service_date"),
        )
    )


def as_of_bounds(w) -> tuple[DataFrame, DataFrame]:
    """Last recognised sale and last completed order, as two one-row frames."""
    sold = w.table("fact_sales").where(F.col("sale_status").isin(*RECOGNISED_SALES))
    served = w.table("fact_service").where(F.col("order_status") == "Completed")
    return (
        sold.agg(key_date(F.max("sale_date_key")).alias("d")),
        served.agg(F.max(F.col("completed_at").cast("date")).alias("d")),
    )


def as_of_date(w) -> Column:
    """Scalar: the latest activity in the warehouse, today when there is none."""
    sold, served = as_of_bounds(w)
    return F.coalesce(F.greatest(sold.scalar(), served.scalar()), F.current_date())


def as_of(w) -> DataFrame:
    """The reporting date as a one-row frame."""
    sold, served = as_of_bounds(w)
    return sold.unionByName(served).agg(F.coalesce(F.max("d"), F.current_date()).alias("as_of_date"))


def relationship(sales: Column, orders: Column) -> Column:
    return (
        F.when((sales > 0) & (orders > 0), "Sales + Service")
        .when(sales > 0, "Sales Only")
        .when(orders > 0, "Service Only")
        .otherwise("No Activity")
    )


def lifecycle(interactions: Column) -> Column:
    return (
        F.when(interactions == 0, "Prospect")
        .when(interactions == 1, "New Customer")
        .otherwise("Repeat Customer")
    )


def activity(last: Column, today: Column) -> Column:
    return (
        F.when(last.isNull(), "Never Active")
        .when(last < F.date_sub(today, INACTIVE_DAYS), "Inactive")
        .otherwise("Active")
    )


def frequency(orders: Column) -> Column:
    return (
        F.when(orders == 0, FREQUENCY_ORDER[0])
        .when(orders == 1, FREQUENCY_ORDER[1])
        .when(orders <= 3, FREQUENCY_ORDER[2])
        .when(orders <= 6, FREQUENCY_ORDER[3])
        .otherwise(FREQUENCY_ORDER[4])
    )


def _orders_per_year(orders: Column, first: Column, today: Column) -> Column:
    """orders / max(1, days / 365.25), written over hundredths of a day to stay in exact decimals."""
    days = (F.datediff(today, F.coalesce(first, today)) + 1).cast("decimal(12,2)")
    year = F.lit("365.25").cast("decimal(12,2)")
    return ratio(orders.cast("decimal(14,2)") * year, F.greatest(year, days))


def build_detail(w) -> DataFrame:
    """One row per current customer."""
    zero = F.lit(0)
    sales, orders = F.col("sales_transaction_count"), F.col("service_order_count")
    joined = (
        w.table("dim_customer").where("is_current")
        .join(sales_by_customer(w), "customer_key", "left")
        .join(service_by_customer(w), "customer_key", "left")
        .withColumns({
            "as_of_date": as_of_date(w),
            "sales_transaction_count": F.coalesce(sales, zero),
            "net_units_purchased": F.coalesce(F.col("net_units_purchased"), zero),
            "sales_revenue": F.coalesce(F.col("sales_revenue"), zero).cast(TOTAL),
            "service_order_count": F.coalesce(orders, zero),
            "service_revenue": F.coalesce(F.col("service_revenue"), zero).cast(TOTAL),
        })
        .withColumns({
            "qualifying_interaction_count": sales + orders,
            "first_activity_date": F.least("first_sale_date", "first_service_date"),
            "last_activity_date": F.greatest("last_sale_date", "last_service_date"),
            "customer_revenue": (F.col("sales_revenue") + F.col("service_revenue")).cast(TOTAL),
        })
    )
    span = F.datediff("last_service_date", "first_service_date")
    return joined.select(
        "customer_key", "customer_id", F.concat("first_name", F.lit(" "), "last_name").alias("customer_name"),
        "email", "phone", "city", "state", "postal_code", "customer_type", "customer_since_date", "as_of_date",
        "sales_transaction_count", "net_units_purchased", "sales_revenue", "first_sale_date", "last_sale_date",
        "service_order_count", "service_revenue", "first_service_date", "last_service_date",
        "qualifying_interaction_count", "first_activity_date", "last_activity_date",
        "customer_revenue", F.col("customer_revenue").alias("customer_lifetime_value"),
        F.lit(CLV_METHOD).alias("clv_method"),
        relationship(sales, orders).alias("relationship_segment"),
        lifecycle(F.col("qualifying_interaction_count")).alias("lifecycle_segment"),
        activity(F.col("last_activity_date"), F.col("as_of_date")).alias("activity_segment"),
        frequency(orders).alias("service_frequency_segment"),
        _orders_per_year(orders, F.col("first_service_date"), F.col("as_of_date"))
        .alias("service_frequency_per_year"),
        F.when(orders > 1, ratio(span, orders - 1)).alias("average_days_between_services"),
    )


def detail(w) -> DataFrame:
    return w.table("customer_detail")


def _mean(name: str) -> Column:
    """Average of an already rounded column, to 2 decimals, over its non-null rows."""
    return ratio(F.sum(name), F.count(name))


def _wide_total(name: str) -> Column:
    return F.sum(name).cast(TOTAL)


def kpis(w) -> DataFrame:
    active = F.col("qualifying_interaction_count") > 0
    repeat = F.col("lifecycle_segment") == "Repeat Customer"

    def segment(column: str, value: str, alias: str) -> Column:
        return F.count_if(F.col(column) == value).alias(alias)

    return detail(w).agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(active).alias("active_lifetime_customers"),
        segment("lifecycle_segment", "New Customer", "new_customers"),
        F.count_if(repeat).alias("repeat_customers"),
        percent(F.count_if(repeat), F.count_if(active)).alias("repeat_rate_percent"),
        segment("relationship_segment", "Sales Only", "sales_only_customers"),
        segment("relationship_segment", "Service Only", "service_only_customers"),
        segment("relationship_segment", "Sales + Service", "sales_and_service_customers"),
        segment("activity_segment", "Inactive", "inactive_customers"),
        segment("activity_segment", "Never Active", "never_active_customers"),
        _wide_total("sales_revenue").alias("sales_revenue"),
        _wide_total("service_revenue").alias("service_revenue"),
        _wide_total("customer_revenue").alias("customer_revenue"),
        _wide_total("customer_lifetime_value").alias("total_customer_lifetime_value"),
        _mean("customer_lifetime_value").alias("average_customer_lifetime_value"),
        whole("service_order_count").alias("service_orders"),
        _mean("service_frequency_per_year").alias("average_service_frequency_per_year"),
        F.count_distinct("customer_key").alias("distinct_customer_count"),
    )


def segment_summary(w) -> DataFrame:
    return detail(w).groupBy("relationship_segment", "lifecycle_segment", "activity_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        whole("sales_transaction_count").alias("sales_transactions"),
        whole("service_order_count").alias("service_orders"),
        _wide_total("sales_revenue").alias("sales_revenue"),
        _wide_total("service_revenue").alias("service_revenue"),
        _wide_total("customer_revenue").alias("customer_revenue"),
        _wide_total("customer_lifetime_value").alias("customer_lifetime_value"),
        _mean("customer_lifetime_value").alias("average_customer_lifetime_value"),
        _mean("service_frequency_per_year").alias("average_service_frequency_per_year"),
        F.count_distinct("customer_key").alias("distinct_customer_count"),
    )


def service_frequency(w) -> DataFrame:
    names = F.array(*[F.lit(n) for n in FREQUENCY_ORDER])
    return detail(w).groupBy("service_frequency_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        whole("service_order_count").alias("service_orders"),
        _wide_total("service_revenue").alias("service_revenue"),
        _wide_total("customer_revenue").alias("customer_revenue"),
        _mean("service_frequency_per_year").alias("average_service_frequency_per_year"),
        _mean("average_days_between_services").alias("average_days_between_services"),
        F.count_distinct("customer_key").alias("distinct_customer_count"),
    ).withColumn("service_frequency_sort", F.array_position(names, F.col("service_frequency_segment")).cast("int"))

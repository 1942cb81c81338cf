"""Filter-aware business measures over the semantic model.

``evaluate`` aggregates every fact it needs on its own, under the part of the filter that
reaches that fact, unions the small results on the group columns and derives ratios last.
Facts are never joined to facts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import SLOW_DAYS
from forecourt.functions.keys import key_date
from forecourt.functions.numeric import TOTAL, fraction
from forecourt.plans.model import VEHICLE_LABELS, SemanticModel

Values = str | int | Iterable | None


@dataclass(frozen=True)
class FilterContext:
    """Slicer selections. ``as_of`` drives the stock snapshot and defaults to ``end``."""

    start: date | None = None
    end: date | None = None
    as_of: date | None = None
    dealership: Values = None
    brand: Values = None
    model: Values = None
    vehicle_type: Values = None

    def lifetime(self) -> FilterContext:
        """The same selections without the lower date bound."""
        return replace(self, start=None)


NO_FILTER = FilterContext()


def _key(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _matches(column: str, wanted: Values) -> Column:
    wanted = [wanted] if isinstance(wanted, (str, int)) else list(wanted)
    return F.col(column).isin(*wanted)


def _by_vehicle(frame: DataFrame, ctx: FilterContext) -> DataFrame:
    for column in ("brand", "model", "vehicle_type"):
        wanted = getattr(ctx, column)
        if wanted is not None:
            frame = frame.where(_matches(column, wanted))
    return frame


def _by_dealership(frame: DataFrame, ctx: FilterContext) -> DataFrame:
    return frame if ctx.dealership is None else frame.where(_matches("dealership_key", ctx.dealership))


def _by_date(frame: DataFrame, ctx: FilterContext, column: str) -> DataFrame:
    if ctx.start is not None:
        frame = frame.where(F.col(column) >= _key(ctx.start))
    if ctx.end is not None:
        frame = frame.where(F.col(column) <= _key(ctx.end))
    return frame


def _sliced(model: SemanticModel, fact: str, ctx: FilterContext) -> DataFrame:
    return _by_vehicle(_by_dealership(model.table(fact), ctx), ctx)


def sales(model: SemanticModel, ctx: FilterContext) -> DataFrame:
    return _by_date(_sliced(model, "fact_sales", ctx), ctx, "sale_date_key")


def completed_orders(model: SemanticModel, ctx: FilterContext) -> DataFrame:
    """Completed repair orders by completion date."""
    orders = _sliced(model, "fact_service", ctx).where(F.col("order_status") == "Completed")
    return _by_date(orders, ctx, "completed_date_key")


def appointments(model: SemanticModel, ctx: FilterContext) -> DataFrame:
    return _by_date(_sliced(model, "fact_service", ctx), ctx, "appointment_date_key")


def snapshot_key(model: SemanticModel, as_of: date | None) -> DataFrame:
    """One row: the latest snapshot on or before ``as_of``, whatever the other filters."""
    stock = model.table("fact_inventory")
    if as_of is not None:
        stock = stock.where(F.col("snapshot_date_key") <= _key(as_of))
    return stock.agg(F.max("snapshot_date_key").alias("snapshot_key"))


def stock_at(model: SemanticModel, ctx: FilterContext, as_of: date | None) -> DataFrame:
    """Stock rows of the one global snapshot, then sliced."""
    at = snapshot_key(model, as_of).scalar()
    return _sliced(model, "fact_inventory", ctx).where(F.col("snapshot_date_key") == at)


def activity(model: SemanticModel, ctx: FilterContext, keep: tuple[str, ...] = ()) -> DataFrame:
    """Completed sales and orders per customer id (and the kept customer columns)."""
    bought = sales(model, ctx).where(F.col("sale_status") == "Completed").groupBy("customer_key").agg(
        F.count_distinct("sale_id").alias("bought"))
    served = completed_orders(model, ctx).groupBy("customer_key").agg(
        F.count_distinct("service_order_id").alias("served"))
    per_key = bought.unionByName(served, allowMissingColumns=True).groupBy("customer_key").agg(
        F.coalesce(F.sum("bought"), F.lit(0)).alias("bought"),
        F.coalesce(F.sum("served"), F.lit(0)).alias("served"))
    customers = model.table("dim_customer").select("customer_key", "customer_id", *keep)
    return per_key.join(customers, "customer_key").groupBy("customer_id", *keep).agg(
        F.sum("bought").alias("bought"), F.sum("served").alias("served"))


# -- group columns --------------------------------------------------------------
# name -> (dimension, dimension key, label column, {source kind: fact key})
LOOKUPS = {
    "dealership_name": ("dim_dealership", "dealership_key", "dealership_name", "dealership_key"),
    "salesperson": ("dim_salesperson", "employee_key", "employee_name", "salesperson_key"),
    "technician": ("dim_technician", "employee_key", "employee_name", "technician_key"),
    "service_type": ("dim_service", "service_key", "service_type", "service_key"),
    "customer_type": ("dim_customer", "customer_key", "customer_type", "customer_key"),
    "customer_state": ("dim_customer", "customer_key", "state", "customer_key"),
}
DATE_KEYS = {"sales": "sale_date_key", "orders": "completed_date_key", "visits": "appointment_date_key",
             "past_sales": "sale_date_key", "past_orders": "completed_date_key"}


def _month_label(key: str) -> Column:
    digits = F.col(key).cast("string")
    return F.concat(F.substring(digits, 1, 4), F.lit("-"), F.substring(digits, 5, 2))


def _labelled(model: SemanticModel, frame: DataFrame, source: str, by: tuple[str, ...]) -> DataFrame:
    """Attach the group columns that are not already on the fact; unmatched keys keep a NULL label."""
    for name in by:
        if name == "year_month":
            frame = frame.withColumn(name, _month_label(DATE_KEYS[source]))
        elif name in LOOKUPS:
            dimension, key, label, fact_key = LOOKUPS[name]
            labels = model.table(dimension).select(F.col(key).alias(fact_key), F.col(label).alias(name))
            frame = frame.join(labels, fact_key, "left")
    return frame


def _members(model: SemanticModel, ctx: FilterContext, by: tuple[str, ...]) -> DataFrame | None:
    """The dimension values a grouped result must list even without facts."""
    if not by:
        return None
    if by == ("year_month",):
        days = model.table("dim_date")
        if ctx.start is not None:
            days = days.where(F.col("full_date") >= ctx.start)
        if ctx.end is not None:
            days = days.where(F.col("full_date") <= ctx.end)
        return days.select("year_month").distinct()
    if set(by) <= {"aging_bucket", "aging_bucket_sort"}:
        return model.table("fact_inventory").select(*by).distinct()
    if set(by) <= set(VEHICLE_LABELS):
        return _by_vehicle(model.table("dim_vehicle"), ctx).select(*by).distinct()
    dimension = LOOKUPS[by[0]][0]
    frame = model.table(dimension)
    if dimension == "dim_dealership":
        frame = _by_dealership(frame, ctx)
    return frame.select(*[F.col(LOOKUPS[name][2]).alias(name) for name in by]).distinct()


# -- base aggregates -------------------------------------------------------------
def _sum(column: str | Column, alias: str) -> Column:
    return F.sum(column).alias(alias)


def _stock_bases(prefix: str = "") -> list[Column]:
    units = F.col("inventory_units")
    slow = (F.col("days_in_inventory") > SLOW_DAYS) & (units > 0)
    return [
        _sum("inventory_units", f"{prefix}stock_units"),
        _sum("inventory_value", f"{prefix}stock_value"),
        _sum(F.col("days_in_inventory").cast("bigint") * units, f"{prefix}stock_days"),
        F.count_distinct(F.when(slow, F.col("vehicle_key"))).alias(f"{prefix}slow_vehicles"),
    ]


def _activity_bases() -> list[Column]:
    bought, served = F.col("bought"), F.col("served")
    return [
        _sum(bought + served, "interactions"),
        _sum(served, "served_orders"),
        F.count_if(bought + served >= 1).alias("qualifying"),
        F.count_if(bought + served >= 2).alias("repeating"),
        F.count_if(bought > 0).alias("with_sales"),
        F.count_if(served > 0).alias("with_service"),
        F.count_if((bought > 0) & (served > 0)).alias("with_both"),
    ]


def _aggregate(model: SemanticModel, ctx: FilterContext, source: str, by: tuple[str, ...]) -> DataFrame:
    """The base numbers of one source per group."""
    customer_groups = tuple(n for n in by if n in ("customer_type", "customer_state"))
    if source == "activity":
        per_customer = activity(model, ctx, tuple(LOOKUPS[n][2] for n in customer_groups))
        named = per_customer.withColumnsRenamed({LOOKUPS[n][2]: n for n in customer_groups})
        return named.groupBy(*by).agg(*_activity_bases())
    if source == "customers":
        frame = model.table("dim_customer").withColumnsRenamed({LOOKUPS[n][2]: n for n in customer_groups})
        return frame.groupBy(*by).agg(F.count_distinct("customer_id").alias("customers"))

    frames: dict[str, Callable[[], DataFrame]] = {
        "sales": lambda: sales(model, ctx),
        "past_sales": lambda: sales(model, ctx.lifetime()),
        "orders": lambda: completed_orders(model, ctx),
        "past_orders": lambda: completed_orders(model, ctx.lifetime()),
        "visits": lambda: appointments(model, ctx),
        "stock": lambda: stock_at(model, ctx, ctx.as_of or ctx.end),
        "end_stock": lambda: stock_at(model, ctx, ctx.end),
    }
    frame = frames[source]()
    if source in ("past_sales", "past_orders") and customer_groups:
        # Reduce to one row per customer before the customer lookup.
        amount = "revenue" if source == "past_sales" else "service_revenue"
        frame = frame.groupBy("customer_key").agg(F.sum(amount).alias(amount))
    bases = {
        "sales": lambda: [_sum("revenue", "revenue"), _sum("units_sold", "units_sold"),
                          _sum("gross_profit", "gross_profit")],
        "past_sales": lambda: [_sum("revenue", "past_revenue")],
        "orders": lambda: [_sum("service_revenue", "service_revenue"),
                           F.count_distinct("service_order_id").alias("service_orders")],
        "past_orders": lambda: [_sum("service_revenue", "past_service")],
        "visits": lambda: [_sum("completed_appointment_count", "visits_completed"),
                           _sum("completion_eligible_count", "visits_eligible")],
        "stock": _stock_bases,
        "end_stock": lambda: _stock_bases("end_"),
    }
    return _labelled(model, frame, source, by).groupBy(*by).agg(*bases[source]())


# -- measures --------------------------------------------------------------------
@dataclass(frozen=True)
class Measure:
    """A measure: the sources whose base numbers it needs and its value from them."""

    sources: tuple[str, ...]
    value: Callable[[], Column]
    snapshot: str | None = None


def _count(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast("bigint")


def _amount(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).cast(TOTAL)


def _quotient(top: str, bottom: str) -> Column:
    return fraction(F.coalesce(F.col(top), F.lit(0)), F.coalesce(F.col(bottom), F.lit(0)))


def _stock_measures(source: str, prefix: str = "") -> dict[str, Measure]:
    at = "as_of" if source == "stock" else "end"
    return {
        "inventory_units": Measure((source,), lambda: _count(f"{prefix}stock_units"), at),
        "inventory_value": Measure((source,), lambda: _amount(f"{prefix}stock_value"), at),
        "average_days_in_inventory":
            Measure((source,), lambda: _quotient(f"{prefix}stock_days", f"{prefix}stock_units"), at),
        "slow_moving_vehicles": Measure((source,), lambda: _count(f"{prefix}slow_vehicles"), at),
    }


_END = _stock_measures("end_stock", "end_")
MEASURES: dict[str, Measure] = {
    "revenue": Measure(("sales",), lambda: _amount("revenue")),
    "units_sold": Measure(("sales",), lambda: _count("units_sold")),
    "asp": Measure(("sales",), lambda: _quotient("revenue", "units_sold")),
    "gross_profit": Measure(("sales",), lambda: _amount("gross_profit")),
    "gross_margin": Measure(("sales",), lambda: _quotient("gross_profit", "revenue")),
    **_stock_measures("stock"),
    "service_revenue": Measure(("orders",), lambda: _amount("service_revenue")),
    "service_orders": Measure(("orders",), lambda: _count("service_orders")),
    "average_repair_order": Measure(("orders",), lambda: _quotient("service_revenue", "service_orders")),
    "completion_rate": Measure(("visits",), lambda: _quotient("visits_completed", "visits_eligible")),
    "customers": Measure(("customers",), lambda: _count("customers")),
    "qualifying_interactions": Measure(("activity",), lambda: _count("interactions")),
    "qualifying_customers": Measure(("activity",), lambda: _count("qualifying")),
    "repeat_customers": Measure(("activity",), lambda: _count("repeating")),
    "repeat_rate": Measure(("activity",), lambda: _quotient("repeating", "qualifying")),
    "customer_lifetime_value": Measure(
        ("past_sales", "past_orders"), lambda: (_amount("past_revenue") + _amount("past_service")).cast(TOTAL)),
    "customers_with_sales": Measure(("activity",), lambda: _count("with_sales")),
    "customers_with_service": Measure(("activity",), lambda: _count("with_service")),
    "sales_and_service_customers": Measure(("activity",), lambda: _count("with_both")),
    "service_frequency": Measure(("activity",), lambda: _quotient("served_orders", "with_service")),
    "executive_inventory_value": _END["inventory_value"],
    "executive_inventory_units": _END["inventory_units"],
    "as_of_inventory_value": _END["inventory_value"],
    "as_of_inventory_units": _END["inventory_units"],
    "as_of_average_days_in_inventory": _END["average_days_in_inventory"],
    "as_of_slow_moving_vehicles": _END["slow_moving_vehicles"],
}

# Every named measure, in catalogue order; those outside MEASURES come from the snapshot or the selection.
CATALOGUE = (
    "revenue", "units_sold", "asp", "gross_profit", "gross_margin", "inventory_snapshot_key", "inventory_units",
    "inventory_value", "average_days_in_inventory", "slow_moving_vehicles", "service_revenue", "service_orders",
    "average_repair_order", "completion_rate", "customers", "qualifying_interactions", "qualifying_customers",
    "repeat_customers", "repeat_rate", "customer_lifetime_value", "customers_with_sales", "customers_with_service",
    "sales_and_service_customers", "service_frequency", "executive_inventory_value", "executive_inventory_units",
    "executive_snapshot_date", "as_of_inventory_value", "as_of_inventory_units", "as_of_average_days_in_inventory",
    "as_of_slow_moving_vehicles", "as_of_snapshot_date", "selected_brand", "selected_model", "selected_vehicle_type",
)

KPI_VECTOR = (
    "revenue", "units_sold", "asp", "gross_profit", "gross_margin", "inventory_units", "inventory_value",
    "average_days_in_inventory", "slow_moving_vehicles", "service_revenue", "service_orders",
    "average_repair_order", "completion_rate", "customers", "repeat_customers", "repeat_rate",
    "customer_lifetime_value",
)


def evaluate(model: SemanticModel, names: Iterable[str], ctx: FilterContext = NO_FILTER,
             by: Iterable[str] = ()) -> DataFrame:
    """Measures per group (one row without groups), every dimension member included."""
    names, by = list(names), tuple(by)
    sources = list(dict.fromkeys(s for n in names for s in MEASURES[n].sources))
    parts = [_aggregate(model, ctx, source, by) for source in sources]
    members = _members(model, ctx, by)
    combined = parts[0] if members is None else members.unionByName(parts[0], allowMissingColumns=True)
    for part in parts[1:]:
        combined = combined.unionByName(part, allowMissingColumns=True)
    bases = [c for c in combined.columns if c not in by]
    # Each base number comes from one part, so MAX only skips the NULL padding of the others.
    merged = combined.groupBy(*by).agg(*[F.max(c).alias(f"b_{c}") for c in bases]) \
        .withColumnsRenamed({f"b_{c}": c for c in bases})

    def valued(name: str) -> Column:
        measure = MEASURES[name]
        value = measure.value()
        if measure.snapshot:
            day = ctx.end if measure.snapshot == "end" else (ctx.as_of or ctx.end)
            value = F.when(snapshot_key(model, day).scalar().isNotNull(), value)
        return value.alias(name)

    return merged.select(*by, *[valued(n) for n in names])


def snapshot_measures(model: SemanticModel, ctx: FilterContext = NO_FILTER) -> DataFrame:
    """One row: the snapshot key in use and its date, for the as-of slicer and for the period end."""
    at_end = snapshot_key(model, ctx.end).scalar()
    day = key_date(F.col("end_key"))
    return snapshot_key(model, ctx.as_of or ctx.end).select(
        F.col("snapshot_key").alias("inventory_snapshot_key"), at_end.alias("end_key")
    ).select("inventory_snapshot_key", day.alias("executive_snapshot_date"), day.alias("as_of_snapshot_date"))


# Label shown when the selection holds no single value.
ALL_LABELS = {"brand": "All Brands", "model": "All Models", "vehicle_type": "All Vehicle Types"}


def selected_labels(model: SemanticModel, ctx: FilterContext = NO_FILTER) -> DataFrame:
    """One row: the single brand, model and vehicle type in the selection, or the 'All ...' label."""
    vehicles = _by_vehicle(model.table("dim_vehicle"), ctx)

    def label(column: str) -> Column:
        low, high = F.min(column), F.max(column)
        return F.when(low == high, low).otherwise(ALL_LABELS[column]).alias(f"selected_{column}")

    return vehicles.agg(*[label(c) for c in ALL_LABELS])


def measure(model: SemanticModel, name: str, ctx: FilterContext = NO_FILTER) -> DataFrame:
    """Any measure of the catalogue as one row."""
    if name in MEASURES:
        return evaluate(model, (name,), ctx)
    source = selected_labels if name.startswith("selected_") else snapshot_measures
    return source(model, ctx).select(name)


def kpis(model: SemanticModel, ctx: FilterContext = NO_FILTER) -> DataFrame:
    """The one-row KPI vector."""
    return evaluate(model, KPI_VECTOR, ctx)


# -- report queries: group columns -> measures -------------------------------------
REPORTS: dict[str, tuple[tuple[str, ...], tuple[str, ...]]] = {
    "gq_01_monthly_sales": (("year_month",), ("revenue", "gross_profit")),
    "gq_02_monthly_service": (("year_month",), ("service_revenue",)),
    "gq_03_brand_sales": (("brand",), ("revenue",)),
    "gq_04_dealership_sales": (("dealership_name",), ("revenue",)),
    "gq_05_inventory_age": (("aging_bucket", "aging_bucket_sort"), ("executive_inventory_units",)),
    "gq_06_monthly_sales_units": (("year_month",), ("units_sold", "revenue", "gross_profit")),
    "gq_07_salesperson_performance": (("salesperson",), ("revenue", "gross_margin")),
    "gq_08_model_performance": (("model",), ("revenue", "units_sold", "asp")),
    "gq_09_inventory_aging": (("aging_bucket", "aging_bucket_sort"),
                              ("as_of_inventory_units", "as_of_inventory_value")),
    "gq_10_inventory_by_model": (("model",), ("as_of_inventory_value", "as_of_average_days_in_inventory")),
    "gq_11_vehicle_model_matrix": (
        ("brand", "model", "vehicle_type"),
        ("units_sold", "revenue", "gross_profit", "as_of_inventory_units", "as_of_slow_moving_vehicles")),
    "gq_12_monthly_service_orders": (("year_month",), ("service_revenue", "service_orders")),
    "gq_13_technician_performance": (("technician",), ("service_revenue", "service_orders", "completion_rate")),
    "gq_14_service_type_performance": (
        ("service_type",), ("service_revenue", "service_orders", "average_repair_order")),
    "gq_15_customer_value_by_type": (("customer_type",), ("customer_lifetime_value", "repeat_customers")),
    "gq_16_state_repeat_rate": (("customer_state",), ("repeat_rate", "service_frequency")),
    "gq_17_customer_matrix": (
        ("customer_type", "customer_state"),
        ("customers", "repeat_customers", "sales_and_service_customers", "service_frequency",
         "customer_lifetime_value")),
    "gq_c1_overview_cards": ((), (
        "revenue", "units_sold", "gross_profit", "gross_margin", "service_revenue", "executive_inventory_value")),
    "gq_c2_sales_inventory_cards": ((), (
        "units_sold", "revenue", "asp", "gross_profit", "gross_margin", "as_of_inventory_units",
        "as_of_inventory_value", "as_of_average_days_in_inventory", "as_of_slow_moving_vehicles")),
    "gq_c3_service_customer_cards": ((), (
        "service_revenue", "service_orders", "average_repair_order", "completion_rate", "customers",
        "repeat_customers", "repeat_rate", "customer_lifetime_value", "sales_and_service_customers",
        "service_frequency")),
    "gq_c4_vehicle_detail_cards": ((), (
        "revenue", "units_sold", "asp", "gross_profit", "gross_margin", "as_of_inventory_units",
        "as_of_inventory_value", "as_of_average_days_in_inventory", "as_of_slow_moving_vehicles")),
}


def report(model: SemanticModel, name: str, ctx: FilterContext = NO_FILTER) -> DataFrame:
    by, names = REPORTS[name]
    return evaluate(model, names, ctx, by)


def drill_through(model: SemanticModel, ctx: FilterContext = NO_FILTER) -> DataFrame:
    """Vehicle labels by aging bucket. Sales measures repeat per bucket, which exists only on stock."""
    by = VEHICLE_LABELS
    sold = evaluate(model, ("units_sold", "revenue", "gross_profit"), ctx, by)
    buckets = model.table("fact_inventory").agg(F.collect_set("aging_bucket").alias("b")).scalar()
    keys = sold.withColumn("aging_bucket", F.explode(buckets))
    stock = _aggregate(model, ctx, "end_stock", (*by, "aging_bucket"))
    held = snapshot_key(model, ctx.end).scalar().isNotNull()
    joined = keys.alias("k").join(
        stock.alias("s"),
        [F.col(f"k.{c}").eqNullSafe(F.col(f"s.{c}")) for c in (*by, "aging_bucket")], "left")

    def stock_value(name: str, value: Column) -> Column:
        return F.when(held, value).alias(name)

    return joined.select(
        *[F.col(f"k.{c}") for c in (*by, "aging_bucket", "units_sold", "revenue", "gross_profit")],
        stock_value("as_of_inventory_units", _count("end_stock_units")),
        stock_value("as_of_inventory_value", _amount("end_stock_value")),
        stock_value("as_of_average_days_in_inventory", _quotient("end_stock_days", "end_stock_units")),
    )

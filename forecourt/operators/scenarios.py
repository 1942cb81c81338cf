"""KPI comparison: an independent computation from the facts, tolerances, and the scenario sweep.

The sweep does not evaluate the measures once per scenario. Every fact row is tagged with the
few scenarios it belongs to (overall, its dealership, brand, vehicle type and month), and one
aggregation per fact yields the numbers of all scenarios together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.contracts import RECOGNISED_SALES, SLOW_DAYS
from forecourt.functions.numeric import TOTAL, fraction
from forecourt.operators.measures import KPI_VECTOR, NO_FILTER, FilterContext, _by_date, _by_dealership, _matches
from forecourt.operators.scoring import pass_fail, union_all
from forecourt.plans.model import SemanticModel
from forecourt.plans.warehouse import Planned
from forecourt.sources.store import written_stages

# KPI tolerances (counts exact, money one cent, ratios 1e-8).
COUNT_KPIS = ("units_sold", "inventory_units", "slow_moving_vehicles", "service_orders", "customers",
              "repeat_customers")
MONEY_KPIS = ("revenue", "gross_profit", "inventory_value", "service_revenue", "customer_lifetime_value")
MONEY_SLACK, RATIO_SLACK = "0.01", "0.00000001"
NUMBER = "decimal(38,18)"


# -- one context, straight from the star schema -------------------------------------
def alternate_kpis(w, ctx: FilterContext = NO_FILTER) -> DataFrame:
    """The KPI vector from facts and dimensions, sharing nothing with the measures but the filter."""
    cars = w.table("dim_vehicle")
    for column, wanted in (("make", ctx.brand), ("model", ctx.model), ("body_type", ctx.vehicle_type)):
        if wanted is not None:
            cars = cars.where(_matches(column, wanted))

    def sliced(name: str) -> DataFrame:
        return _by_dealership(w.table(name), ctx).join(cars.select("vehicle_key"), "vehicle_key", "left_semi")

    c = F.col
    sold_ever = sliced("fact_sales").where(c("sale_status").isin(*RECOGNISED_SALES)).select(
        "sale_id", "customer_key", "sale_status", "sale_date_key", c("unit_quantity").alias("u"),
        (c("sale_price") * c("unit_quantity")).alias("r"), (c("gross_profit") * c("unit_quantity")).alias("p"))
    done_ever = sliced("fact_service").where(c("order_status") == "Completed")
    sold, done = _by_date(sold_ever, ctx, "sale_date_key"), _by_date(done_ever, ctx, "completed_date_key")
    visits = _by_date(sliced("service_detail"), ctx, "appointment_date_key")
    history = ctx.lifetime()
    all_stock = w.table("fact_inventory")
    latest = _by_date(all_stock, FilterContext(end=ctx.as_of or ctx.end), "snapshot_date_key") \
        .agg(F.max("snapshot_date_key").alias("k"))
    stock = sliced("fact_inventory").where(c("snapshot_date_key") == latest.scalar())

    ids = w.table("dim_customer").select("customer_key", "customer_id")
    touches = sold.where(c("sale_status") == "Completed").select("customer_key", c("sale_id").alias("id")).distinct() \
        .unionByName(done.select("customer_key", c("service_order_id").alias("id")).distinct()) \
        .groupBy("customer_key").agg(F.count("*").alias("n")).join(ids, "customer_key") \
        .groupBy("customer_id").agg(F.sum("n").alias("n"))

    held = (c("days_in_inventory") > SLOW_DAYS) & (c("on_hand_quantity") > 0)
    numbers = {
        "sold": sold.agg(F.sum("r").alias("r"), F.sum("u").alias("u"), F.sum("p").alias("p")),
        "done": done.agg(F.sum("service_revenue").alias("sr"), F.count_distinct("service_order_id").alias("so")),
        "visits": visits.agg(F.sum("completed_appointment_count").alias("vc"),
                             F.sum("completion_eligible_count").alias("ve")),
        "stock": stock.agg(
            F.sum("on_hand_quantity").alias("iu"), F.sum("carrying_cost").alias("iv"),
            F.sum(c("days_in_inventory").cast("bigint") * c("on_hand_quantity")).alias("idays"),
            F.count_distinct(F.when(held, c("vehicle_key"))).alias("islow")),
        "snapshot": latest,
        "people": w.table("dim_customer").agg(F.count_distinct("customer_id").alias("cu")),
        "touches": touches.agg(F.count_if(c("n") >= 1).alias("q"), F.count_if(c("n") >= 2).alias("rp")),
        "past_sold": _by_date(sold_ever, history, "sale_date_key").agg(F.sum("r").alias("hr")),
        "past_done": _by_date(done_ever, history, "completed_date_key").agg(F.sum("service_revenue").alias("hs")),
    }
    wide = None
    for frame in numbers.values():
        wide = frame if wide is None else wide.unionByName(frame, allowMissingColumns=True)
    one = wide.agg(*[F.max(n).alias(n) for n in wide.columns])
    return _kpi_columns(one, c("k").isNotNull())


def _kpi_columns(frame: DataFrame, has_snapshot: Column, *keys: str) -> DataFrame:
    """KPI vector from short-named base numbers."""
    def n(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0))

    def if_stock(value: Column) -> Column:
        return F.when(has_snapshot, value)

    values = {
        "revenue": n("r").cast(TOTAL), "units_sold": n("u").cast("bigint"), "asp": fraction(n("r"), n("u")),
        "gross_profit": n("p").cast(TOTAL), "gross_margin": fraction(n("p"), n("r")),
        "inventory_units": if_stock(n("iu").cast("bigint")), "inventory_value": if_stock(n("iv").cast(TOTAL)),
        "average_days_in_inventory": if_stock(fraction(n("idays"), n("iu"))),
        "slow_moving_vehicles": if_stock(n("islow").cast("bigint")),
        "service_revenue": n("sr").cast(TOTAL), "service_orders": n("so").cast("bigint"),
        "average_repair_order": fraction(n("sr"), n("so")), "completion_rate": fraction(n("vc"), n("ve")),
        "customers": n("cu").cast("bigint"), "repeat_customers": n("rp").cast("bigint"),
        "repeat_rate": fraction(n("rp"), n("q")), "customer_lifetime_value": (n("hr") + n("hs")).cast(TOTAL),
    }
    return frame.select(*keys, *[values[name].alias(name) for name in KPI_VECTOR])


# -- comparison -------------------------------------------------------------------------
def _long(frame: DataFrame, keys: list[str], value: str) -> DataFrame:
    names = [c for c in frame.columns if c not in keys]
    pairs = F.array(*[F.struct(F.lit(n).alias("kpi"), F.col(n).cast(NUMBER).alias(value)) for n in names])
    return frame.select(*keys, F.inline(pairs))


def compare_kpis(expected: DataFrame, actual: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """Rows (keys, kpi, expected, actual, difference, status); a KPI missing on the actual side fails."""
    by = [*keys, "kpi"]
    wanted = _long(expected, list(keys), "expected")
    found = _long(actual, list(keys), "actual").withColumn("found", F.lit(True))
    gap = F.abs(F.col("actual") - F.col("expected"))
    slack = (F.when(F.col("kpi").isin(*COUNT_KPIS), F.lit("0"))
             .when(F.col("kpi").isin(*MONEY_KPIS), F.lit(MONEY_SLACK)).otherwise(F.lit(RATIO_SLACK)).cast(NUMBER))
    both_null = F.col("expected").isNull() & F.col("actual").isNull()
    ok = F.col("found") & (both_null | F.coalesce(gap <= slack, F.lit(False)))
    return wanted.join(found, by, "left").select(
        *by, "expected", "actual", (F.col("actual") - F.col("expected")).alias("difference"),
        pass_fail(ok).alias("status"))


# -- scenario sweep -----------------------------------------------------------------------
def _month(key: str) -> Column:
    return F.floor(F.col(key) / 100).cast("int")


def scenarios(model: SemanticModel, served: DataFrame | None = None) -> DataFrame:
    """All scenario names with their kind and, for months, the month number (YYYYMM)."""
    no_month = F.lit(None).cast("int").alias("month")

    def named(frame: DataFrame, prefix: str, column: str) -> DataFrame:
        return frame.select(column).distinct().select(
            F.concat(F.lit(prefix), F.col(column).cast("string")).alias("scenario"), F.lit(prefix).alias("kind"),
            no_month)

    served = model.table("fact_service") if served is None else served
    orders = served.where(F.col("completed_date_key").isNotNull())
    months = orders.select(_month("completed_date_key").alias("month")).distinct().select(
        F.concat(F.lit("month_"), F.col("month").cast("string")).alias("scenario"), F.lit("month_").alias("kind"),
        "month")
    fixed = F.array(*[F.struct(F.lit(s).alias("scenario"), F.lit(s).alias("kind"), no_month)
                      for s in ("all", "empty", "before_inventory")])
    one = model.table("dim_customer").agg(F.count("*").alias("n")).select(F.inline(fixed))
    return union_all([
        one,
        named(model.table("dim_dealership"), "dealer_", "dealership_key"),
        named(model.table("dim_vehicle"), "brand_", "brand"),
        named(model.table("dim_vehicle"), "type_", "vehicle_type"),
        months,
    ])


def _tagged(frame: DataFrame, date_key: str | None) -> DataFrame:
    """One row per scenario that a fact row belongs to."""
    tags = [
        F.lit("all"),
        F.concat(F.lit("dealer_"), F.col("dealership_key").cast("string")),
        F.concat(F.lit("brand_"), F.col("brand")),
        F.concat(F.lit("type_"), F.col("vehicle_type")),
    ]
    if date_key:
        tags.append(F.concat(F.lit("month_"), _month(date_key).cast("string")))
    return frame.withColumn("scenario", F.explode(F.array(*tags)))


def scenario_kpis(model: SemanticModel) -> DataFrame:
    """The KPI vector of every scenario."""
    c = F.col
    labels = ("dealership_key", "brand", "vehicle_type")
    sold = model.read_once("fact_sales", "sale_id", "sale_date_key", "customer_key", *labels, "sale_status", "units_sold", "revenue", "gross_profit")
    served = model.read_once("fact_service", "service_order_id", "appointment_date_key", "completed_date_key", "customer_key", *labels,
                             "order_status", "completed_appointment_count", "completion_eligible_count", "service_revenue")
    stock = model.read_once("fact_inventory", "vehicle_key", *labels, "snapshot_date_key", "days_in_inventory", "inventory_units", "inventory_value")
    done = served.where(c("order_status") == "Completed")

    by_sales = _tagged(sold, "sale_date_key").groupBy("scenario").agg(
        F.sum("revenue").alias("r"), F.sum("units_sold").alias("u"), F.sum("gross_profit").alias("p"))
    by_orders = _tagged(done, "completed_date_key").groupBy("scenario").agg(
        F.sum("service_revenue").alias("sr"), F.count_distinct("service_order_id").alias("so"))
    by_visits = _tagged(served, "appointment_date_key").groupBy("scenario").agg(
        F.sum("completed_appointment_count").alias("vc"), F.sum("completion_eligible_count").alias("ve"))

    ids = model.table("dim_customer").select("customer_key", "customer_id")
    bought = _tagged(sold.where(c("sale_status") == "Completed"), "sale_date_key") \
        .groupBy("scenario", "customer_key").agg(F.count_distinct("sale_id").alias("n"))
    repaired = _tagged(done, "completed_date_key") \
        .groupBy("scenario", "customer_key").agg(F.count_distinct("service_order_id").alias("n"))
    by_customer = bought.unionByName(repaired).groupBy("scenario", "customer_key").agg(F.sum("n").alias("n")) \
        .join(ids, "customer_key").groupBy("scenario", "customer_id").agg(F.sum("n").alias("n")) \
        .groupBy("scenario").agg(F.count_if(c("n") >= 1).alias("q"), F.count_if(c("n") >= 2).alias("rp"))

    slow = F.when((c("days_in_inventory") > SLOW_DAYS) & (c("inventory_units") > 0), c("vehicle_key"))
    stock_sums = [
        F.sum("inventory_units").alias("iu"), F.sum("inventory_value").alias("iv"),
        F.sum(c("days_in_inventory").cast("bigint") * c("inventory_units")).alias("idays"),
        F.count_distinct(slow).alias("islow"),
    ]
    latest = stock.agg(F.max("snapshot_date_key").alias("k")).scalar()
    by_stock = _tagged(stock.where(c("snapshot_date_key") == latest), None).groupBy("scenario").agg(*stock_sums)

    # Lifetime value without a lower bound: slices keep every date, months accumulate.
    past = (c("scenario").startswith("month_"))
    slices = [
        by_sales.where(~past).select("scenario", c("r").alias("hr")),
        by_orders.where(~past).select("scenario", c("sr").alias("hs")),
    ]
    names = scenarios(model, served)
    month_rows = names.where(c("kind") == "month_").select("scenario", "month", F.lit(1).alias("wanted"))
    monthly = union_all([
        f.select("month", "hr", "hs") for f in (
            sold.groupBy(_month("sale_date_key").alias("month")).agg(F.sum("revenue").alias("hr"))
            .withColumn("hs", F.lit(None).cast("decimal(38,2)")),
            done.groupBy(_month("completed_date_key").alias("month")).agg(F.sum("service_revenue").alias("hs"))
            .withColumn("hr", F.lit(None).cast("decimal(38,2)")),
        )
    ])
    snapshots = stock.groupBy("snapshot_date_key").agg(*stock_sums)
    by_month = _as_of_months(month_rows, monthly, snapshots)

    parts = [by_sales, by_orders, by_visits, by_customer, by_stock, *slices, by_month]
    combined = names.select("scenario", "kind")
    for part in parts:
        combined = combined.unionByName(part, allowMissingColumns=True)
    bases = [n for n in combined.columns if n not in ("scenario", "kind")]
    merged = combined.groupBy("scenario").agg(F.max("kind").alias("kind"), *[F.max(n).alias(n) for n in bases]) \
        .where(c("kind").isNotNull())
    people = model.table("dim_customer").agg(F.count_distinct("customer_id").alias("n")).scalar()
    has_snapshot = F.when(c("kind") == "before_inventory", F.lit(False)) \
        .when(c("kind") == "month_", c("snapshot").isNotNull()).otherwise(latest.isNotNull())
    return _kpi_columns(merged.withColumn("cu", people).withColumn("held", has_snapshot), c("held"), "scenario")


def _as_of_months(months: DataFrame, monthly: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Running totals up to each wanted month and the stock of the latest snapshot by its end.

    Input is already reduced to one row per month or snapshot, so the ordered window is as
    long as the calendar, not as the data.
    """
    c = F.col
    stock = F.struct("snapshot_date_key", "iu", "iv", "idays", "islow")
    lines = months.unionByName(monthly, allowMissingColumns=True).unionByName(
        snapshots.select(_month("snapshot_date_key").alias("month"), stock.alias("stock")), allowMissingColumns=True)
    per_month = lines.groupBy("month").agg(
        F.max("scenario").alias("scenario"), F.max("wanted").alias("wanted"),
        F.sum("hr").alias("hr"), F.sum("hs").alias("hs"), F.max("stock").alias("stock"))
    so_far = Window.partitionBy(F.lit("calendar")).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    run = per_month.select(
        "scenario", "wanted",
        F.sum("hr").over(so_far).alias("hr"), F.sum("hs").over(so_far).alias("hs"),
        F.last("stock", ignorenulls=True).over(so_far).alias("stock"))
    return run.where(c("wanted") == 1).select(
        "scenario", "hr", "hs", c("stock.snapshot_date_key").alias("snapshot"),
        c("stock.iu").alias("iu"), c("stock.iv").alias("iv"), c("stock.idays").alias("idays"),
        c("stock.islow").alias("islow"))


def facts_model(w) -> SemanticModel:
    """Model tables taken from the star schema instead of the detail views, for cross-checking.

    With a store, the columns that are read of a fact are written once; nothing wide is.
    """
    c, spark = F.col, w.store and w.store.spark
    w = Planned(w) if spark else w
    cars = w.table("dim_vehicle").select(
        "vehicle_key", c("make").alias("brand"), "model", "model_year", c("body_type").alias("vehicle_type"))
    sold = w.table("fact_sales").where(c("sale_status").isin(*RECOGNISED_SALES)).select(
        "sale_id", "sale_date_key", "customer_key", "vehicle_key", "dealership_key", "sale_status",
        c("unit_quantity").alias("units_sold"), (c("sale_price") * c("unit_quantity")).alias("revenue"),
        (c("gross_profit") * c("unit_quantity")).alias("gross_profit"))
    stock = w.table("fact_inventory").select(
        "vehicle_key", "dealership_key", "snapshot_date_key", "days_in_inventory",
        c("on_hand_quantity").alias("inventory_units"), c("carrying_cost").alias("inventory_value"))
    orders = w.table("fact_service").select(
        "appointment_id", "service_order_id", "completed_date_key", "order_status", "service_revenue")
    visits = w.table("service_detail").select(
        "appointment_id", "appointment_date_key", "customer_key", "vehicle_key", "dealership_key",
        "completed_appointment_count", "completion_eligible_count")
    facts = {"fact_sales": sold, "fact_inventory": stock, "fact_service": visits.join(orders, "appointment_id", "left")}
    return SemanticModel({
        "dim_vehicle": cars,
        "dim_customer": w.table("dim_customer"),
        "dim_dealership": w.table("dim_dealership"),
        **{name: lambda frame=frame: frame for name, frame in facts.items()},
    }, written_stages(spark) if spark else None, tuple(facts) if spark else ())


def scenario_comparison(w) -> DataFrame:
    """KPIs of every scenario from the detail views against the same KPIs from the facts."""
    return compare_kpis(scenario_kpis(SemanticModel.planned(w)), scenario_kpis(facts_model(w)), ("scenario",))

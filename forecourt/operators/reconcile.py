"""Reconciliation suites: facts against details, details against every aggregate view.

Each suite reduces its inputs to a few one-row aggregates, gathers those numbers into one
map, and derives every check row from it (see ``scoring``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import (
    ADVISOR_ROLE,
    CLV_METHOD,
    INACTIVE_DAYS,
    MONEY_TOLERANCE,
    RECOGNISED_SALES,
    SALES_ROLE,
    SLOW_DAYS,
    TECHNICIAN_ROLE,
)
from forecourt.functions.keys import date_key
from forecourt.functions.numeric import differs
from forecourt.operators.quality import checks as quality_checks
from forecourt.operators.scoring import duplicates, pass_fail, reconciled, require_all_pass, scalars, union_all
from forecourt.plans import customer, inventory, reporting, sales, service
from forecourt.plans.warehouse import Planned
from forecourt.sources.store import written_stages

Rule = tuple[str, str, "str | None", str]
ROWS = "*"


def _zero(total: Column) -> Column:
    return F.coalesce(total, F.lit(0))


def _sums(frame: DataFrame, **columns: str) -> DataFrame:
    """One row of zero-defaulted sums: alias -> column."""
    return frame.agg(*[_zero(F.sum(column)).alias(alias) for alias, column in columns.items()])


def _recognised(w) -> DataFrame:
    return w.table("fact_sales").where(F.col("sale_status").isin(*RECOGNISED_SALES))


# The wording of the sales checks.
SALES_RULES: list[Rule] = [
    ("detail_sale_id_uniqueness", "detail.rows", "detail.ids",
     "vw_sales_detail must contain exactly one row per sale_id."),
    ("detail_vs_fact_row_count", "detail.rows", "fact.rows",
     "Eligible fact rows and canonical detail rows must match."),
    ("detail_vs_fact_units_sold", "detail.units", "fact.units",
     "Detail units sold must reconcile to signed fact units."),
    ("detail_vs_fact_revenue", "detail.revenue", "fact.revenue",
     "Detail revenue must reconcile to signed fact revenue."),
    ("detail_vs_fact_gross_profit", "detail.profit", "fact.profit",
     "Detail gross profit must reconcile to signed fact gross profit."),
    ("kpi_vs_detail_row_count", "kpi.rows", "detail.rows",
     "KPI fact-row count must reconcile to canonical detail."),
    ("kpi_vs_detail_units_sold", "kpi.units", "detail.units",
     "KPI units sold must reconcile to canonical detail."),
    ("kpi_vs_detail_revenue", "kpi.revenue", "detail.revenue",
     "KPI revenue must reconcile to canonical detail."),
    ("kpi_vs_detail_gross_profit", "kpi.profit", "detail.profit",
     "KPI gross profit must reconcile to canonical detail."),
]
SALES_VIEW_METRICS = (
    ("rows", "row_count", "fact-row counts"),
    ("units", "units_sold", "units sold"),
    ("revenue", "revenue", "revenue"),
    ("profit", "gross_profit", "gross profit"),
)


def sales_checks(w) -> DataFrame:
    """33 rows over the sales detail, the KPI view and the six grouped views."""
    measures = {"rows": "fact_row_count", "units": "units_sold", "revenue": "revenue", "profit": "gross_profit"}
    units = F.col("unit_quantity")
    fact = _recognised(w).agg(
        F.count(ROWS).alias("rows"),
        _zero(F.sum(units)).alias("units"),
        _zero(F.sum(F.col("sale_price") * units)).alias("revenue"),
        _zero(F.sum(F.col("gross_profit") * units)).alias("profit"),
    )
    detail = sales.detail(w).agg(
        F.count(ROWS).alias("rows"),
        F.count_distinct("sale_id").alias("ids"),
        _zero(F.sum("units_sold")).alias("units"),
        _zero(F.sum("revenue")).alias("revenue"),
        _zero(F.sum("gross_profit")).alias("profit"),
    )
    views = {view: _sums(sales.grouped(w, view), **measures) for view in sales.GROUPED}
    rules = SALES_RULES + [
        (f"{view}_{suffix}", f"{view}.{metric}", f"detail.{metric}", f"{view} {label} must reconcile to canonical detail.")
        for metric, suffix, label in SALES_VIEW_METRICS for view in sales.GROUPED
    ]
    return reconciled(scalars(fact=fact, detail=detail, kpi=_sums(sales.kpis(w), **measures), **views), rules)


# -- inventory -----------------------------------------------------------------
def _by_snapshot(frame: DataFrame, **measures: Column) -> DataFrame:
    return frame.groupBy("snapshot_date_key").agg(*[c.alias(n) for n, c in measures.items()])


def _snapshot_mismatches(left: DataFrame, right: DataFrame, exact: list[str], money: str = "value") -> DataFrame:
    """One row: snapshots present on one side only, or with different numbers."""
    names = [*exact, money]
    a = left.select("snapshot_date_key", F.struct(*names).alias("a"))
    b = right.select("snapshot_date_key", F.struct(*names).alias("b"))
    unequal = F.col("a").isNull() | F.col("b").isNull()
    for name in exact:
        unequal = unequal | _zero_bool(F.col(f"a.{name}") != F.col(f"b.{name}"))
    gap = F.abs(F.col(f"a.{money}") - F.col(f"b.{money}")) > F.lit(MONEY_TOLERANCE).cast("decimal(3,2)")
    joined = a.join(b, "snapshot_date_key", "full")
    return joined.agg(F.count_if(unequal | _zero_bool(gap)).alias("failed_count"))


def _zero_bool(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False))


# The wording of the inventory checks.
INVENTORY_TEXTS = {
    "detail_inventory_key_uniqueness": "Each canonical inventory detail row must have a unique inventory_key.",
    "detail_vs_fact_by_snapshot":
        "Detail rows, units, value, and weighted days must match fact_inventory for every snapshot.",
    "kpis_vs_detail_by_snapshot": "Inventory KPI rows must reconcile to canonical detail for every snapshot.",
    "slow_moving_view_vs_detail_by_snapshot":
        "Slow-moving rows, units, and value must equal detail rows over 90 days for every snapshot.",
    "aging_bucket_assignment": "Every row must have the mutually exclusive bucket dictated by days_in_inventory.",
    "slow_moving_definition": "is_slow_moving must be true exactly when days_in_inventory is greater than 90.",
}
INVENTORY_VIEW_TEXT = "{view} rows, units, and value must reconcile for every snapshot."


def _counted(name: str, details: str, failed: DataFrame) -> DataFrame:
    return failed.select(F.lit(name).alias("check_name"), F.col("failed_count").cast("bigint"),
                         F.lit(details).alias("details"))


def inventory_checks(w) -> DataFrame:
    """Six rows, plus one per grouped view that disagrees with the detail on some snapshot."""
    days, rows = F.col("days_in_inventory").cast("bigint"), F.count(ROWS)
    detail = inventory.detail(w)
    basic = {"rows": rows, "units": F.sum("inventory_units"), "value": F.sum("inventory_value")}
    by_detail = _by_snapshot(detail, **basic, keys=F.count_distinct("inventory_key"),
                             age=F.sum(days * F.col("inventory_units")))
    by_fact = _by_snapshot(
        w.table("fact_inventory"), rows=rows, units=F.sum("on_hand_quantity"), value=F.sum("carrying_cost"),
        keys=F.count_distinct("inventory_key"), age=F.sum(days * F.col("on_hand_quantity")))
    by_kpi = inventory.kpis(w).select(
        "snapshot_date_key", F.col("fact_row_count").alias("rows"), F.col("inventory_units").alias("units"),
        F.col("inventory_value").alias("value"), F.col("distinct_inventory_count").alias("keys"),
        F.col("total_inventory_days").alias("age"))
    slow_days = F.col("days_in_inventory") > SLOW_DAYS
    slow_detail = _by_snapshot(detail.where(slow_days), **basic)
    slow_view = _by_snapshot(inventory.slow_moving(w), **basic)
    full = ["rows", "keys", "units", "age"]

    row_rules = detail.agg(
        F.count_if(differs(F.col("aging_bucket"), inventory.aging(F.col("days_in_inventory")))).alias("bucket"),
        F.count_if(differs(F.col("is_slow_moving"), slow_days)).alias("slow"),
    )
    counted = {
        "detail_inventory_key_uniqueness": duplicates(detail, "inventory_key"),
        "detail_vs_fact_by_snapshot": _snapshot_mismatches(by_fact, by_detail, full),
        "kpis_vs_detail_by_snapshot": _snapshot_mismatches(by_detail, by_kpi, full),
        "slow_moving_view_vs_detail_by_snapshot": _snapshot_mismatches(slow_detail, slow_view, ["rows", "units"]),
        "aging_bucket_assignment": row_rules.select(F.col("bucket").alias("failed_count")),
        "slow_moving_definition": row_rules.select(F.col("slow").alias("failed_count")),
    }
    always = [_counted(name, INVENTORY_TEXTS[name], failed) for name, failed in counted.items()]
    when_failing = []
    for view in inventory.GROUPED:
        totals = _by_snapshot(inventory.grouped(w, view), rows=F.sum("fact_row_count"),
                              units=F.sum("inventory_units"), value=F.sum("inventory_value"))
        failed = _snapshot_mismatches(totals, by_detail, ["rows", "units"]).where("failed_count > 0")
        when_failing.append(_counted(f"{view}_vs_detail_by_snapshot", INVENTORY_VIEW_TEXT.format(view=view), failed))
    return union_all(always + when_failing).select(
        "check_name", pass_fail(F.col("failed_count") == 0).alias("status"), "failed_count", "details")


# -- service -------------------------------------------------------------------
# The wording of the service checks.
SERVICE_RULES: list[Rule] = [
    ("detail_appointment_uniqueness", "detail.rows", "detail.ids",
     "Canonical detail must contain exactly one row per appointment_id."),
    ("detail_vs_source_appointments", "detail.rows", "source.rows",
     "Canonical detail row count must equal staging appointments."),
    ("detail_vs_source_completed", "detail.completed_appointments", "source.completed_appointments",
     "Completed appointment count must match staging."),
    ("detail_vs_source_cancellations", "detail.cancellations", "source.cancellations",
     "Cancellation count must match staging."),
    ("detail_vs_source_no_shows", "detail.no_shows", "source.no_shows", "No-show count must match staging."),
    ("detail_repair_order_uniqueness", "detail.orders", "detail.order_ids",
     "Joining repair orders must not duplicate service_order_id."),
    ("detail_vs_fact_repair_orders", "detail.orders", "fact.orders",
     "Canonical detail repair orders must match fact_service."),
    ("detail_vs_fact_service_revenue", "detail.service_revenue", "fact.service_revenue",
     "Canonical detail service revenue must match fact_service without duplication."),
    ("kpis_vs_detail_appointments", "kpi.appointments", "detail.appointments",
     "KPI appointments must reconcile to detail."),
    ("kpis_vs_detail_service_revenue", "kpi.service_revenue", "detail.service_revenue",
     "KPI service revenue must reconcile to detail."),
    ("technician_view_repair_orders", "technician.orders", "fact.orders",
     "Technician repair orders must reconcile to fact_service."),
    ("technician_view_service_revenue", "technician.service_revenue", "fact.service_revenue",
     "Technician service revenue must reconcile to fact_service."),
    ("completed_appointments_have_one_order", "detail.completed_without_order", None,
     "Each completed appointment must resolve to exactly one service order."),
    ("service_cost_not_fabricated", "detail.fabricated_cost", None,
     "Cost and profit must remain NULL while authoritative service cost is unavailable."),
]
SERVICE_VIEW_METRICS = (
    ("appointments", "appointments"), ("completed_appointments", "completed appointments"),
    ("cancellations", "cancellations"), ("no_shows", "no-shows"), ("service_revenue", "service revenue"),
)


def service_checks(w) -> DataFrame:
    """29 rows over staged appointments, repair-order facts and the service views."""
    status = F.col("appointment_status")
    source = w.table("service_appointments").agg(
        F.count(ROWS).alias("rows"),
        F.count_if(status == "Completed").alias("completed_appointments"),
        F.count_if(status == "Cancelled").alias("cancellations"),
        F.count_if(status == "No Show").alias("no_shows"),
    )
    fact = w.table("fact_service").agg(
        F.count(ROWS).alias("orders"), _zero(F.sum("service_revenue")).alias("service_revenue"))
    invented = F.col("service_cost").isNotNull() | F.col("service_profit").isNotNull() | F.col("service_cost_available")
    detail = service.detail(w).agg(
        F.count(ROWS).alias("rows"),
        F.count_distinct("appointment_id").alias("ids"),
        F.sum("appointment_count").alias("appointments"),
        F.sum("completed_appointment_count").alias("completed_appointments"),
        F.sum("cancellation_count").alias("cancellations"),
        F.sum("no_show_count").alias("no_shows"),
        F.count("service_order_id").alias("orders"),
        F.count_distinct("service_order_id").alias("order_ids"),
        F.sum("service_revenue").alias("service_revenue"),
        F.count_if((status == "Completed") & F.col("service_order_id").isNull()).alias("completed_without_order"),
        F.count_if(invented).alias("fabricated_cost"),
    )
    names = [metric for metric, _ in SERVICE_VIEW_METRICS]
    views = {
        view: service.grouped(w, view).agg(*[F.sum(m).alias(m) for m in names]) for view in service.GROUPED
    }
    technician = service.technicians(w).agg(
        F.sum("repair_orders").alias("orders"), F.sum("service_revenue").alias("service_revenue"))
    rules = SERVICE_RULES + [
        (f"{view}_{metric}", f"{view}.{metric}", f"detail.{metric}", f"{view} {label} must reconcile to detail.")
        for metric, label in SERVICE_VIEW_METRICS for view in service.GROUPED
    ]
    kpi = service.kpis(w).select("appointments", "service_revenue")
    return reconciled(
        scalars(source=source, fact=fact, detail=detail, kpi=kpi, technician=technician, **views), rules)


# -- customers -----------------------------------------------------------------
# The wording of the customer checks.
CUSTOMER_RULES: list[Rule] = [
    ("detail_customer_uniqueness", "detail.customers", "detail.distinct_customers",
     "Canonical customer detail must contain one row per current customer."),
    ("detail_vs_current_customers", "detail.customers", "source.customers",
     "Customer detail count must match current dim_customer rows."),
    ("detail_vs_fact_sales_transactions", "detail.sales_transactions", "sales.transactions",
     "Customer sales transactions must reconcile without cross-product duplication."),
    ("detail_vs_fact_sales_revenue", "detail.sales_revenue", "sales.revenue",
     "Customer sales revenue must reconcile to signed fact_sales revenue."),
    ("detail_vs_fact_service_orders", "detail.service_orders", "service.orders",
     "Customer service orders must reconcile without cross-product duplication."),
    ("detail_vs_fact_service_revenue", "detail.service_revenue", "service.revenue",
     "Customer service revenue must reconcile to fact_service."),
    ("customer_revenue_formula", "detail.bad_revenue", None,
     "Customer revenue must equal sales revenue plus service revenue."),
    ("revenue_based_clv_formula", "detail.bad_value", None,
     "Interim customer lifetime value must equal customer revenue and use the declared method."),
    ("lifecycle_segments_are_exclusive", "detail.bad_lifecycle", None,
     "Prospect, New Customer, and Repeat Customer must follow lifetime interaction counts."),
    ("relationship_segments_are_exclusive", "detail.bad_relationship", None,
     "Sales Only, Service Only, Sales + Service, and No Activity must be mutually exclusive."),
    ("inactive_customer_definition", "detail.bad_inactive", None,
     "Inactive customers must be previously active and idle for more than 365 days as of warehouse activity."),
    ("kpis_vs_detail_customer_count", "kpi.total_customers", "detail.customers",
     "KPI total customers must reconcile to detail."),
    ("kpis_vs_detail_new_customers", "kpi.new_customers", "detail.new_customers",
     "KPI new customers must reconcile to detail."),
    ("kpis_vs_detail_repeat_customers", "kpi.repeat_customers", "detail.repeat_customers",
     "KPI repeat customers must reconcile to detail."),
    ("kpis_vs_detail_customer_revenue", "kpi.customer_revenue", "detail.customer_revenue",
     "KPI customer revenue must reconcile to detail."),
    ("kpis_vs_detail_clv", "kpi.total_customer_lifetime_value", "detail.customer_lifetime_value",
     "KPI customer lifetime value must reconcile to detail."),
    ("segment_summary_vs_detail_customers", "segment.customers", "detail.customers",
     "Customer segment summary must reconcile to detail customer count."),
    ("segment_summary_vs_detail_revenue", "segment.customer_revenue", "detail.customer_revenue",
     "Customer segment summary revenue must reconcile to detail."),
    ("frequency_summary_vs_detail_customers", "frequency.customers", "detail.customers",
     "Service frequency segments must reconcile to detail customer count."),
    ("frequency_summary_vs_detail_service_orders", "frequency.service_orders", "detail.service_orders",
     "Service frequency segment orders must reconcile to detail."),
]


def customer_checks(w) -> DataFrame:
    """20 rows over current customers, both facts and the customer views."""
    cents = F.lit(MONEY_TOLERANCE).cast("decimal(3,2)")
    c = F.col
    idle = c("last_activity_date").isNotNull() & (
        c("last_activity_date") < F.date_sub(c("as_of_date"), INACTIVE_DAYS))
    expected_lifecycle = customer.lifecycle(c("qualifying_interaction_count"))
    expected_relationship = customer.relationship(c("sales_transaction_count"), c("service_order_count"))
    detail = customer.detail(w).agg(
        F.count(ROWS).alias("customers"),
        F.count_distinct("customer_key").alias("distinct_customers"),
        F.sum("sales_transaction_count").alias("sales_transactions"),
        F.sum("service_order_count").alias("service_orders"),
        *[F.sum(n).alias(n) for n in
          ("sales_revenue", "service_revenue", "customer_revenue", "customer_lifetime_value")],
        F.count_if(c("lifecycle_segment") == "New Customer").alias("new_customers"),
        F.count_if(c("lifecycle_segment") == "Repeat Customer").alias("repeat_customers"),
        F.count_if(F.abs(c("customer_revenue") - (c("sales_revenue") + c("service_revenue"))) > cents)
        .alias("bad_revenue"),
        F.count_if((F.abs(c("customer_lifetime_value") - c("customer_revenue")) > cents)
                   | (c("clv_method") != CLV_METHOD)).alias("bad_value"),
        F.count_if(differs(c("lifecycle_segment"), expected_lifecycle)).alias("bad_lifecycle"),
        F.count_if(differs(c("relationship_segment"), expected_relationship)).alias("bad_relationship"),
        F.count_if(differs(c("activity_segment") == "Inactive", idle)).alias("bad_inactive"),
    )
    frames = {
        "detail": detail,
        "source": w.table("dim_customer").where("is_current").agg(F.count(ROWS).alias("customers")),
        "sales": _recognised(w).agg(
            F.count_if(c("sale_status") == "Completed").alias("transactions"),
            _zero(F.sum(c("sale_price") * c("unit_quantity"))).alias("revenue")),
        "service": w.table("fact_service").where(c("order_status") == "Completed").agg(
            F.count(ROWS).alias("orders"), _zero(F.sum("service_revenue")).alias("revenue")),
        "kpi": customer.kpis(w).select("total_customers", "new_customers", "repeat_customers",
                                       "customer_revenue", "total_customer_lifetime_value"),
        "segment": customer.segment_summary(w).agg(
            F.sum("customers").alias("customers"), F.sum("customer_revenue").alias("customer_revenue")),
        "frequency": customer.service_frequency(w).agg(
            F.sum("customers").alias("customers"), F.sum("service_orders").alias("service_orders")),
    }
    return reconciled(scalars(**frames), CUSTOMER_RULES)


# -- reporting views -------------------------------------------------------------
# The wording of the reporting-view checks.
REPORTING_RULES: list[Rule] = [
    ("vw_sales_performance_grain", "sales.rows", "sales.ids",
     "Power BI sales view must contain one row per eligible sale."),
    ("vw_sales_performance_revenue", "sales.revenue", "fact_sales.revenue",
     "Sales view revenue must reconcile to signed eligible fact_sales revenue."),
    ("vw_inventory_aging_grain", "stock.rows", "stock.ids",
     "Inventory view must contain one row per inventory_id and snapshot."),
    ("vw_inventory_aging_value", "stock.value", "fact_stock.value",
     "Inventory aging value must reconcile to fact_inventory."),
    ("vw_service_performance_grain", "visits.rows", "visits.ids",
     "Service view must contain one row per appointment."),
    ("vw_service_performance_revenue", "visits.revenue", "fact_service.revenue",
     "Service view revenue must reconcile to fact_service without duplication."),
    ("vw_customer_value_grain", "customers.rows", "customers.ids",
     "Customer value view must contain one row per current customer."),
    ("vw_customer_value_revenue", "customers.revenue", "earned.revenue",
     "Customer revenue must reconcile to eligible sales plus completed service revenue."),
    ("vw_dealership_performance_grain", "cards.rows", "cards.ids",
     "Dealership scorecard must contain one row per current dealership."),
    ("vw_dealership_performance_sales", "cards.sales", "sales_detail.revenue",
     "Dealership sales revenue must reconcile to canonical sales detail."),
    ("vw_dealership_performance_inventory", "cards.stock", "latest_stock.value",
     "Dealership inventory must reconcile to the latest canonical snapshot."),
    ("vw_dealership_performance_service", "cards.service", "visit_detail.revenue",
     "Dealership service revenue must reconcile to canonical appointment detail."),
]


def reporting_checks(w) -> DataFrame:
    """12 rows: grain and totals of the five reporting views."""
    def grain(frame: DataFrame, key: Column, **totals: str) -> DataFrame:
        return frame.agg(F.count(ROWS).alias("rows"), F.count_distinct(key).alias("ids"),
                         *[_zero(F.sum(c)).alias(n) for n, c in totals.items()])

    signed = _recognised(w).select((F.col("sale_price") * F.col("unit_quantity")).alias("revenue"))
    finished = w.table("fact_service").where(F.col("order_status") == "Completed")
    stock = inventory.detail(w)
    latest = stock.agg(F.max("snapshot_date_key").alias("k")).scalar()
    item = F.concat_ws(":", "inventory_id", F.col("snapshot_date").cast("string"))
    frames = {
        "sales": grain(reporting.sales_performance(w), F.col("sale_id"), revenue="revenue"),
        "fact_sales": _sums(signed, revenue="revenue"),
        "stock": grain(reporting.inventory_aging(w), item, value="inventory_value"),
        "fact_stock": _sums(w.table("fact_inventory"), value="carrying_cost"),
        "visits": grain(reporting.service_performance(w), F.col("appointment_id"), revenue="service_revenue"),
        "fact_service": _sums(w.table("fact_service"), revenue="service_revenue"),
        "customers": grain(reporting.customer_value(w), F.col("customer_id"), revenue="customer_revenue"),
        "earned": _sums(signed.unionAll(finished.select(F.col("service_revenue"))), revenue="revenue"),
        "cards": grain(reporting.dealership_performance(w), F.col("dealership_id"), sales="sales_revenue",
                       stock="inventory_value", service="service_revenue"),
        "sales_detail": _sums(sales.detail(w), revenue="revenue"),
        "latest_stock": _sums(stock.where(F.col("snapshot_date_key") == latest), value="inventory_value"),
        "visit_detail": _sums(service.detail(w), revenue="service_revenue"),
    }
    return reconciled(scalars(**frames), REPORTING_RULES)


# -- star model ------------------------------------------------------------------
MODEL_DIMENSIONS = (
    ("Customer", "dim_customer", "customer_key", None),
    ("Vehicle", "dim_vehicle", "vehicle_key", None),
    ("Dealership", "dim_dealership", "dealership_key", None),
    ("Salesperson", "dim_employee", "employee_key", SALES_ROLE),
    ("Advisor", "dim_employee", "employee_key", ADVISOR_ROLE),
    ("Technician", "dim_employee", "employee_key", TECHNICIAN_ROLE),
    ("Service", "dim_service", "service_key", None),
    ("Date", "dim_date", "date_key", None),
)
MODEL_KEYS = {
    "sales": {"Customer": "customer_key", "Vehicle": "vehicle_key", "Dealership": "dealership_key",
              "Salesperson": "salesperson_key", "Date": "sale_date_key"},
    "inventory": {"Vehicle": "vehicle_key", "Dealership": "dealership_key", "Date": "snapshot_date_key"},
    "service": {"Customer": "customer_key", "Vehicle": "vehicle_key", "Dealership": "dealership_key",
                "Advisor": "service_advisor_key", "Technician": "technician_key", "Service": "service_key",
                "Date": "appointment_date_key"},
}
OPTIONAL_DIMENSIONS = ("Technician",)


def _model_dimension_keys(w) -> DataFrame:
    frames = []
    for label, table, key, role in MODEL_DIMENSIONS:
        frame = w.table(table) if role is None else w.table(table).where(F.col("role") == role)
        frames.append(frame.select(F.lit(label).alias("dimension"), F.col(key).cast("bigint").alias("key")))
    return union_all(frames)


def _key_uses(details: dict[str, DataFrame]) -> DataFrame:
    """(dimension, key, rows) over all facts: unpivoted, then counted, so hot keys collapse map-side."""
    frames = []
    for fact, columns in MODEL_KEYS.items():
        pairs = F.array(*[
            F.struct(F.lit(d).alias("dimension"), F.col(c).cast("bigint").alias("key")) for d, c in columns.items()
        ])
        frames.append(details[fact].select(F.inline(pairs)).groupBy("dimension", "key")
                      .agg(F.count(ROWS).alias("uses")))
    return union_all(frames)


def _bad_keys(w, details: dict[str, DataFrame]) -> DataFrame:
    known = _model_dimension_keys(w).select("dimension", "key", F.lit(True).alias("known"))
    uses = _key_uses(details).join(known, ["dimension", "key"], "left")
    bad = (F.col("key").isNull() & ~F.col("dimension").isin(*OPTIONAL_DIMENSIONS)) | (
        F.col("key").isNotNull() & F.col("known").isNull())
    return uses.where(bad).agg(_zero(F.sum("uses")).alias("failed_count"))


def _repeated(frame: DataFrame, *keys: str) -> DataFrame:
    """One row: key groups with more than one row or with a NULL in the last key."""
    return (frame.groupBy(*keys).agg(F.count(ROWS).alias("n"))
            .where((F.col("n") > 1) | F.col(keys[-1]).isNull())
            .agg(F.count(ROWS).alias("failed_count")))


def _event_days(w) -> DataFrame:
    return union_all([
        w.table("dim_date").select(F.col("full_date").alias("d")),
        w.table("fact_service").select(F.col("promised_at").cast("date").alias("d")),
        w.table("dim_customer").select(F.col("customer_since_date").alias("d")),
    ])


def event_bounds(w) -> DataFrame:
    """The full calendar years around every event day, as one row."""
    return _event_days(w).agg(
        F.trunc(F.min("d"), "year").alias("first"),
        F.date_sub(F.add_months(F.trunc(F.max("d"), "year"), 12), 1).alias("last"),
    )


def _outside_bounds(w) -> DataFrame:
    bounds = event_bounds(w)
    outside = (F.col("d") < bounds.select("first").scalar()) | (F.col("d") > bounds.select("last").scalar())
    return _event_days(w).agg(F.count_if(outside).alias("failed_count"))


# The columns of the details that the star-model checks read.
MODEL_READS = {
    "sales_detail": ("sales_key", *MODEL_KEYS["sales"].values(), "sale_status", "units_sold", "revenue", "vehicle_cost"),
    "inventory_detail": ("inventory_key", *MODEL_KEYS["inventory"].values(), "days_in_inventory", "is_slow_moving", "aging_bucket_sort"),
    "service_detail": ("appointment_id", *MODEL_KEYS["service"].values(), "service_order_id", "service_fact_key",
                       "service_cost_available", "service_cost", "service_profit"),
}


def _read_once(w) -> Callable[[str], DataFrame]:
    """The details by name; of one that isn't built yet, the columns that the checks read are joined and written once."""
    if w.store is None:
        return w.table
    stage, kept = written_stages(w.store.spark), {}

    def read(name: str) -> DataFrame:
        if w.has(name):
            return w.table(name)
        if name not in kept:
            kept[name] = stage(name, w.plan(name).select(*MODEL_READS[name]))
        return kept[name]

    return read


def model_check_counts(w, detail: Callable[[str], DataFrame] | None = None) -> dict[str, Callable[[], DataFrame]]:
    """Check name -> one-row failed_count frame, for the 16 star-model checks.

    A check builds the views that it reads, no others.
    """
    c, few, detail = F.col, Planned(w) if detail else w, detail or w.table
    sold, stock, visits = partial(detail, "sales_detail"), partial(detail, "inventory_detail"), partial(detail, "service_detail")

    def gap(left: DataFrame, right: DataFrame) -> DataFrame:
        signed = union_all([left.agg(F.count(ROWS).alias("n")), right.agg((-F.count(ROWS)).alias("n"))])
        return signed.agg(F.abs(F.sum("n")).alias("failed_count"))

    def wrong(frame: DataFrame, condition: Column) -> DataFrame:
        return frame.agg(F.count_if(condition).alias("failed_count"))

    def fact_grain() -> DataFrame:
        return union_all([_repeated(sold(), "sales_key"), _repeated(stock(), "inventory_key"),
                          _repeated(visits(), "appointment_id")]).agg(F.sum("failed_count").alias("failed_count"))

    def enriched() -> DataFrame:
        orders = w.table("fact_service").select("service_fact_key")
        return gap(visits().select("service_fact_key").join(orders, "service_fact_key", "left"), visits())

    def contiguous() -> DataFrame:
        day = c("full_date")
        whole = (F.count(ROWS) > 0) & (F.count(ROWS) == F.count_distinct(day)) & (
            F.count(ROWS) == F.datediff(F.max(day), F.min(day)) + 1)
        return w.table("dim_date").agg(F.when(whole, 0).otherwise(1).alias("failed_count"))

    days = c("days_in_inventory")
    plain_bucket = F.when(days <= 30, 1).when(days <= 60, 2).when(days <= 90, 3).when(days <= 120, 4).otherwise(5)
    sign_broken = (
        (c("sale_status") == "Returned") & ((c("units_sold") != -1) | (c("revenue") > 0) | (c("vehicle_cost") > 0))
    ) | ((c("sale_status") == "Completed") & ((c("units_sold") != 1) | (c("revenue") < 0) | (c("vehicle_cost") < 0)))
    return {
        "dimension_key_uniqueness": lambda: _repeated(_model_dimension_keys(w), "dimension", "key"),
        "fact_grain_uniqueness": fact_grain,
        "required_foreign_keys_and_role_alignment": lambda: _bad_keys(w, {"sales": sold(), "inventory": stock(), "service": visits()}),
        "inventory_composite_grain":
            lambda: duplicates(stock(), "vehicle_key", "dealership_key", "snapshot_date_key"),
        "repair_order_unique_within_appointments":
            lambda: duplicates(visits().where(c("service_order_id").isNotNull()), "service_order_id"),
        "service_status_enrichment_preserves_grain": enriched,
        "appointments_not_lost": lambda: gap(w.table("service_appointments"), visits()),
        "sales_eligible_rows_preserved": lambda: gap(_recognised(few), sold()),
        "inventory_rows_preserved": lambda: gap(few.table("fact_inventory"), stock()),
        "calendar_source_unique_contiguous": contiguous,
        "full_year_calendar_bounds_cover_event_dates": lambda: _outside_bounds(w),
        "calendar_bounds_available": lambda: event_bounds(w).select(
            F.when(c("first").isNull() | c("last").isNull(), 1).otherwise(0).alias("failed_count")),
        "date_key_matches_date": lambda: wrong(w.table("dim_date"), c("date_key") != date_key("full_date")),
        "signed_return_values": lambda: wrong(sold(), sign_broken),
        "service_costs_not_fabricated": lambda: wrong(
            visits(), ~c("service_cost_available") & (c("service_cost").isNotNull() | c("service_profit").isNotNull())),
        "slow_moving_and_bucket_boundaries": lambda: wrong(
            stock(), (c("is_slow_moving") != (days > SLOW_DAYS)) | (c("aging_bucket_sort") != plain_bucket)),
    }


def model_checks(w, only: str | None = None) -> DataFrame:
    """The star-model checks as rows (check_name, failed_count, status)."""
    counts = model_check_counts(w, None if only else _read_once(w))
    names = [only] if only else list(counts)
    rows = union_all([
        counts[name]().select(F.lit(name).alias("check_name"), F.col("failed_count").cast("bigint")) for name in names
    ])
    return rows.select("check_name", "failed_count", pass_fail(F.col("failed_count") == 0).alias("status"))


SUITES: dict[str, Callable[..., DataFrame]] = {
    "data_quality": quality_checks,
    "sales": sales_checks,
    "inventory": inventory_checks,
    "service": service_checks,
    "customers": customer_checks,
    "reporting_views": reporting_checks,
    "star_model": model_checks,
}


def suite_summary(w) -> DataFrame:
    """Rows and non-PASS rows of every suite."""
    parts = []
    for name, suite in SUITES.items():
        parts.append(suite(w).agg(
            F.lit(name).alias("suite"), F.count(ROWS).alias("checks"),
            F.count_if(~F.col("status").eqNullSafe("PASS")).alias("not_passed")))
    return union_all(parts)


def require_all_suites(w) -> int:
    """Run every suite as a gate; return the number of checks that passed."""
    return sum(require_all_pass(suite(w), name) for name, suite in SUITES.items())

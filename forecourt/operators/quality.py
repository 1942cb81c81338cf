"""The 28 warehouse data-quality checks and their gate.

Row rules over the same table share one pass; uniqueness rules aggregate on the key; orphan
rules compare distinct keys (``keysets``). Every check yields one number.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import (
    ADVISOR_ROLE,
    MONEY_TOLERANCE,
    SALES_ROLE,
    SHARED_ORDER_COLUMNS,
    SLOW_DAYS,
    TECHNICIAN_ROLE,
)
from forecourt.functions.numeric import differs
from forecourt.operators.keysets import Dangling, Link
from forecourt.operators.scoring import duplicates, failures, pass_fail, summed, union_all
from forecourt.operators.warehouse import sale_units
from forecourt.sources.store import written_stages

# Category, name and advice of every check.
TEXTS: dict[str, tuple[str, str, str]] = {
    "dq_01": ("duplicates", "dim_customer duplicate current customer_id",
              "Keep exactly one current dimension row per customer_id."),
    "dq_02": ("duplicates", "dim_vehicle duplicate vehicle_id or vin",
              "Each vehicle_id and VIN must identify one vehicle."),
    "dq_03": ("duplicates", "dim_employee duplicate current employee_id",
              "Keep exactly one current dimension row per employee_id."),
    "dq_04": ("duplicates", "dim_dealership duplicate dealership_id",
              "Each dealership_id must identify one dealership."),
    "dq_05": ("duplicates", "dim_service duplicate service_type",
              "Each service_type must identify one service dimension row."),
    "dq_06": ("duplicate_facts", "fact_sales duplicate sale_id", "fact_sales grain is one row per sale_id."),
    "dq_07": ("duplicate_facts", "fact_inventory duplicate vehicle snapshot",
              "fact_inventory grain is one vehicle per dealership and snapshot date."),
    "dq_08": ("duplicate_facts", "fact_service duplicate order or appointment",
              "Each service_order_id and appointment_id must occur once."),
    "dq_09": ("missing_foreign_keys", "fact_sales missing foreign keys",
              "Populate date, customer, vehicle, dealership, and salesperson keys."),
    "dq_10": ("missing_foreign_keys", "fact_inventory missing foreign keys",
              "Populate snapshot date, vehicle, and dealership keys."),
    "dq_11": ("missing_foreign_keys", "fact_service missing foreign keys",
              "Populate date, customer, vehicle, dealership, advisor, technician, and service keys."),
    "dq_12": ("orphan_records", "dim_employee orphan dealership",
              "Every employee dealership_key must resolve to dim_dealership."),
    "dq_13": ("orphan_records", "fact_sales orphan dimension keys",
              "Every fact_sales foreign key must resolve to its conformed dimension."),
    "dq_14": ("orphan_records", "fact_inventory orphan dimension keys",
              "Every fact_inventory foreign key must resolve to its conformed dimension."),
    "dq_15": ("orphan_records", "fact_service orphan dimension keys",
              "Every fact_service foreign key must resolve to its conformed dimension."),
    "dq_16": ("relationship_integrity", "fact_sales salesperson alignment",
              "The salesperson must be a Sales Consultant assigned to the sale dealership."),
    "dq_17": ("relationship_integrity", "fact_service employee alignment",
              "Service advisors and technicians must have the expected role and match the service dealership."),
    "dq_18": ("relationship_integrity", "service order appointment mismatch",
              "Order and appointment customer, vehicle, dealership, and advisor identifiers must agree."),
    "dq_19": ("relationship_integrity", "fact_sales unit sign",
              "Returned sales must use -1 units; completed and cancelled rows must use +1."),
    "dq_20": ("invalid_dates", "dimension dates outside valid order",
              "Customer, dealership, and employee dates must not be in the future; "
              "effective ranges must be ordered."),
    "dq_21": ("invalid_dates", "fact_sales invalid or future sale date",
              "The sale date key must resolve to a nonfuture calendar date."),
    "dq_22": ("invalid_dates", "fact_inventory invalid acquisition or snapshot date",
              "Acquisition must be on or before the inventory snapshot and days_in_inventory must match."),
    "dq_23": ("invalid_dates", "fact_service invalid timestamp order or date key",
              "Opened time must precede promised/completed time and completed_date_key must match completed_at."),
    "dq_24": ("invalid_prices", "fact_sales invalid price relationship",
              "Prices and costs must be nonnegative; discount cannot exceed list price; "
              "derived amounts must reconcile within two cents."),
    "dq_25": ("invalid_prices", "fact_inventory invalid carrying value or age",
              "Inventory carrying cost and age must be nonnegative."),
    "dq_26": ("invalid_prices", "fact_service invalid revenue relationship",
              "Service components must be nonnegative and reconcile to service_revenue within two cents."),
    "dq_27": ("negative_revenue", "fact_sales negative revenue",
              "Investigate or model returns separately; completed sale revenue cannot be negative."),
    "dq_28": ("negative_revenue", "fact_service negative revenue",
              "Investigate refunds separately; completed service revenue cannot be negative."),
}

SALES_LINKS = (
    ("sale_date_key", "dim_date", "date_key"),
    ("customer_key", "dim_customer", "customer_key"),
    ("vehicle_key", "dim_vehicle", "vehicle_key"),
    ("dealership_key", "dim_dealership", "dealership_key"),
    ("salesperson_key", "dim_employee", "employee_key"),
)
INVENTORY_LINKS = (
    ("snapshot_date_key", "dim_date", "date_key"),
    ("vehicle_key", "dim_vehicle", "vehicle_key"),
    ("dealership_key", "dim_dealership", "dealership_key"),
)
SERVICE_LINKS = (
    ("completed_date_key", "dim_date", "date_key"),
    ("customer_key", "dim_customer", "customer_key"),
    ("vehicle_key", "dim_vehicle", "vehicle_key"),
    ("dealership_key", "dim_dealership", "dealership_key"),
    ("service_advisor_key", "dim_employee", "employee_key"),
    ("technician_key", "dim_employee", "employee_key"),
    ("service_key", "dim_service", "service_key"),
)


def _any(conditions: list[Column]) -> Column:
    """OR of conditions in which NULL counts as false."""
    result = F.lit(False)
    for condition in conditions:
        result = result | F.coalesce(condition, F.lit(False))
    return result


def _missing(links) -> Column:
    return _any([F.col(column).isNull() for column, _, _ in links])


def _orphans(w, fact: str, links) -> DataFrame:
    """Rows of a fact with at least one key that no dimension row carries (each row counted once)."""
    frame = w.table(fact).select(*[column for column, _, _ in links])
    sets = [Link(column, w.table(dimension), key) for column, dimension, key in links]
    return Dangling(frame, sets, written_stages(frame.sparkSession), fact).unresolved(frame)


def _off(left: Column, right: Column) -> Column:
    return F.abs(left - right) > F.lit(MONEY_TOLERANCE).cast("decimal(3,2)")


# -- row rules, one condition per fact table ---------------------------------
def _price_rule() -> Column:
    listed, discount, price, cost, profit = (
        F.col(c) for c in ("list_price", "discount_amount", "sale_price", "vehicle_cost", "gross_profit")
    )
    negative = [c < 0 for c in (listed, discount, price, cost)]
    return _any([*negative, discount > listed, _off(listed - discount, price), _off(price - cost, profit)])


def _service_amount_rule() -> Column:
    labor, parts, discount, revenue = (
        F.col(c) for c in ("labor_revenue", "parts_revenue", "discount_amount", "service_revenue")
    )
    return _any([labor < 0, parts < 0, discount < 0, discount > labor + parts,
                 _off(labor + parts - discount, revenue)])


ROW_RULES: dict[str, tuple[str, Callable[[], Column]]] = {
    "dq_09": ("fact_sales", lambda: _missing(SALES_LINKS)),
    "dq_10": ("fact_inventory", lambda: _missing(INVENTORY_LINKS)),
    "dq_11": ("fact_service", lambda: _missing(SERVICE_LINKS)),
    "dq_19": ("fact_sales", lambda: differs(F.col("unit_quantity"), sale_units(F.col("sale_status")))),
    "dq_24": ("fact_sales", _price_rule),
    "dq_25": ("fact_inventory", lambda: _any([
        F.col("carrying_cost") < 0, F.col("days_in_inventory") < 0, F.col("on_hand_quantity") != 1])),
    "dq_26": ("fact_service", _service_amount_rule),
    "dq_27": ("fact_sales", lambda: F.col("sale_price") < 0),
    "dq_28": ("fact_service", lambda: F.col("service_revenue") < 0),
}


# -- rules that need a key aggregate or a lookup ------------------------------
def _seller_alignment(w, as_of) -> DataFrame:
    staff = w.table("dim_employee").select(
        F.col("employee_key").alias("salesperson_key"), "role", F.col("dealership_key").alias("home"))
    # Rows are counted by seller and dealership before anything is joined.
    sales = w.table("fact_sales").groupBy("salesperson_key", "dealership_key").agg(F.count("*").alias("n")).join(staff, "salesperson_key")
    return _rows_failing(sales, (F.col("role") != SALES_ROLE) | (F.col("home") != F.col("dealership_key")))


def _rows_failing(counted: DataFrame, condition: Column) -> DataFrame:
    return counted.agg(F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias("failed_count"))


def _service_alignment(w, as_of) -> DataFrame:
    frame = w.table("fact_service").groupBy("service_advisor_key", "technician_key", "dealership_key").agg(F.count("*").alias("n"))
    wrong = []
    for column, role in (("service_advisor_key", ADVISOR_ROLE), ("technician_key", TECHNICIAN_ROLE)):
        staff = w.table("dim_employee").select(
            F.col("employee_key").alias(column), F.col("role").alias(f"{column}_role"),
            F.col("dealership_key").alias(f"{column}_home"))
        frame = frame.join(staff, column)
        wrong += [F.col(f"{column}_role") != role, F.col(f"{column}_home") != F.col("dealership_key")]
    return _rows_failing(frame, _any(wrong))


def _order_mismatch(w, as_of) -> DataFrame:
    visits = w.table("service_appointments").select(
        "appointment_id", *[F.col(c).alias(f"visit_{c}") for c in SHARED_ORDER_COLUMNS])
    orders = w.table("service_orders").select("appointment_id", *SHARED_ORDER_COLUMNS)
    return failures(orders.join(visits, "appointment_id"),
                    _any([differs(F.col(c), F.col(f"visit_{c}")) for c in SHARED_ORDER_COLUMNS]))


def _dimension_dates(w, as_of) -> DataFrame:
    return summed(*[
        failures(w.table(name), _any([F.col(day) > as_of, F.col("effective_from") > F.col("effective_to")]))
        for name, day in (("dim_customer", "customer_since_date"), ("dim_dealership", "opened_date"),
                          ("dim_employee", "hire_date"))
    ])


def _with_day(w, fact: str, key: str) -> DataFrame:
    return w.table(fact).join(
        w.table("dim_date").select(F.col("date_key").alias(key), "full_date"), key)


def _sale_dates(w, as_of) -> DataFrame:
    return failures(_with_day(w, "fact_sales", "sale_date_key"), F.col("full_date") > as_of)


def _stock_dates(w, as_of) -> DataFrame:
    age = F.datediff("full_date", "acquired_date")
    return failures(_with_day(w, "fact_inventory", "snapshot_date_key"), _any([
        F.col("acquired_date") > F.col("full_date"),
        F.col("days_in_inventory") != age,
        differs(F.col("slow_moving_flag"), age > SLOW_DAYS),
    ]))


def _service_dates(w, as_of) -> DataFrame:
    finished = F.col("completed_at").cast("date")
    return failures(_with_day(w, "fact_service", "completed_date_key"), _any([
        F.col("opened_at") > F.col("promised_at"),
        F.col("opened_at") > F.col("completed_at"),
        F.col("full_date") != finished,
        finished > as_of,
    ]))


def _current_duplicates(table: str, key: str) -> Callable[..., DataFrame]:
    return lambda w, as_of: duplicates(w.table(table).where("is_current"), key)


def _duplicates(*grains: tuple[str, tuple[str, ...]]) -> Callable[..., DataFrame]:
    return lambda w, as_of: summed(*[duplicates(w.table(table), *keys) for table, keys in grains])


def _employee_orphans(w, as_of) -> DataFrame:
    return _orphans(w, "dim_employee", (("dealership_key", "dim_dealership", "dealership_key"),))


KEY_RULES: dict[str, Callable[..., DataFrame]] = {
    "dq_01": _current_duplicates("dim_customer", "customer_id"),
    "dq_02": _duplicates(("dim_vehicle", ("vehicle_id",)), ("dim_vehicle", ("vin",))),
    "dq_03": _current_duplicates("dim_employee", "employee_id"),
    "dq_04": _duplicates(("dim_dealership", ("dealership_id",))),
    "dq_05": _duplicates(("dim_service", ("service_type",))),
    "dq_06": _duplicates(("fact_sales", ("sale_id",))),
    "dq_07": _duplicates(("fact_inventory", ("vehicle_key", "dealership_key", "snapshot_date_key"))),
    "dq_08": _duplicates(("fact_service", ("service_order_id",)), ("fact_service", ("appointment_id",))),
    "dq_12": _employee_orphans,
    "dq_13": lambda w, as_of: _orphans(w, "fact_sales", SALES_LINKS),
    "dq_14": lambda w, as_of: _orphans(w, "fact_inventory", INVENTORY_LINKS),
    "dq_15": lambda w, as_of: _orphans(w, "fact_service", SERVICE_LINKS),
    "dq_16": _seller_alignment,
    "dq_17": _service_alignment,
    "dq_18": _order_mismatch,
    "dq_20": _dimension_dates,
    "dq_21": _sale_dates,
    "dq_22": _stock_dates,
    "dq_23": _service_dates,
}


def _row(check_id: str, failed: Column) -> Column:
    category, name, details = TEXTS[check_id]
    return F.struct(F.lit(category).alias("check_category"), F.lit(name).alias("check_name"),
                    failed.cast("bigint").alias("failed_count"), F.lit(details).alias("details"))


def _finish(rows: DataFrame) -> DataFrame:
    return rows.select("check_category", "check_name", pass_fail(F.col("failed_count") == 0).alias("status"),
                       "failed_count", "details")


def _as_of(day) -> Column:
    return F.current_date() if day is None else F.lit(day).cast("date")


def check(w, check_id: str, as_of=None) -> DataFrame:
    """One check as one row."""
    if check_id in ROW_RULES:
        table, rule = ROW_RULES[check_id]
        counted = failures(w.table(table), rule())
    else:
        counted = KEY_RULES[check_id](w, _as_of(as_of))
    return _finish(counted.select(F.inline(F.array(_row(check_id, F.col("failed_count"))))))


def checks(w, as_of=None) -> DataFrame:
    """All checks, sorted by category and name; row rules of a table share one pass."""
    by_table: dict[str, list[str]] = {}
    for check_id, (table, _) in ROW_RULES.items():
        by_table.setdefault(table, []).append(check_id)
    parts = []
    for table, ids in by_table.items():
        counts = w.table(table).agg(*[F.count_if(ROW_RULES[i][1]()).alias(i) for i in ids])
        parts.append(counts.select(F.inline(F.array(*[_row(i, F.col(i)) for i in ids]))))
    for check_id, rule in KEY_RULES.items():
        parts.append(rule(w, _as_of(as_of)).select(F.inline(F.array(_row(check_id, F.col("failed_count"))))))
    return _finish(union_all(parts)).orderBy("check_category", "check_name")

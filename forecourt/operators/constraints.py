"""Load gate: table constraints as violation counts, and source-to-warehouse row reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import DATASETS, WAREHOUSE_DOMAINS
from forecourt.operators.scoring import CheckFailure, duplicates, union_all


def _in(column: str) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in WAREHOUSE_DOMAINS[column])})"


ORDERED_VERSIONS = "effective_from <= effective_to"

# Row constraints of the star schema (a NULL result passes, as in SQL CHECK).
ROW_CONSTRAINTS: dict[str, dict[str, str]] = {
    "dim_date": {
        "day_of_week": "day_of_week BETWEEN 1 AND 7",
        "day_of_month": "day_of_month BETWEEN 1 AND 31",
        "day_of_year": "day_of_year BETWEEN 1 AND 366",
        "week_of_year": "week_of_year BETWEEN 1 AND 53",
        "month_number": "month_number BETWEEN 1 AND 12",
        "quarter_number": "quarter_number BETWEEN 1 AND 4",
        "calendar_year": "calendar_year BETWEEN 2000 AND 2200",
    },
    "dim_dealership": {"effective_dates": ORDERED_VERSIONS},
    "dim_customer": {"customer_type": _in("customer_type"), "effective_dates": ORDERED_VERSIONS},
    "dim_vehicle": {
        "model_year": "model_year BETWEEN 1980 AND 2200",
        "vehicle_condition": _in("vehicle_condition"),
        "mileage": "mileage_at_acquisition >= 0",
        "msrp": "manufacturer_msrp >= 0",
    },
    "dim_employee": {
        "role": _in("role"), "employment_status": _in("employment_status"), "effective_dates": ORDERED_VERSIONS,
    },
    "dim_service": {},
    "fact_sales": {
        "sales_channel": _in("sales_channel"),
        "payment_type": _in("payment_type"),
        "sale_status": _in("sale_status"),
        "amounts": "least(list_price, discount_amount, sale_price, vehicle_cost) >= 0 "
                   "AND abs(list_price - discount_amount - sale_price) <= 0.02 "
                   "AND abs(sale_price - vehicle_cost - gross_profit) <= 0.02",
        "units": "unit_quantity = CASE sale_status WHEN 'Returned' THEN -1 ELSE 1 END",
    },
    "fact_inventory": {
        "inventory_status": _in("inventory_status"),
        "values": "carrying_cost >= 0 AND days_in_inventory >= 0 AND on_hand_quantity = 1",
    },
    "fact_service": {
        "timestamp_order": "opened_at <= promised_at AND opened_at <= completed_at",
        "order_status": _in("order_status"),
        "payer_type": _in("payer_type"),
        "amounts": "least(labor_revenue, parts_revenue, discount_amount, service_revenue) >= 0 "
                   "AND abs(labor_revenue + parts_revenue - discount_amount - service_revenue) <= 0.02",
        "quantity": "repair_order_quantity = 1",
    },
}
UNIQUE: dict[str, tuple[tuple[str, ...], ...]] = {
    "dim_date": (("date_key",), ("full_date",)),
    "dim_dealership": (("dealership_key",), ("dealership_id",)),
    "dim_customer": (("customer_key",), ("customer_id", "effective_from")),
    "dim_vehicle": (("vehicle_key",), ("vehicle_id",), ("vin",)),
    "dim_employee": (("employee_key",), ("employee_id", "effective_from")),
    "dim_service": (("service_key",), ("service_type",)),
    "fact_sales": (("sales_key",), ("sale_id",)),
    "fact_inventory": (("inventory_key",), ("inventory_id", "snapshot_date_key"),
                       ("vehicle_key", "dealership_key", "snapshot_date_key")),
    "fact_service": (("service_fact_key",), ("service_order_id",), ("appointment_id",)),
}
ONE_CURRENT = {"dim_customer": "customer_id", "dim_employee": "employee_id"}
LENGTHS: dict[str, dict[str, int]] = {
    "dim_dealership": {"dealership_id": 20, "dealership_name": 150, "city": 100, "state": 50, "postal_code": 20,
                       "region": 50},
    "dim_customer": {"customer_id": 20, "first_name": 100, "last_name": 100, "email": 320, "phone": 30, "city": 100,
                     "state": 50, "postal_code": 20, "customer_type": 20},
    "dim_vehicle": {"vehicle_id": 20, "vin": 17, "make": 60, "model": 60, "body_type": 30, "fuel_type": 30,
                    "color": 30, "vehicle_condition": 10},
    "dim_employee": {"employee_id": 20, "first_name": 100, "last_name": 100, "role": 40, "employment_status": 10},
    "dim_service": {"service_type": 50, "service_category": 50},
    "fact_sales": {"sale_id": 20, "sales_channel": 20, "payment_type": 20, "sale_status": 20},
    "fact_inventory": {"inventory_id": 20, "inventory_status": 30},
    "fact_service": {"service_order_id": 20, "appointment_id": 20, "order_status": 20, "payer_type": 20},
}
NULLABLE = {"dim_customer": ("email", "phone", "city", "state", "postal_code"), "dim_vehicle": ("color",)}


def violations(w) -> DataFrame:
    """(table, constraint, violations): row rules in one pass per table, uniqueness per key."""
    parts = []
    for table, rules in ROW_CONSTRAINTS.items():
        frame = w.table(table)
        broken = {name: F.expr(f"NOT ({rule})") for name, rule in rules.items()}
        required = [c for c in frame.columns if c not in NULLABLE.get(table, ())]
        absent = F.lit(False)
        for c in required:
            absent = absent | F.col(c).isNull()
        broken["not_null"] = absent
        too_long = F.lit(False)
        for c, limit in LENGTHS.get(table, {}).items():
            too_long = too_long | F.coalesce(F.length(c) > limit, F.lit(False))
        if table in LENGTHS:
            broken["lengths"] = too_long
        counts = frame.agg(*[F.count_if(condition).alias(name) for name, condition in broken.items()])
        rows = F.array(*[F.struct(F.lit(table).alias("table"), F.lit(name).alias("constraint"),
                                  F.col(name).alias("violations")) for name in broken])
        parts.append(counts.select(F.inline(rows)))
        uniques = [(f"unique({', '.join(keys)})", duplicates(frame, *keys)) for keys in UNIQUE[table]]
        if table in ONE_CURRENT:
            uniques.append((f"one current {ONE_CURRENT[table]}",
                            duplicates(frame.where("is_current"), ONE_CURRENT[table])))
        for name, repeated in uniques:
            parts.append(repeated.select(F.lit(table).alias("table"), F.lit(name).alias("constraint"),
                                         F.col("failed_count").alias("violations")))
    return union_all(parts)


def require_constraints(w) -> None:
    """Gate: raise when any constraint is violated."""
    broken = violations(w).where("violations > 0").collect()
    if broken:
        raise CheckFailure("constraints violated: " + "; ".join(
            f"{r['table']}.{r['constraint']}={r['violations']}" for r in broken))


# The dataset that each warehouse table must match row for row.
ROW_SOURCES = {
    "dim_customer": "customers", "dim_vehicle": "vehicles", "dim_dealership": "dealerships",
    "dim_employee": "employees", "fact_sales": "sales", "fact_inventory": "inventory",
    "fact_service": "service_orders",
}


def row_reconciliation(w) -> DataFrame:
    """(table, expected, actual, status) for the seven loaded tables, and non-emptiness of the two derived ones."""
    def counted(name: str, column: str) -> DataFrame:
        return w.table(name).agg(F.count("*").alias(column))

    parts = []
    for table, source in ROW_SOURCES.items():
        both = counted(source, "expected").unionByName(counted(table, "actual"), allowMissingColumns=True)
        parts.append(both.agg(F.lit(table).alias("table"), F.max("expected").alias("expected"),
                              F.max("actual").alias("actual")))
    for table in ("dim_date", "dim_service"):
        parts.append(counted(table, "actual").select(
            F.lit(table).alias("table"), F.lit(None).cast("bigint").alias("expected"), "actual"))
    matches = F.when(F.col("expected").isNull(), F.col("actual") > 0).otherwise(F.col("expected") == F.col("actual"))
    return union_all(parts).withColumn("status", F.when(matches, "PASS").otherwise("FAIL"))


def require_row_counts(w) -> dict[str, int]:
    """Gate: raise on a mismatch; return the row count of every warehouse table."""
    rows = row_reconciliation(w).collect()
    wrong = [f"{r['table']}: expected {r['expected']}, got {r['actual']}" for r in rows if r["status"] != "PASS"]
    if wrong:
        raise CheckFailure("row-count validation failed: " + "; ".join(wrong))
    return {r["table"]: r["actual"] for r in rows}


def staged_counts(w) -> DataFrame:
    """Rows of every source dataset."""
    return union_all([w.table(name).agg(F.lit(name).alias("dataset"), F.count("*").alias("rows")) for name in DATASETS])

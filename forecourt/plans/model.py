"""The twelve semantic-model tables: projections of the star schema without personal data."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import ADVISOR_ROLE, SALES_ROLE, TECHNICIAN_ROLE
from forecourt.functions.calendar import days_between, describe_report_days
from forecourt.functions.keys import date_key
from forecourt.operators.keysets import Link, Stage, dangling
from forecourt.operators.reconcile import event_bounds
from forecourt.plans import inventory, narrow, sales, service
from forecourt.plans.sales import full_name
from forecourt.plans.warehouse import Planned
from forecourt.sources.store import written_stages

VEHICLE_LABELS = ("brand", "model", "model_year", "vehicle_type")

# The retained columns of each model table, in order.
CUSTOMER_COLUMNS = (
    "customer_key", "customer_id", "customer_type", "city", "state", "postal_code", "customer_since_date",
    "effective_from", "effective_to", "is_current",
)
VEHICLE_COLUMNS = (
    "vehicle_key", "vehicle_id", "brand", "model", "model_year", "vehicle_type", "fuel_type",
    "vehicle_condition", "color",
)
DEALERSHIP_COLUMNS = (
    "dealership_key", "dealership_id", "dealership_name", "city", "state", "region", "postal_code", "opened_date",
)
SERVICE_KIND_COLUMNS = ("service_key", "service_type", "service_category", "is_active")
EMPLOYEE_COLUMNS = (
    "employee_key", "employee_id", "employee_name", "role", "employment_status", "hire_date",
    "effective_from", "effective_to", "is_current",
)
SALES_COLUMNS = (
    "sales_key", "sale_id", "sale_date_key", "customer_key", "vehicle_key", "dealership_key", "salesperson_key",
    "sales_channel", "payment_type", "sale_status", "units_sold", "list_price", "discount_amount", "revenue",
    "vehicle_cost", "gross_profit",
)
INVENTORY_COLUMNS = (
    "inventory_key", "inventory_id", "snapshot_date_key", "vehicle_key", "dealership_key", "acquired_date",
    "acquired_date_key", "inventory_status", "inventory_units", "inventory_value", "days_in_inventory",
    "aging_bucket", "aging_bucket_sort", "is_slow_moving",
)
SERVICE_COLUMNS = (
    "appointment_id", "appointment_date_key", "customer_key", "vehicle_key", "dealership_key",
    "service_advisor_key", "technician_key", "service_key", "service_order_id", "appointment_status",
    "appointment_count", "completed_appointment_count", "cancellation_count", "no_show_count",
    "completion_eligible_count", "repair_order_quantity", "payer_type", "opened_at", "promised_at", "completed_at",
    "opened_date_key", "promised_date_key", "completed_date_key", "completed_on_time", "turnaround_hours",
    "labor_revenue", "parts_revenue", "discount_amount", "service_revenue", "service_cost", "service_profit",
    "service_cost_available", "order_status",
)

# Fixed values: (dimension, key, fact, foreign key) of the model relationships.
RELATIONSHIPS = (
    ("dim_date", "date_key", "fact_sales", "sale_date_key"),
    ("dim_customer", "customer_key", "fact_sales", "customer_key"),
    ("dim_vehicle", "vehicle_key", "fact_sales", "vehicle_key"),
    ("dim_dealership", "dealership_key", "fact_sales", "dealership_key"),
    ("dim_salesperson", "employee_key", "fact_sales", "salesperson_key"),
    ("dim_snapshot_date", "date_key", "fact_inventory", "snapshot_date_key"),
    ("dim_snapshot_date", "date_key", "fact_inventory", "acquired_date_key"),
    ("dim_vehicle", "vehicle_key", "fact_inventory", "vehicle_key"),
    ("dim_dealership", "dealership_key", "fact_inventory", "dealership_key"),
    ("dim_date", "date_key", "fact_service", "appointment_date_key"),
    ("dim_date", "date_key", "fact_service", "completed_date_key"),
    ("dim_date", "date_key", "fact_service", "opened_date_key"),
    ("dim_date", "date_key", "fact_service", "promised_date_key"),
    ("dim_customer", "customer_key", "fact_service", "customer_key"),
    ("dim_vehicle", "vehicle_key", "fact_service", "vehicle_key"),
    ("dim_dealership", "dealership_key", "fact_service", "dealership_key"),
    ("dim_service_advisor", "employee_key", "fact_service", "service_advisor_key"),
    ("dim_technician", "employee_key", "fact_service", "technician_key"),
    ("dim_service", "service_key", "fact_service", "service_key"),
    ("dim_date", "full_date", "dim_customer", "customer_since_date"),
)


def calendar(w) -> DataFrame:
    """Every day of the full years around all events."""
    return describe_report_days(days_between(event_bounds(w), "first", "last"))


def _employees(w, role: str) -> DataFrame:
    return w.table("dim_employee").where(F.col("role") == role) \
        .withColumn("employee_name", full_name()).select(*EMPLOYEE_COLUMNS)


def _vehicles(w) -> DataFrame:
    return w.table("dim_vehicle").withColumnsRenamed({"make": "brand", "body_type": "vehicle_type"}) \
        .select(*VEHICLE_COLUMNS)


def _sales(w) -> DataFrame:
    return sales.detail(w).select(*SALES_COLUMNS, *VEHICLE_LABELS)


def _inventory(w) -> DataFrame:
    return inventory.detail(w).withColumn("acquired_date_key", date_key("acquired_date")) \
        .select(*INVENTORY_COLUMNS, *VEHICLE_LABELS)


def _event_keys() -> dict[str, Column]:
    return {f"{name}_date_key": date_key(F.col(f"{name}_at").cast("date")) for name in ("opened", "promised", "completed")}


def _service(w) -> DataFrame:
    labels = {"vehicle_brand": "brand", "vehicle_model": "model", "vehicle_model_year": "model_year"}
    return service.wide_detail(w).withColumns(_event_keys()).withColumnsRenamed(labels) \
        .select(*SERVICE_COLUMNS, *VEHICLE_LABELS)


TABLES = {
    "dim_date": calendar,
    "dim_snapshot_date": calendar,
    "dim_customer": lambda w: w.table("dim_customer").select(*CUSTOMER_COLUMNS),
    "dim_vehicle": _vehicles,
    "dim_dealership": lambda w: w.table("dim_dealership").select(*DEALERSHIP_COLUMNS),
    "dim_service": lambda w: w.table("dim_service").select(*SERVICE_KIND_COLUMNS),
    "dim_salesperson": lambda w: _employees(w, SALES_ROLE),
    "dim_service_advisor": lambda w: _employees(w, ADVISOR_ROLE),
    "dim_technician": lambda w: _employees(w, TECHNICIAN_ROLE),
    "fact_sales": _sales,
    "fact_inventory": _inventory,
    "fact_service": _service,
}
FACT_COLUMNS = {"fact_sales": SALES_COLUMNS, "fact_inventory": INVENTORY_COLUMNS, "fact_service": SERVICE_COLUMNS}


def _narrow(w, name: str) -> DataFrame:
    """A model fact without vehicle labels and without its detail view."""
    rows = narrow.FACTS_OF[name](w)
    if name == "fact_inventory":
        rows = rows.withColumn("acquired_date_key", date_key("acquired_date"))
    return (rows.withColumns(_event_keys()) if name == "fact_service" else rows).select(*FACT_COLUMNS[name])


def exported(w) -> dict[str, DataFrame]:
    """All model tables for one writing each; facts without their detail views, where those would add nothing but attributes."""
    return {name: _narrow(w, name) if name in FACT_COLUMNS and narrow.suffices(w, name) else model_table(w, name) for name in TABLES}


def model_table(w, name: str) -> DataFrame:
    """One exported model table (facts without the vehicle labels used for filtering)."""
    frame = TABLES[name](w)
    return frame.select(*FACT_COLUMNS[name]) if name in FACT_COLUMNS else frame


class SemanticModel:
    """Model tables by name, built on first use.

    Facts always carry the vehicle labels, so brand and type filters need no join.
    """

    def __init__(self, tables: Mapping[str, DataFrame | Callable[[], DataFrame]], stage: Stage | None = None, bare: tuple[str, ...] = ()):
        self._sources = dict(tables)
        self._ready: dict[str, DataFrame] = {}
        self._bare, self._stage = bare, stage

    @classmethod
    def of(cls, w) -> SemanticModel:
        return cls({name: partial(build, w) for name, build in TABLES.items()})

    @classmethod
    def narrow(cls, w) -> SemanticModel:
        """The model without its detail views, as far as they are not there yet and would add nothing but attributes."""
        bare = {name: partial(_narrow, w, name) for name in FACT_COLUMNS if narrow.suffices(w, name)}
        tables = {name: partial(build, w) for name, build in TABLES.items()}
        return cls({**tables, **bare}, written_stages(w.store.spark) if bare else None, tuple(bare))

    @classmethod
    def planned(cls, w) -> SemanticModel:
        """The model over its detail views; of a view that isn't there yet, the columns that ``read_once`` is asked for are joined and written."""
        if w.store is None:
            return cls.of(w)
        missing = tuple(name for name, detail in narrow.DETAIL_OF.items() if not w.has(detail))
        return cls({name: partial(build, Planned(w)) for name, build in TABLES.items()}, written_stages(w.store.spark), missing)

    def rows(self, name: str) -> DataFrame:
        """A fact, possibly without labels; their join with unique, resolved keys changes no rows."""
        return self._sources[name]() if name in self._bare else self.table(name)

    def read_once(self, name: str, *columns: str) -> DataFrame:
        """Columns of a fact for many aggregates: a plan that isn't written yet is run and written once."""
        frame = self.table(name).select(*columns)
        return self._stage(f"{name}-{uuid.uuid4().hex[:8]}", frame) if name in self._bare else frame

    def table(self, name: str) -> DataFrame:
        if name not in self._ready:
            source = self._sources[name]
            frame = source() if callable(source) else source
            self._ready[name] = self._with_labels(frame) if name in FACT_COLUMNS else frame
        return self._ready[name]

    def _with_labels(self, fact: DataFrame) -> DataFrame:
        if set(VEHICLE_LABELS) <= set(fact.columns):
            return fact
        vehicles = self.table("dim_vehicle")
        missing = [c for c in VEHICLE_LABELS if c not in fact.columns and c in vehicles.columns]
        return fact.join(vehicles.select("vehicle_key", *missing), "vehicle_key").select(*fact.columns, *missing) if missing else fact


def relationship_errors(model: SemanticModel) -> DataFrame:
    """Per relationship: repeated or NULL dimension keys, and fact keys the dimension does not hold."""
    parts = []
    for dimension, key, fact, column in RELATIONSHIPS:
        one = model.table(dimension).select(F.col(key).alias("k"))
        repeated = one.groupBy("k").agg(F.count("*").alias("n")).where("n > 1 OR k IS NULL") \
            .agg(F.count("*").alias("dimension_errors"))
        parts.append(repeated.select(F.lit(f"{dimension}.{key} -> {fact}.{column}").alias("relationship"),
                                     "dimension_errors", F.lit(0).cast("bigint").alias("orphan_rows")))
    for fact in dict.fromkeys(r[2] for r in RELATIONSHIPS):
        # All key columns of a fact in one scan; a hot key crosses the network once.
        own = [r for r in RELATIONSHIPS if r[2] == fact]
        found = dangling(model.table(fact), [Link(column, model.table(dimension), key) for dimension, key, _, column in own])
        labels = F.array(*[F.lit(f"{dimension}.{key} -> {fact}.{column}") for dimension, key, _, column in own])
        parts.append(found.select(F.get(labels, F.col("link")).alias("relationship"), F.lit(0).cast("bigint").alias("dimension_errors"),
                                  F.col("n").alias("orphan_rows")))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows.groupBy("relationship").agg(
        F.sum("dimension_errors").alias("dimension_errors"), F.sum("orphan_rows").alias("orphan_rows"))


GRAINS = {
    "fact_sales": ("sale_id",),
    "fact_service": ("appointment_id",),
    "fact_inventory": ("vehicle_key", "dealership_key", "snapshot_date_key"),
}


def grain_errors(model: SemanticModel) -> DataFrame:
    """Per fact: repeated grain keys and NULL grain values; plus repeated repair orders."""
    def counted(label: str, frame: DataFrame, keys: tuple[str, ...]) -> DataFrame:
        has_null = F.lit(False)
        for k in keys:
            has_null = has_null | F.col(k).isNull()
        groups = frame.groupBy(*keys).agg(F.count("*").alias("n"))
        return groups.agg(
            F.lit(label).alias("grain"),
            F.count_if(F.col("n") > 1).alias("repeated_keys"),
            F.coalesce(F.sum(F.when(has_null, F.col("n"))), F.lit(0)).alias("null_rows"))

    rows = [counted(f"{fact}({', '.join(keys)})", model.rows(fact), keys) for fact, keys in GRAINS.items()]
    orders = model.rows("fact_service").where(F.col("service_order_id").isNotNull())
    rows.append(counted("fact_service(service_order_id)", orders, ("service_order_id",)))
    result = rows[0]
    for row in rows[1:]:
        result = result.unionByName(row)
    return result

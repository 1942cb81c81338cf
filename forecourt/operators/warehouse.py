"""Star-schema load: six dimensions and three facts from the staged datasets.

A surrogate key is a function of its identifier, so facts compute their keys and join no
dimension. A row whose identifiers do not all resolve is left out and the row-count
reconciliation reports it; which keys dangle is found from the distinct keys of a fact (see
``keysets``), so no fact row is shuffled to look one up, however large a dimension is.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import (
    ADVISOR_ROLE,
    EFFECTIVE_FROM,
    EFFECTIVE_TO,
    OTHER_SERVICES,
    SALES_ROLE,
    SERVICE_CATEGORIES,
    SHARED_ORDER_COLUMNS,
    TECHNICIAN_ROLE,
)
from forecourt.functions.calendar import days_between, describe_days
from forecourt.functions.keys import date_key, snapshot_key, surrogate_key
from forecourt.operators.keysets import Dangling, Link
from forecourt.sources.store import written_stages

MONEY = "decimal(14,2)"


def _version_columns() -> list[Column]:
    return [
        F.lit(EFFECTIVE_FROM).cast("date").alias("effective_from"),
        F.lit(EFFECTIVE_TO).cast("date").alias("effective_to"),
        F.lit(True).alias("is_current"),
    ]


def _whole(name: str, kind: str) -> Column:
    """'2022' and '2022.0' both become the integer; ANSI mode rejects other text."""
    return F.col(name).cast("decimal(20,2)").cast(kind).alias(name)


def _blank_to_null(name: str) -> Column:
    return F.nullif(F.col(name), F.lit("")).alias(name)


def dim_date(w) -> DataFrame:
    """Contiguous calendar over every event, registration, hire and opening date."""
    sources = [
        ("sales", "sale_date"),
        ("inventory", "snapshot_date"),
        ("inventory", "acquired_date"),
        ("service_appointments", "appointment_date"),
        ("service_orders", "opened_at"),
        ("service_orders", "completed_at"),
        ("customers", "customer_since_date"),
        ("employees", "hire_date"),
        ("dealerships", "opened_date"),
    ]
    by_table: dict[str, list[str]] = {}
    for name, column in sources:
        by_table.setdefault(name, []).append(column)
    # One pass per dataset: several date columns of a table share the scan.
    bounds = [
        w.table(name).agg(
            F.least(*[F.min(F.col(c).cast("date")) for c in columns]).alias("lo")
            if len(columns) > 1 else F.min(F.col(columns[0]).cast("date")).alias("lo"),
            F.greatest(*[F.max(F.col(c).cast("date")) for c in columns]).alias("hi")
            if len(columns) > 1 else F.max(F.col(columns[0]).cast("date")).alias("hi"),
        )
        for name, columns in by_table.items()
    ]
    overall = reduce(DataFrame.unionByName, bounds).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    return describe_days(days_between(overall, "lo", "hi"))


def dim_dealership(w) -> DataFrame:
    return w.table("dealerships").select(
        surrogate_key("dealership_id", "DLR", 3).alias("dealership_key"),
        "dealership_id", "dealership_name", "city", "state", "postal_code", "region",
        F.col("opened_date").cast("date"),
        *_version_columns(),
    )


def dim_customer(w) -> DataFrame:
    return w.table("customers").select(
        surrogate_key("customer_id", "CUS").alias("customer_key"),
        "customer_id", "first_name", "last_name",
        *[_blank_to_null(c) for c in ("email", "phone", "city", "state", "postal_code")],
        F.col("customer_since_date").cast("date"),
        "customer_type",
        *_version_columns(),
    )


def dim_vehicle(w) -> DataFrame:
    return w.table("vehicles").select(
        surrogate_key("vehicle_id", "VEH").alias("vehicle_key"),
        "vehicle_id", "vin", "make", "model",
        _whole("model_year", "smallint"),
        "body_type", "fuel_type",
        _blank_to_null("color"),
        "vehicle_condition",
        _whole("mileage_at_acquisition", "int"),
        F.col("manufacturer_msrp").cast(MONEY),
    )


def dim_employee(w) -> DataFrame:
    dealers = w.table("dim_dealership").select("dealership_id", "dealership_key")
    return w.table("employees").join(dealers, "dealership_id").select(
        surrogate_key("employee_id", "EMP").alias("employee_key"),
        "employee_id", "dealership_key", "first_name", "last_name", "role",
        F.col("hire_date").cast("date"),
        "employment_status",
        *_version_columns(),
    )


def dim_service(w) -> DataFrame:
    kind = F.col("service_type")
    category = F.lit(OTHER_SERVICES)
    for name, members in SERVICE_CATEGORIES.items():
        category = F.when(kind.isin(*members), name).otherwise(category)
    return w.table("service_appointments").select("service_type").distinct().select(
        surrogate_key("service_type").alias("service_key"),
        "service_type",
        category.alias("service_category"),
        F.lit(True).alias("is_active"),
    )


def _current(dim: DataFrame, *columns: str) -> DataFrame:
    return dim.where("is_current").select(*columns)


# Key column of a fact -> its identifier in the source, and the form of the identifier.
KEYED = {
    "customer_key": ("customer_id", "CUS", 6),
    "vehicle_key": ("vehicle_id", "VEH", 6),
    "dealership_key": ("dealership_id", "DLR", 3),
    "salesperson_key": ("salesperson_id", "EMP", 6),
    "service_advisor_key": ("service_advisor_id", "EMP", 6),
    "technician_key": ("technician_id", "EMP", 6),
}


def _keyed(source: DataFrame, *columns: str) -> DataFrame:
    return source.withColumns({c: surrogate_key(KEYED[c][0], *KEYED[c][1:]) for c in columns})


def _links(w, **roles: str) -> list[Link]:
    """What the keys of a fact must resolve to; employees in the role of their column, at the dealership of the row."""
    links = [Link("vehicle_key", w.table("dim_vehicle"), "vehicle_key"), Link("dealership_key", w.table("dim_dealership"), "dealership_key")]
    if roles:
        links.append(Link("customer_key", _current(w.table("dim_customer"), "customer_key"), "customer_key"))
    staff = _current(w.table("dim_employee"), "employee_key", "dealership_key", "role")
    return links + [Link(f"{column}_key", staff.where(F.col("role") == role), "employee_key", "dealership_key", "dealership_key")
                    for column, role in roles.items()]


def _resolved(w, name: str, rows: DataFrame, checked: DataFrame, links: list[Link]) -> DataFrame:
    return Dangling(checked, links, written_stages(rows.sparkSession), name).resolved(rows)


def sale_units(status: Column) -> Column:
    return F.when(status == "Returned", -1).otherwise(1).cast("smallint")


def fact_sales(w) -> DataFrame:
    keyed = _keyed(w.table("sales"), "customer_key", "vehicle_key", "dealership_key", "salesperson_key")
    return _resolved(w, "fact_sales", keyed, keyed, _links(w, salesperson=SALES_ROLE)).select(
        surrogate_key("sale_id", "SAL").alias("sales_key"),
        "sale_id",
        date_key(F.col("sale_date").cast("date")).alias("sale_date_key"),
        "customer_key", "vehicle_key", "dealership_key", "salesperson_key", "sales_channel",
        *[F.col(c).cast(MONEY) for c in
          ("list_price", "discount_amount", "sale_price", "vehicle_cost", "gross_profit")],
        sale_units(F.col("sale_status")).alias("unit_quantity"),
        "payment_type", "sale_status",
        F.current_timestamp().alias("loaded_at"),
    )


def fact_inventory(w) -> DataFrame:
    day = date_key(F.col("snapshot_date").cast("date"))
    keyed = _keyed(w.table("inventory"), "vehicle_key", "dealership_key")
    return _resolved(w, "fact_inventory", keyed, keyed, _links(w)).select(
        snapshot_key("inventory_id", day, "INV").alias("inventory_key"),
        "inventory_id",
        day.alias("snapshot_date_key"),
        "vehicle_key", "dealership_key",
        F.col("acquired_date").cast("date"),
        "inventory_status",
        F.col("carrying_cost").cast(MONEY),
        _whole("days_in_inventory", "int"),
        F.col("slow_moving_flag").cast("boolean"),
        F.lit(1).cast("smallint").alias("on_hand_quantity"),
        F.current_timestamp().alias("loaded_at"),
    )


def elapsed_hours(start: Column, end: Column) -> Column:
    micros = F.timestamp_diff("MICROSECOND", start, end).cast("decimal(20,0)")
    return F.round(micros / F.lit(3_600_000_000).cast("decimal(10,0)"), 2).cast("decimal(12,2)")


def fact_service(w) -> DataFrame:
    visits = w.table("service_appointments").select("appointment_id", *SHARED_ORDER_COLUMNS, "service_type")
    columns = ("customer_key", "vehicle_key", "dealership_key", "service_advisor_key", "technician_key")
    opened, promised, completed = (
        F.col(c).cast("timestamp_ntz") for c in ("opened_at", "promised_at", "completed_at")
    )
    # Every service type of an appointment is in its dimension, which is made of them.
    joined = w.table("service_orders").join(visits, ["appointment_id", *SHARED_ORDER_COLUMNS]).where("service_type is not null") \
        .withColumn("service_key", surrogate_key("service_type"))
    links = _links(w, service_advisor=ADVISOR_ROLE, technician=TECHNICIAN_ROLE)
    keyed = _resolved(w, "fact_service", _keyed(joined, *columns), _keyed(w.table("service_orders"), *columns), links)
    return keyed.select(
        surrogate_key("service_order_id", "SRO").alias("service_fact_key"),
        "service_order_id", "appointment_id",
        date_key(completed.cast("date")).alias("completed_date_key"),
        "customer_key", "vehicle_key", "dealership_key", "service_advisor_key", "technician_key", "service_key",
        opened.alias("opened_at"), promised.alias("promised_at"), completed.alias("completed_at"),
        "order_status", "payer_type",
        *[F.col(c).cast(MONEY) for c in
          ("labor_revenue", "parts_revenue", "discount_amount", "service_revenue")],
        F.lit(1).cast("smallint").alias("repair_order_quantity"),
        (completed <= promised).alias("completed_on_time"),
        elapsed_hours(opened, completed).alias("turnaround_hours"),
        F.current_timestamp().alias("loaded_at"),
    )


def repair_unit_signs(sales: DataFrame) -> DataFrame:
    """Set the unit sign from the sale status on rows where the two disagree."""
    expected = sale_units(F.col("sale_status"))
    wrong = ~F.col("unit_quantity").eqNullSafe(expected)
    return sales.withColumn("unit_quantity", F.when(wrong, expected).otherwise(F.col("unit_quantity")))

"""Facts of the semantic model from the keys of the star schema, without the attributes of the detail views.

A detail view joins a fact with its dimensions. A loaded fact holds resolved keys only, so those
joins neither drop nor repeat a row as long as every dimension key is unique, which one small
aggregate over the dimensions says. Then the columns that the model keeps need no join at all:
nothing wide is shuffled or written for a query that reads a few of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import ADVISOR_ROLE, RECOGNISED_SALES
from forecourt.functions.keys import date_key
from forecourt.operators import warehouse as load
from forecourt.operators.scoring import union_all
from forecourt.plans import inventory, sales, service
from forecourt.plans.warehouse import DIMENSIONS, FACTS

KEYS = {"dim_dealership": "dealership_key", "dim_employee": "employee_key", "dim_vehicle": "vehicle_key", "dim_customer": "customer_key"}
DETAIL_OF = {"fact_sales": "sales_detail", "fact_inventory": "inventory_detail", "fact_service": "service_detail"}


def _unique_dimensions(w) -> bool:
    """No dimension key stands in two rows."""
    repeats = union_all([w.table(name).agg((F.count(key) - F.count_distinct(key)).alias("n")) for name, key in KEYS.items()])
    return repeats.agg(F.sum("n")).first()[0] == 0


def suffices(w, fact: str) -> bool:
    """Whether the narrow fact has the rows of the detail view, and the view is not there yet.

    Facts or dimensions that were given may hold anything, so their details are joined.
    """
    if w.store is None or w.has(DETAIL_OF[fact]) or any(w.given(name) for name in (*DIMENSIONS, *FACTS)):
        return False
    return w.once("unique dimensions", lambda: _unique_dimensions(w))


def sold(w) -> DataFrame:
    """The rows of ``sales.detail`` with the keys and amounts of the fact; every day of a sale is in the calendar."""
    return w.plan("fact_sales").where(F.col("sale_status").isin(*RECOGNISED_SALES) & F.col("sale_date_key").isNotNull()) \
        .withColumns(sales.signed_amounts()).withColumnRenamed("unit_quantity", "units_sold")


def stock(w) -> DataFrame:
    """The rows of ``inventory.detail``."""
    return w.plan("fact_inventory").where(F.col("snapshot_date_key").isNotNull()).withColumns(inventory.derived()) \
        .withColumnsRenamed({"on_hand_quantity": "inventory_units", "carrying_cost": "inventory_value"})


def _visits(w) -> DataFrame:
    """Staged appointments whose keys all resolve."""
    columns = ("customer_key", "vehicle_key", "dealership_key", "service_advisor_key")
    rows = load._keyed(w.table("service_appointments").where("service_type is not null and appointment_date is not null"), *columns)
    links = load._links(w, service_advisor=ADVISOR_ROLE)
    return load._resolved(w, "visits", rows, rows, links).select(
        "appointment_id", date_key(F.col("appointment_date").cast("date")).alias("appointment_date_key"), *columns,
        load.surrogate_key("service_type").alias("service_key"), "appointment_status", *service.visit_counts(F.col("appointment_status")))


def served(w) -> DataFrame:
    """The rows of ``service.wide_detail``; appointments and orders meet bucket by bucket."""
    orders = w.plan("fact_service").select(
        "appointment_id", "service_order_id", "repair_order_quantity", "technician_key", "payer_type", "opened_at", "promised_at",
        "completed_at", "completed_on_time", "turnaround_hours", "order_status", *service.MONEY_COLUMNS)
    return w.once("resolved visits", lambda: _visits(w)).join(orders, "appointment_id", "left").withColumns(service.amounts())


FACTS_OF = {"fact_sales": sold, "fact_inventory": stock, "fact_service": served}

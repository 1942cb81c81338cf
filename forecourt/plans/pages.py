"""Parameterised page and summary queries over the reporting views.

A page is ``filter -> select -> orderBy -> offset -> limit`` with a fixed, total order. Spark
plans the last three as one top-k, so no full sort is exchanged; a task holds offset + limit
rows. Beyond an offset of ``DEEP`` rows the order is dealt over all tasks and written with each
row's place; the row counts of the parts say which places the page has, and only those are read
back. ``after`` (the sort values of the last row seen) needs neither.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.numeric import percent, ratio, total_or_zero, whole_or_zero
from forecourt.plans import reporting
from forecourt.plans.warehouse import Planned
from forecourt.sources.store import written_stages

# Page limits, accepted filter values, output columns.
DEFAULT_LIMIT, MAX_LIMIT = 100, 500
DEEP = 10_000  # the largest offset that one task holds
CHOICES = {
    "sale_status": ("Completed", "Returned"),
    "payment_type": ("Finance", "Cash", "Lease"),
    "aging_bucket": ("0-30", "31-60", "61-90", "91-120", "120+"),
    "inventory_status": (
        "Available", "Reserved", "In Transit", "Demonstrator", "Sold Not Delivered", "Unavailable"),
    "service_type": ("Maintenance", "Repair", "Inspection", "Recall", "Tires"),
    "appointment_status": ("Completed", "Cancelled", "No Show", "Scheduled"),
    "relationship_segment": ("Sales Only", "Service Only", "Sales + Service", "No Activity"),
    "lifecycle_segment": ("Prospect", "New Customer", "Repeat Customer"),
    "activity_segment": ("Active", "Inactive", "Never Active"),
}
SALES_FIELDS = (
    "sale_id", "sale_date", "brand", "model", "dealership_id", "dealership_name", "salesperson_name",
    "payment_type", "sale_status", "units_sold", "revenue", "gross_profit", "gross_margin_percent",
    "average_selling_price",
)
INVENTORY_FIELDS = (
    "inventory_id", "snapshot_date", "vehicle_id", "brand", "model", "dealership_id", "dealership_name",
    "inventory_status", "inventory_units", "inventory_value", "days_in_inventory", "aging_bucket", "is_slow_moving",
)
SERVICE_FIELDS = (
    "appointment_id", "appointment_date", "appointment_time", "dealership_id", "dealership_name", "service_type",
    "appointment_status", "service_order_id", "technician_name", "completed_on_time", "turnaround_hours",
    "service_revenue",
)
CUSTOMER_FIELDS = (
    "customer_id", "customer_name", "city", "state", "customer_type", "customer_since_date",
    "sales_transaction_count", "service_order_count", "customer_revenue", "customer_lifetime_value",
    "relationship_segment", "lifecycle_segment", "activity_segment", "service_frequency_segment",
)
DEALERSHIP_FIELDS = (
    "dealership_id", "dealership_name", "city", "state", "region", "units_sold", "sales_revenue",
    "sales_gross_profit", "inventory_units", "inventory_value", "appointments", "service_revenue",
    "unique_customers", "total_revenue",
)


ONE_DETAIL = (reporting.sales_performance, reporting.inventory_aging, reporting.service_performance)


class QueryError(ValueError):
    """A parameter is outside its accepted range."""


@dataclass(frozen=True)
class Resource:
    """A pageable view: its columns, its order (column, descending), and its filters."""

    view: Callable[..., DataFrame]
    fields: tuple[str, ...]
    order: tuple[tuple[str, bool], ...]
    equal: tuple[str, ...] = ()
    day: str | None = None
    minimum: dict[str, str] = field(default_factory=dict)
    always: dict[str, Any] = field(default_factory=dict)


_SALES_FILTERS = ("dealership_id", "brand", "payment_type", "sale_status")
_STOCK_FILTERS = ("dealership_id", "brand", "aging_bucket", "inventory_status")
_VISIT_FILTERS = ("dealership_id", "service_type", "appointment_status")
_BY_SALE = (("sale_date", True), ("sale_id", False))
_BY_VISIT = (("appointment_date", True), ("appointment_id", False))
_BY_VALUE = (("customer_lifetime_value", True), ("customer_id", False))
_BY_REVENUE = (("total_revenue", True), ("dealership_id", False))

RESOURCES: dict[str, Resource] = {
    "sales": Resource(reporting.sales_performance, SALES_FIELDS, _BY_SALE),
    "inventory": Resource(
        reporting.inventory_aging, INVENTORY_FIELDS, (("snapshot_date", True), ("inventory_id", False))),
    "service": Resource(reporting.service_performance, SERVICE_FIELDS, _BY_VISIT),
    "customers": Resource(reporting.customer_value, CUSTOMER_FIELDS, _BY_VALUE),
    "dealerships": Resource(reporting.dealership_performance, DEALERSHIP_FIELDS, _BY_REVENUE),
    "sales_performance": Resource(
        reporting.sales_performance, SALES_FIELDS, _BY_SALE, _SALES_FILTERS, "sale_date"),
    "inventory_aging": Resource(
        reporting.inventory_aging, INVENTORY_FIELDS,
        (("snapshot_date", True), ("days_in_inventory", True), ("inventory_id", False)),
        _STOCK_FILTERS, "snapshot_date"),
    "inventory_slow_moving": Resource(
        reporting.inventory_aging, INVENTORY_FIELDS,
        (("days_in_inventory", True), ("inventory_id", False), ("snapshot_date", True)),
        _STOCK_FILTERS, "snapshot_date", always={"is_slow_moving": True}),
    "service_performance": Resource(
        reporting.service_performance, SERVICE_FIELDS, _BY_VISIT, _VISIT_FILTERS, "appointment_date"),
    "customer_value": Resource(
        reporting.customer_value, CUSTOMER_FIELDS, _BY_VALUE,
        ("state", "relationship_segment", "lifecycle_segment", "activity_segment"),
        minimum={"minimum_value": "customer_lifetime_value"}),
    "dealership_performance": Resource(
        reporting.dealership_performance, DEALERSHIP_FIELDS, _BY_REVENUE, ("region", "state"),
        minimum={"minimum_revenue": "total_revenue"}),
}


def _filtered(w, resource: Resource, filters: dict[str, Any]) -> DataFrame:
    """The view under the given filters; None means 'not filtered'."""
    accepted = {*resource.equal, *resource.minimum, *(("date_from", "date_to") if resource.day else ())}
    unknown = sorted(set(filters) - accepted)
    if unknown:
        raise QueryError(f"unknown filters: {', '.join(unknown)}")
    given = {name: value for name, value in filters.items() if value is not None}
    start, end = given.get("date_from"), given.get("date_to")
    if start and end and start > end:
        raise QueryError("date_from must be on or before date_to")
    # A page reads a detail once: no detail is built for it that isn't there yet.
    frame = resource.view(Planned(w) if resource.view in ONE_DETAIL else w)
    for name, value in {**resource.always, **{n: given[n] for n in resource.equal if n in given}}.items():
        if name in CHOICES and value not in CHOICES[name]:
            raise QueryError(f"{name} must be one of {', '.join(CHOICES[name])}")
        frame = frame.where(F.col(name) == value)
    if start:
        frame = frame.where(F.col(resource.day) >= start)
    if end:
        frame = frame.where(F.col(resource.day) <= end)
    for name, column in resource.minimum.items():
        if name in given:
            if given[name] < 0:
                raise QueryError(f"{name} must not be negative")
            frame = frame.where(F.col(column) >= F.lit(given[name]))
    return frame


def _beyond(order: tuple[tuple[str, bool], ...], values: tuple) -> Column:
    """Rows that sort strictly after the given sort values; NULL is the smallest value, as in the order of a page."""
    later, tied = F.lit(False), F.lit(True)
    for (name, descending), value in zip(order, values, strict=True):
        column = F.col(name)
        if value is None:
            beyond = F.lit(False) if descending else column.isNotNull()
        else:
            beyond = (column < value) | column.isNull() if descending else column > value
        later = later | (tied & F.coalesce(beyond, F.lit(False)))
        tied = tied & column.eqNullSafe(F.lit(value))
    return later


PLACE_BITS = 33  # monotonically_increasing_id: the partition above, the row in it below


def _from_place(frame: DataFrame, ordering: list[Column], offset: int, limit: int) -> DataFrame:
    """The rows at places offset .. offset + limit of the order, which no task holds as a whole.

    The order is written once, each row with its part and its place in the part; a page reads the
    places that it needs, which the files are sorted by.
    """
    dealt = frame.repartitionByRange(*ordering).sortWithinPartitions(*ordering).withColumn("_place", F.monotonically_increasing_id())
    ranked = written_stages(frame.sparkSession)("ranked", dealt)
    parts = ranked.groupBy(F.shiftright("_place", PLACE_BITS).alias("part")).count().orderBy("part").collect()  # one row per task
    wanted, before = F.lit(False), 0
    for part, rows in parts:
        first, last = max(0, offset - before), min(rows, offset + limit - before)
        if first < last:
            wanted = wanted | F.col("_place").between((part << PLACE_BITS) + first, (part << PLACE_BITS) + last - 1)
        before += rows
    return ranked.where(wanted).orderBy("_place").limit(limit).drop("_place")


def page(w, name: str, limit: int = DEFAULT_LIMIT, offset: int = 0, after: tuple | None = None, deep: int = DEEP,
         **filters: Any) -> DataFrame:
    """One page as a DataFrame in a stable order; an offset beyond ``deep`` rows is found by place."""
    if not 1 <= limit <= MAX_LIMIT:
        raise QueryError(f"limit must be between 1 and {MAX_LIMIT}")
    if offset < 0:
        raise QueryError("offset must not be negative")
    resource = RESOURCES[name]
    frame = _filtered(w, resource, filters)
    if after is not None:
        frame = frame.where(_beyond(resource.order, after))
    ordering = [F.desc(c) if descending else F.asc(c) for c, descending in resource.order]
    frame = frame.select(*resource.fields)
    if offset > deep:
        return _from_place(frame, ordering, offset, limit)
    frame = frame.orderBy(*ordering)
    return (frame.offset(offset) if offset else frame).limit(limit)


def fetch(w, name: str, limit: int = DEFAULT_LIMIT, offset: int = 0, **options: Any) -> dict[str, Any]:
    """The page envelope: items, limit, offset and the number of rows returned (at most 500)."""
    items = [row.asDict() for row in page(w, name, limit, offset, **options).collect()]
    return {"items": items, "limit": limit, "offset": offset, "returned": len(items)}


def sales_summary(w, **filters: Any) -> DataFrame:
    """One row of sales totals; amounts default to 0, ratios to NULL."""
    revenue, units = F.sum("revenue"), F.sum("units_sold")
    return _filtered(w, RESOURCES["sales_performance"], filters).agg(
        F.count("*").alias("sales_transactions"),
        whole_or_zero("units_sold").alias("units_sold"),
        total_or_zero("revenue").alias("revenue"),
        total_or_zero("gross_profit").alias("gross_profit"),
        percent(F.sum("gross_profit"), revenue).alias("gross_margin_percent"),
        ratio(revenue, units).alias("average_selling_price"),
    )


def service_revenue(w, **filters: Any) -> DataFrame:
    """One row of service totals; amounts default to 0, ratios to NULL."""
    orders = F.count("service_order_id")
    return _filtered(w, RESOURCES["service_performance"], filters).agg(
        whole_or_zero("appointment_count").alias("appointments"),
        whole_or_zero("completed_appointment_count").alias("completed_appointments"),
        orders.alias("repair_orders"),
        total_or_zero("service_revenue").alias("service_revenue"),
        percent(F.sum("completed_appointment_count"), F.sum("completion_eligible_count"))
        .alias("completion_rate_percent"),
        ratio(F.sum("service_revenue"), orders).alias("average_repair_order"),
    )

"""Read the eight source datasets from order-management parquet tables.

Suppliers play the dealerships, parts the vehicles, orders the sales, line items the
inventory snapshots and events the service appointments. Each dataset is a projection of
one fact-sized table; only inventory needs a shuffle (it aggregates line items).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.contracts import ADVISOR_ROLE, DATASETS, SALES_ROLE, TECHNICIAN_ROLE
from forecourt.functions.keys import padded

# How source codes map onto the vehicle domain.
FUELS = ("Gasoline", "Hybrid", "Electric", "Diesel")
COLORS = ("Black", "White", "Silver", "Gray", "Blue", "Red", "Green")
PAYMENTS = ("Finance", "Cash", "Lease")
PAYERS = ("Customer Pay", "Warranty", "Internal")
SERVICE_TYPES = ("Maintenance", "Repair", "Inspection", "Recall", "Tires")
SALE_STATUS = {"F": "Completed", "P": "Returned", "O": "Cancelled"}
APPOINTMENT_STATUS = {
    "purchase": "Completed", "click": "Completed", "error": "Cancelled",
    "signup": "No Show", "view": "Scheduled",
}
CUSTOMER_TYPES = {"BUILDING": "Business", "MACHINERY": "Fleet"}
CHANNELS = {"1": "Fleet", "2": "Partner", "3": "Online"}
EMPLOYEE_ROLES = ((SALES_ROLE, "Consultant"), (ADVISOR_ROLE, "Advisor"), (TECHNICIAN_ROLE, "Technician"))
FIRST_DAY = "1990-01-01"
ORDER_EVENTS = ("purchase", "click")


def _id(prefix: str, number: Column, width: int = 6) -> Column:
    return F.concat(F.lit(prefix), padded(number, width))


def _cycle(values: tuple[str, ...], number: Column) -> Column:
    picked = F.array(*[F.lit(v) for v in values])
    return F.get(picked, F.pmod(number, F.lit(len(values))).cast("int"))


def _decode(codes: dict[str, str], column: Column, other: Column) -> Column:
    result = other
    for code, value in codes.items():
        result = F.when(column == code, value).otherwise(result)
    return result


def _early_day(number: Column) -> Column:
    return F.date_add(F.lit(FIRST_DAY).cast("date"), (number % 1500).cast("int"))


def read_order_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The typed source datasets, lazily, in contract column order."""

    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{folder}/{name}.parquet")

    def size(name: str) -> Column:
        return table(name).agg(F.count(F.lit(1)).alias("n")).scalar()

    nation, supplier, part = table("nation"), table("supplier"), table("part")
    n_part, n_supp = size("part"), size("supplier")
    frames = {
        "dealerships": _dealerships(supplier, nation, table("region")),
        "customers": _customers(table("customer"), nation),
        "vehicles": _vehicles(part),
        "employees": _employees(supplier),
        "sales": _sales(table("orders"), n_part, n_supp),
        "inventory": _inventory(table("lineitem"), n_supp),
        "service_appointments": _appointments(table("events"), n_part, n_supp),
        "service_orders": _orders(table("events"), n_part, n_supp),
    }
    return {
        name: frames[name].select([F.col(f.name).cast(f.type) for f in dataset.fields])
        for name, dataset in DATASETS.items()
    }


def _dealerships(supplier, nation, region):
    key = F.col("s_suppkey")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return supplier.join(places, supplier.s_nationkey == places.n_nationkey).select(
        _id("DLR", key, 3).alias("dealership_id"),
        F.col("s_name").alias("dealership_name"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        padded(key % 100000, 5).alias("postal_code"),
        F.col("r_name").alias("region"),
        _early_day(key).alias("opened_date"),
    )


def _customers(customer, nation):
    key = F.col("c_custkey")
    return customer.join(nation, customer.c_nationkey == nation.n_nationkey).select(
        _id("CUS", key).alias("customer_id"),
        F.lit("Customer").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit("customer"), padded(key), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("555-"), padded(key % 10000, 4)).alias("phone"),
        F.col("n_name").alias("city"),
        F.col("n_name").alias("state"),
        padded(key % 100000, 5).alias("postal_code"),
        _early_day(key).alias("customer_since_date"),
        _decode(CUSTOMER_TYPES, F.col("c_mktsegment"), F.lit("Individual")).alias("customer_type"),
    )


def _vehicles(part):
    key, used = F.col("p_partkey"), F.col("p_partkey") % 3 == 0
    return part.select(
        _id("VEH", key).alias("vehicle_id"),
        F.concat(F.lit("SYN"), padded(key, 14)).alias("vin"),
        F.col("p_brand").alias("make"),
        F.col("p_name").alias("model"),
        (F.lit(1990) + F.col("p_size") % 6).alias("model_year"),
        F.col("p_type").alias("body_type"),
        _cycle(FUELS, key).alias("fuel_type"),
        _cycle(COLORS, key).alias("color"),
        F.when(used, "Used").otherwise("New").alias("vehicle_condition"),
        F.when(used, 2000 + key * 37 % 108000).otherwise(0).alias("mileage_at_acquisition"),
        F.col("p_retailprice").alias("manufacturer_msrp"),
    )


def _employees(supplier):
    roles = F.array(*[
        F.struct(F.lit(n).alias("n"), F.lit(role).alias("role"), F.lit(name).alias("name"))
        for n, (role, name) in enumerate(EMPLOYEE_ROLES)
    ])
    key = F.col("s_suppkey") * 3 + F.col("job.n")
    return supplier.select("s_suppkey", "s_name", F.explode(roles).alias("job")).select(
        _id("EMP", key).alias("employee_id"),
        _id("DLR", F.col("s_suppkey"), 3).alias("dealership_id"),
        F.col("job.name").alias("first_name"),
        F.col("s_name").alias("last_name"),
        F.col("job.role").alias("role"),
        _early_day(key).alias("hire_date"),
        F.when(key % 17 == 0, "Inactive").otherwise("Active").alias("employment_status"),
    )


def _sales(orders, n_part, n_supp):
    key, dealer = F.col("o_orderkey"), F.col("o_orderkey") % n_supp
    price = F.col("o_totalprice").cast("decimal(14,2)")
    discount, profit = (key % 5000).cast("decimal(14,2)"), (key % 900).cast("decimal(14,2)")
    return orders.select(
        _id("SAL", key).alias("sale_id"),
        F.col("o_orderdate").cast("date").alias("sale_date"),
        _id("CUS", F.col("o_custkey")).alias("customer_id"),
        _id("VEH", key % n_part).alias("vehicle_id"),
        _id("DLR", dealer, 3).alias("dealership_id"),
        _id("EMP", dealer * 3).alias("salesperson_id"),
        _decode(CHANNELS, F.substring("o_orderpriority", 1, 1), F.lit("Showroom")).alias("sales_channel"),
        (price + discount).alias("list_price"),
        discount.alias("discount_amount"),
        price.alias("sale_price"),
        (price - profit).alias("vehicle_cost"),
        profit.alias("gross_profit"),
        _cycle(PAYMENTS, key).alias("payment_type"),
        _decode(SALE_STATUS, F.col("o_orderstatus"), F.lit(None).cast("string")).alias("sale_status"),
    )


def _inventory(lineitem, n_supp):
    snapshot = F.make_date(F.col("year"), F.lit(12), F.lit(31))
    age = F.datediff(snapshot, F.col("acquired_date"))
    item = F.col("l_partkey").cast("decimal(20,0)") * n_supp.cast("decimal(12,0)") + F.col("l_suppkey")
    stock = lineitem.groupBy("l_partkey", "l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.min(F.col("l_shipdate").cast("date")).alias("acquired_date"),
        F.sum(F.col("l_extendedprice").cast("decimal(14,2)")).alias("carrying_cost"),
    )
    return stock.select(
        _id("INV", item).alias("inventory_id"),
        snapshot.alias("snapshot_date"),
        _id("VEH", F.col("l_partkey")).alias("vehicle_id"),
        _id("DLR", F.col("l_suppkey"), 3).alias("dealership_id"),
        "acquired_date",
        F.lit("Available").alias("inventory_status"),
        "carrying_cost",
        age.alias("days_in_inventory"),
        (age > 90).alias("slow_moving_flag"),
    )


def _event_columns(n_part, n_supp):
    key, dealer = F.col("event_id"), F.col("event_id") % n_supp
    return key, dealer, [
        _id("APT", key).alias("appointment_id"),
        _id("CUS", F.col("user_id")).alias("customer_id"),
        _id("VEH", key % n_part).alias("vehicle_id"),
        _id("DLR", dealer, 3).alias("dealership_id"),
        _id("EMP", dealer * 3 + 1).alias("service_advisor_id"),
    ]


def _appointments(events, n_part, n_supp):
    key, _, shared = _event_columns(n_part, n_supp)
    return events.select(
        *shared,
        F.col("ts").cast("date").alias("appointment_date"),
        F.date_format("ts", "HH:mm:ss").alias("appointment_time"),
        _cycle(SERVICE_TYPES, key).alias("service_type"),
        _decode(APPOINTMENT_STATUS, F.col("event_type"), F.lit(None).cast("string")).alias("appointment_status"),
    )


def _orders(events, n_part, n_supp):
    key, dealer, shared = _event_columns(n_part, n_supp)
    labor = F.col("value").cast("decimal(14,2)")
    parts, discount = (key % 700).cast("decimal(14,2)"), (key % 5).cast("decimal(14,2)")

    def later(hours: Column) -> Column:
        return F.timestamp_add("HOUR", hours.cast("int"), F.col("ts"))

    return events.where(F.col("event_type").isin(*ORDER_EVENTS)).select(
        _id("SRO", key).alias("service_order_id"),
        *shared,
        _id("EMP", dealer * 3 + 2).alias("technician_id"),
        F.col("ts").alias("opened_at"),
        later(key % 47 + 2).alias("promised_at"),
        later(key % 60 + 1).alias("completed_at"),
        F.when(key % 40 == 0, "Reopened").otherwise("Completed").alias("order_status"),
        _cycle(PAYERS, key).alias("payer_type"),
        labor.alias("labor_revenue"),
        parts.alias("parts_revenue"),
        discount.alias("discount_amount"),
        (labor + parts - discount).alias("service_revenue"),
    )

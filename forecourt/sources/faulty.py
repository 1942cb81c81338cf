"""A faulty copy of the source datasets, derived row by row from the clean ones.

The verification queries of profiling and cleaning run over whole tables with known kinds of
faults in them. A fault is plain SQL over the clean text columns and ``k``, the number in the
row's identifier; the same text is valid in Spark and in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.contracts import DATASETS
from forecourt.sources.files import as_file_text

# dataset -> column -> replacement expression
FAULTS: dict[str, dict[str, str]] = {
    "customers": {
        "customer_id": "CASE WHEN k % 19 = 0 THEN lower(customer_id) ELSE customer_id END",
        "first_name": "CASE WHEN k % 7 = 0 THEN concat('  ', first_name, ' ') ELSE first_name END",
        "email": "CASE WHEN k % 5 = 0 THEN upper(email) ELSE email END",
        "phone": "CASE WHEN k % 23 = 0 THEN '   ' ELSE phone END",
        "customer_since_date": "CASE WHEN k % 29 = 0 THEN '1999-01-01' WHEN k % 31 = 0 THEN 'not-a-date' "
                               "ELSE customer_since_date END",
        "customer_type": "CASE WHEN k % 3 = 0 THEN concat(' ', lower(customer_type), ' ') "
                         "WHEN k % 37 = 0 THEN 'Robot' ELSE customer_type END",
    },
    "vehicles": {
        "manufacturer_msrp": "CASE WHEN k % 101 = 0 THEN 'not-a-number' ELSE manufacturer_msrp END",
        "mileage_at_acquisition": "CASE WHEN k % 103 = 0 THEN '-5' ELSE mileage_at_acquisition END",
        "vehicle_condition": "CASE WHEN k % 2 = 0 THEN upper(vehicle_condition) ELSE vehicle_condition END",
    },
    "dealerships": {
        "opened_date": "CASE WHEN k % 50 = 49 THEN '31/31/1990' ELSE opened_date END",
        "region": "CASE WHEN k % 10 = 3 THEN NULL ELSE region END",
    },
    "employees": {
        "dealership_id": "CASE WHEN k % 97 = 0 THEN 'DLR-UNKNOWN' ELSE dealership_id END",
        "role": "CASE WHEN k % 41 = 0 THEN 'Juggler' WHEN k % 5 = 0 THEN upper(role) ELSE role END",
    },
    "sales": {
        "sale_date": "CASE WHEN k % 71 = 0 THEN 'soon' ELSE sale_date END",
        "customer_id": "CASE WHEN k % 83 = 0 THEN 'CUS-UNKNOWN' ELSE customer_id END",
        "salesperson_id": "CASE WHEN k % 67 = 0 THEN NULL ELSE salesperson_id END",
        "discount_amount": "CASE WHEN k % 73 = 0 THEN '-1.00' ELSE discount_amount END",
        "sale_price": "CASE WHEN k % 79 = 0 THEN '12345.67' ELSE sale_price END",
        "gross_profit": "CASE WHEN k % 89 = 0 THEN '999999' ELSE gross_profit END",
        "payment_type": "CASE WHEN k % 4 = 0 THEN lower(payment_type) ELSE payment_type END",
    },
    "inventory": {
        "acquired_date": "CASE WHEN k % 53 = 0 THEN '2090-01-01' ELSE acquired_date END",
        "days_in_inventory": "CASE WHEN k % 59 = 0 THEN '-5' WHEN k % 61 = 0 THEN '7' ELSE days_in_inventory END",
        "slow_moving_flag": "CASE WHEN k % 6 = 0 THEN 'YES' WHEN k % 47 = 0 THEN 'maybe' ELSE slow_moving_flag END",
    },
    "service_appointments": {
        "service_advisor_id": "CASE WHEN k % 43 = 0 THEN 'EMP000003' ELSE service_advisor_id END",
        "appointment_date": "CASE WHEN k % 61 = 0 THEN 'tomorrow' ELSE appointment_date END",
        "service_type": "CASE WHEN k % 45 = 7 THEN '' ELSE service_type END",
        "appointment_status": "CASE WHEN k % 9 = 0 THEN upper(appointment_status) ELSE appointment_status END",
    },
    "service_orders": {
        "customer_id": "CASE WHEN k % 53 = 0 THEN 'CUS000000' ELSE customer_id END",
        "vehicle_id": "CASE WHEN k % 57 = 0 THEN 'VEH000001' ELSE vehicle_id END",
        "completed_at": "CASE WHEN k % 47 = 0 THEN '1990-01-01 00:00:00' ELSE completed_at END",
        "labor_revenue": "CASE WHEN k % 77 = 0 THEN 'free' ELSE labor_revenue END",
        "service_revenue": "CASE WHEN k % 21 = 0 THEN '1.00' ELSE service_revenue END",
    },
}
# dataset -> (rows that get one more copy, columns changed in the copy)
COPIES: dict[str, list[tuple[str, dict[str, str]]]] = {
    "customers": [("k % 13 = 0", {}), ("k % 17 = 0", {"city": "'Elsewhere'"})],
    "sales": [("k % 97 = 0", {}), ("k % 91 = 0", {"sales_channel": "'Online'"})],
    "service_orders": [("k % 33 = 0", {})],
}
# Half of the vehicles stay unsold, so that some inventory survives the sold-vehicle rule.
SOLD_VEHICLE = "CASE WHEN CAST(substr(vehicle_id, 4) AS BIGINT) % 2 = 1 THEN 'VEH000002' ELSE vehicle_id END"


def faulty(datasets: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Text datasets with the faults applied and the copies appended."""
    return {name: faulty_dataset(name, datasets[name]) for name in DATASETS}


def faulty_dataset(name: str, frame: DataFrame) -> DataFrame:
    """One of the text datasets."""
    contract = DATASETS[name]
    text = as_file_text(contract, frame)
    if name == "sales":
        text = text.withColumn("vehicle_id", F.expr(SOLD_VEHICLE))
    numbered = text.withColumn("k", F.substring(contract.key, 4, 20).cast("bigint"))
    changes = FAULTS[name]
    broken = numbered.select("k", *[F.expr(changes.get(c, c)).alias(c) for c in contract.columns])
    whole = broken
    for condition, overrides in COPIES.get(name, []):
        whole = whole.unionByName(broken.where(condition).withColumns({c: F.expr(e) for c, e in overrides.items()}))
    return whole.select(*contract.columns)


# Faults of the loaded star schema: table -> column -> expression over its unchanged columns.
STAR_FAULTS: dict[str, dict[str, str]] = {
    "fact_sales": {
        "customer_key": "CASE WHEN sales_key % 19 = 0 THEN NULL WHEN sales_key % 23 = 0 THEN -7 ELSE customer_key END",
        "sale_id": "CASE WHEN sales_key % 29 = 1 THEN 'SAL-TWICE' ELSE sale_id END",
        "unit_quantity": "CAST(CASE WHEN sales_key % 31 = 0 THEN -5 ELSE unit_quantity END AS SMALLINT)",
        "sale_price": "CASE WHEN sales_key % 37 = 0 THEN CAST(-5 AS DECIMAL(14,2)) ELSE sale_price END",
        "dealership_key": "CASE WHEN sales_key % 41 = 0 THEN dealership_key + 1 ELSE dealership_key END",
        "sale_date_key": "CASE WHEN sales_key % 43 = 0 THEN 29990101 ELSE sale_date_key END",
    },
    "fact_inventory": {
        "dealership_key": "CASE WHEN vehicle_key % 13 = 0 THEN NULL WHEN vehicle_key % 17 = 0 THEN -7 ELSE dealership_key END",
        "vehicle_key": "CASE WHEN vehicle_key % 19 = 0 THEN 1 ELSE vehicle_key END",
        "days_in_inventory": "CASE WHEN vehicle_key % 23 = 0 THEN days_in_inventory + 1 ELSE days_in_inventory END",
        "carrying_cost": "CASE WHEN vehicle_key % 29 = 0 THEN CAST(-1 AS DECIMAL(14,2)) ELSE carrying_cost END",
    },
    "fact_service": {
        "customer_key": "CASE WHEN service_fact_key % 19 = 0 THEN NULL WHEN service_fact_key % 23 = 0 THEN -7 ELSE customer_key END",
        "technician_key": "CASE WHEN service_fact_key % 29 = 0 THEN service_advisor_key ELSE technician_key END",
        "appointment_id": "CASE WHEN service_fact_key % 31 = 1 THEN 'APT-TWICE' ELSE appointment_id END",
        "opened_at": "CASE WHEN service_fact_key % 37 = 0 THEN opened_at + INTERVAL '4000' DAY ELSE opened_at END",
        "service_revenue": "CASE WHEN service_fact_key % 41 = 0 THEN CAST(-1 AS DECIMAL(14,2)) ELSE service_revenue END",
    },
    "dim_customer": {
        "customer_id": "CASE WHEN customer_key % 31 = 1 THEN 'CUS-TWICE' ELSE customer_id END",
        "customer_since_date": "CASE WHEN customer_key % 37 = 0 THEN DATE '2999-01-01' ELSE customer_since_date END",
    },
    "dim_vehicle": {"vin": "CASE WHEN vehicle_key % 31 = 0 THEN 'SAME' ELSE vin END"},
    "dim_employee": {
        "employee_id": "CASE WHEN employee_key % 7 = 0 THEN 'EMP-TWICE' ELSE employee_id END",
        "dealership_key": "CASE WHEN employee_key % 11 = 0 THEN 9999999 ELSE dealership_key END",
    },
    "dim_dealership": {"dealership_id": "CASE WHEN dealership_key % 3 = 0 THEN 'DLR-TWICE' ELSE dealership_id END"},
    "service_orders": {"vehicle_id": "CASE WHEN CAST(substr(appointment_id, 4) AS BIGINT) % 47 = 0 THEN 'VEH000000001' ELSE vehicle_id END"},
}


def faulty_star(w):
    """The warehouse with faults in its dimensions and facts, a service type twice and a day far ahead."""
    broken = {}
    for name, changes in STAR_FAULTS.items():
        broken[name] = w.table(name).withColumns({c: F.expr(e) for c, e in changes.items()})
    kinds, days = w.table("dim_service"), w.table("dim_date")
    broken["dim_service"] = kinds.unionByName(kinds)
    ahead = days.orderBy("date_key").limit(1).withColumns({"date_key": F.lit(29990101), "full_date": F.lit("2999-01-01").cast("date")})
    broken["dim_date"] = days.unionByName(ahead)
    return w.replace(**broken)

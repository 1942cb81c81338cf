"""Hand fixtures of the measures, with known answers."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

import pytest

from forecourt.operators.measures import FilterContext, evaluate, kpis, selected_labels, snapshot_measures
from forecourt.operators.scenarios import alternate_kpis, compare_kpis, scenario_comparison
from forecourt.plans.model import SemanticModel, grain_errors


@pytest.fixture(scope="module")
def tables(spark):
    make = spark.createDataFrame
    return {
        "dim_customer": make([(1, "A"), (2, "B"), (3, "C")], "customer_key bigint, customer_id string"),
        "dim_vehicle": make([(1, "X", "M1", 2020, "SUV"), (2, "Y", "M2", 2021, "Sedan")],
                            "vehicle_key bigint, brand string, model string, model_year int, vehicle_type string"),
        "fact_sales": make(
            [("S1", 1, 1, 1, 20240131, "Completed", Decimal(100), 1, Decimal(10)),
             ("S2", 3, 2, 2, 20240201, "Returned", Decimal(-100), -1, Decimal(-10))],
            "sale_id string, customer_key bigint, vehicle_key bigint, dealership_key bigint, sale_date_key int, "
            "sale_status string, revenue decimal(16,2), units_sold int, gross_profit decimal(16,2)"),
        "fact_inventory": make(
            [(1, 1, 20240101, 1, Decimal(9999), 500), (1, 1, 20240201, 1, Decimal(20), 90),
             (2, 2, 20240201, 1, Decimal(30), 91)],
            "vehicle_key bigint, dealership_key bigint, snapshot_date_key int, inventory_units int, "
            "inventory_value decimal(14,2), days_in_inventory int"),
        "fact_service": make(
            [("A1", 1, "O1", 1, 1, 1, 20240131, 20240201, "Completed", Decimal(30), 1, 1),
             ("A2", 2, "O2", 2, 2, 2, 20240201, 20240202, "Completed", Decimal(40), 1, 1),
             ("A3", None, None, 3, 2, 2, 20240201, None, None, Decimal(0), 0, 1)],
            "appointment_id string, service_fact_key bigint, service_order_id string, customer_key bigint, "
            "vehicle_key bigint, dealership_key bigint, appointment_date_key int, completed_date_key int, "
            "order_status string, service_revenue decimal(16,2), completed_appointment_count int, "
            "completion_eligible_count int"),
    }


def values(tables, **filters):
    return kpis(SemanticModel(tables), FilterContext(**filters)).first().asDict()


def test_unfiltered(tables):
    got = values(tables)
    assert (got["revenue"], got["units_sold"], got["gross_profit"], got["gross_margin"]) == (0, 0, 0, None)
    assert (got["inventory_value"], got["average_days_in_inventory"], got["slow_moving_vehicles"]) == (50, Decimal("90.5"), 1)
    assert (got["service_revenue"], got["service_orders"], got["average_repair_order"]) == (70, 2, 35)
    assert (got["repeat_customers"], got["repeat_rate"], got["customers"]) == (1, Decimal("0.5"), 3)


def test_january_uses_completion_date_and_earlier_snapshot(tables):
    got = values(tables, start=date(2024, 1, 1), end=date(2024, 1, 31))
    assert (got["service_revenue"], got["completion_rate"], got["inventory_value"], got["repeat_customers"]) == (0, 1, 9999, 0)


def test_february_lifetime_value_drops_the_lower_bound(tables):
    got = values(tables, start=date(2024, 2, 1), end=date(2024, 2, 29))
    assert (got["service_revenue"], got["repeat_customers"], got["customer_lifetime_value"]) == (70, 0, 70)


def test_empty_slice_is_zero_and_customers_stay(tables):
    got = values(tables, brand="UNKNOWN")
    assert (got["revenue"], got["repeat_customers"], got["inventory_units"], got["customers"]) == (0, 0, 0, 3)


def test_no_snapshot_is_null(tables):
    got = values(tables, end=date(1900, 1, 1))
    assert got["inventory_value"] is None and got["inventory_units"] is None and got["slow_moving_vehicles"] is None


def test_as_of_is_independent_of_the_period(tables):
    model = SemanticModel(tables)
    ctx = FilterContext(end=date(2024, 2, 29), as_of=date(2024, 1, 15))
    row = evaluate(model, ("inventory_value", "executive_inventory_value"), ctx).first()
    assert (row["inventory_value"], row["executive_inventory_value"]) == (9999, 50)
    assert snapshot_measures(model, ctx).first()["inventory_snapshot_key"] == 20240101


def test_reopened_orders_do_not_count(spark, tables):
    more = tables["fact_service"].unionByName(spark.createDataFrame(
        [("A4", 3, "O3", 3, 1, 1, 20240201, 20240203, "Reopened", Decimal(500), 1, 1),
         ("A5", None, None, 1, 1, 1, 20240201, None, None, Decimal(0), 0, 0)], tables["fact_service"].schema))
    got = values({**tables, "fact_service": more})
    assert (got["average_repair_order"], got["customer_lifetime_value"]) == (35, 70)
    assert round(got["completion_rate"], 8) == Decimal("0.75")


def test_empty_facts(tables):
    empty = {n: (f.limit(0) if n.startswith("fact") else f) for n, f in tables.items()}
    got = values(empty)
    assert (got["service_orders"], got["repeat_customers"]) == (0, 0)
    assert got["average_repair_order"] is got["completion_rate"] is got["repeat_rate"] is None


def test_selected_labels(tables):
    model = SemanticModel(tables)
    assert tuple(selected_labels(model).first()) == ("All Brands", "All Models", "All Vehicle Types")
    assert tuple(selected_labels(model, FilterContext(brand="X")).first()) == ("X", "M1", "SUV")


def test_duplicate_service_order_is_a_grain_error(tables):
    doubled = tables["fact_service"].unionByName(tables["fact_service"].where("appointment_id = 'A1'"))
    rows = {r["grain"]: r["repeated_keys"] for r in grain_errors(SemanticModel({**tables, "fact_service": doubled})).collect()}
    assert rows["fact_service(service_order_id)"] == 1 and rows["fact_service(appointment_id)"] == 1


CONTEXTS = [
    {}, {"brand": "__NO_SUCH_BRAND__"}, {"end": date(1900, 1, 1)}, {"dealership": 3}, {"brand": "Brand#2"},
    {"vehicle_type": "ECONOMY"}, {"start": date(2024, 1, 1), "end": date(2024, 1, 31)},
    {"start": date(1997, 1, 1), "end": date(1999, 12, 31), "brand": "Brand#2"},
]


@pytest.mark.parametrize("filters", CONTEXTS, ids=str)
def test_two_computations_agree(loaded, filters):
    ctx = FilterContext(**filters)
    rows = compare_kpis(alternate_kpis(loaded, ctx), kpis(SemanticModel.of(loaded), ctx)).collect()
    assert len(rows) == 17 and {r["status"] for r in rows} == {"PASS"}, rows


def test_all_scenarios_agree(loaded):
    assert scenario_comparison(loaded).where("status <> 'PASS'").count() == 0


def test_tolerances(spark):
    def frame(revenue, units, rate):
        return spark.createDataFrame([(Decimal(revenue), units, Decimal(rate))],
                                     "revenue decimal(20,2), units_sold bigint, repeat_rate decimal(38,18)")

    def statuses(a, b):
        return {r["kpi"]: r["status"] for r in compare_kpis(a, b).collect()}

    base = frame("10.00", 5, "0.5")
    assert set(statuses(base, frame("10.01", 5, "0.500000005")).values()) == {"PASS"}
    assert set(statuses(base, frame("10.02", 6, "0.50000002")).values()) == {"FAIL"}
    assert statuses(base, base.drop("units_sold"))["units_sold"] == "FAIL"


def test_slowly_changing_customers_count_once(spark, tables):
    versions = spark.createDataFrame([(1, "A"), (2, "A"), (3, "C")], "customer_key bigint, customer_id string")
    got = values({**tables, "dim_customer": versions})
    assert (got["customers"], got["repeat_customers"], got["repeat_rate"]) == (2, 1, 1)

"""Queries that read few columns of a detail run without building it, with the rows of the detail."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import SF
from forecourt.operators import reconcile, scenarios
from forecourt.plans import model, narrow, pages
from forecourt.plans.model import SemanticModel
from forecourt.plans.warehouse import Warehouse
from forecourt.sources.order_tables import read_order_tables
from forecourt.sources.store import TableStore

DETAILS = ("sales_detail", "inventory_detail", "service_detail")


def rows(frame):
    return Counter(map(tuple, frame.collect()))


def fresh(spark, folder, **changed):
    staged = read_order_tables(spark, SF)
    return Warehouse({**staged, **{n: f(staged[n]) for n, f in changed.items()}}, TableStore.create(spark, str(folder)))


def without(*columns):
    """Some keys NULL, some of an unknown entity, some rows twice."""
    def change(frame):
        n = F.xxhash64(*frame.columns) % 11
        odd = frame.withColumns({c: F.when(n == i, None).when(n == -1 - i, "XYZ999999").otherwise(F.col(c)) for i, c in enumerate(columns)})
        return odd.unionByName(odd.where(n == 5)).localCheckpoint()
    return change


ODD = {"sales": without("customer_id", "vehicle_id", "dealership_id", "salesperson_id"),
       "service_appointments": without("service_type", "vehicle_id", "service_advisor_id")}


@pytest.mark.parametrize("changed", [{}, ODD], ids=["sound", "odd"])
def test_narrow_facts_are_the_details(spark, tmp_path, changed):
    w = fresh(spark, tmp_path, **changed)
    few, facts = SemanticModel.narrow(w), {}
    for name in model.FACT_COLUMNS:
        assert narrow.suffices(w, name)
        facts[name] = (few.rows(name).schema.simpleString(), rows(few.rows(name)), rows(few.table(name)))
    grains, swept = rows(model.grain_errors(few)), rows(scenarios.scenario_kpis(few))
    checked = rows(reconcile.model_checks(w))
    page = rows(pages.page(w, "inventory_slow_moving", limit=300, brand="Brand#2"))
    assert not any(w.has(name) for name in DETAILS)
    whole = SemanticModel.of(w)
    for name, (schema, bare, labelled) in facts.items():
        want = whole.table(name)
        assert (schema, bare, labelled) == (want.select(*model.FACT_COLUMNS[name]).schema.simpleString(),
                                            rows(want.select(*model.FACT_COLUMNS[name])), rows(want))
    assert grains == rows(model.grain_errors(whole)) and swept == rows(scenarios.scenario_kpis(whole))
    assert all(w.has(name) for name in DETAILS)
    assert checked == rows(reconcile.model_checks(w))
    assert page == rows(pages.page(w, "inventory_slow_moving", limit=300, brand="Brand#2"))


def test_repeated_dimension_keys_are_joined(spark, tmp_path):
    w = fresh(spark, tmp_path, vehicles=lambda f: f.unionByName(f.limit(3)))
    assert not any(narrow.suffices(w, name) for name in model.FACT_COLUMNS)
    assert rows(model.grain_errors(SemanticModel.narrow(w))) == rows(model.grain_errors(SemanticModel.of(w)))


@pytest.mark.parametrize("changed", [{}, ODD], ids=["sound", "odd"])
def test_comparison_and_export_build_no_detail(spark, tmp_path, changed):
    w = fresh(spark, tmp_path, **changed)
    compared, exported = rows(scenarios.scenario_comparison(w)), {name: rows(frame) for name, frame in model.exported(w).items()}
    assert not any(w.has(name) for name in (*DETAILS, "fact_sales", "fact_inventory"))
    assert exported == {name: rows(model.model_table(w, name)) for name in model.TABLES}
    assert all(w.has(name) for name in DETAILS)
    assert compared == rows(scenarios.scenario_comparison(w)) and len(compared) > 0

"""Dangling keys: found from distinct keys, counted once per row, without moving the rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from forecourt.operators import quality, warehouse
from forecourt.operators.keysets import Dangling, Link, dangling
from forecourt.sources.faulty import faulty_star
from forecourt.sources.store import written_stages


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    fact = spark.createDataFrame([(1, 1, 10), (2, 1, 10), (3, 2, 10), (None, 1, 10), (9, 9, 10), (9, None, 11), (1, 1, None), (-4, 2, 11), (1 << 61, 2, 10)],
                                 "a bigint, b int, home int")
    one = spark.createDataFrame([(1,), (2,), (2,), (3,), (-4,), (1 << 61,)], "k bigint")
    two = spark.createDataFrame([(1, 10), (2, 10), (2, 12)], "k int, home int")
    return fact, [Link("a", one, "k"), Link("b", two, "k", "home", "home")]


def test_dangling_keys(tables):
    fact, links = tables
    assert {tuple(r) for r in dangling(fact, links).collect()} == {(0, 9, 0, 2), (1, 1, None, 1), (1, 2, 11, 1), (1, 9, 10, 1)}


def test_rows(spark, tables):
    fact, links = tables
    sets = Dangling(fact, links, written_stages(spark), "t")
    want = [(1, 1, 10), (2, 1, 10), (3, 2, 10), (1 << 61, 2, 10)]
    assert sorted(map(tuple, sets.resolved(fact).collect())) == sorted(want)
    assert sets.unresolved(fact).first().failed_count == fact.count() - len(want)
    assert Dangling(fact.limit(0), links, written_stages(spark), "t").unresolved(fact.limit(0)).first().failed_count == 0


def test_a_sound_fact_is_loaded_without_a_join(loaded):
    for build, joins in ((warehouse.fact_sales, 0), (warehouse.fact_inventory, 0), (warehouse.fact_service, 1)):
        plan = plan_of(build(loaded))
        assert len(re.findall(r"\b\w*Join\b", plan.split("== Initial Plan ==")[0])) == joins, plan


def test_checks_send_keys_and_not_rows(loaded):
    plan = plan_of(dangling(loaded.table("fact_service"), [Link("customer_key", loaded.table("dim_customer"), "customer_key")]))
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert re.search(r"hashpartitioning\(link#\d+, key#\d+L?, within#\d+L?", line), line


def test_faulty_keys_reach_the_rows_as_a_short_list(loaded):
    broken = faulty_star(loaded)
    frame = broken.table("fact_sales").select(*[c for c, _, _ in quality.SALES_LINKS])
    sets = Dangling(frame, [Link(c, broken.table(d), k) for c, d, k in quality.SALES_LINKS], written_stages(frame.sparkSession), "t")
    assert sets.bad
    plan = plan_of(sets.unresolved(frame))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_facts_drop_what_does_not_resolve(sample):
    from forecourt.plans.warehouse import Warehouse

    for column, value in (("customer_id", "CUS999999"), ("vehicle_id", "x"), ("dealership_id", "DLR999"), ("salesperson_id", None)):
        tables = {**sample, "sales": sample["sales"].withColumn(column, F.when(F.col("sale_id") == "SAL000003", F.lit(value)).otherwise(F.col(column)))}
        kept = Warehouse(tables).table("fact_sales")
        assert kept.count() == sample["sales"].count() - 1 and kept.where("sale_id = 'SAL000003'").count() == 0
    other = sample["employees"].where("role <> 'Sales Consultant' and role <> 'Salesperson'").first()
    tables = {**sample, "sales": sample["sales"].withColumn("salesperson_id", F.when(F.col("sale_id") == "SAL000003", F.lit(other.employee_id)).otherwise(F.col("salesperson_id")))}
    if other.role != warehouse.SALES_ROLE:
        assert Warehouse(tables).table("fact_sales").where("sale_id = 'SAL000003'").count() == 0

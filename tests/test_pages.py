"""Deep and keyset pages against a plain sort."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from forecourt.plans import pages


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    made = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b"]), i) for i in range(400)]
    rng.shuffle(made)
    return spark.createDataFrame(made, "x int, y string, id int").repartition(6).cache()


ORDERS = [(("x", True), ("y", False), ("id", False)), (("y", True), ("x", True), ("id", True)), (("x", False), ("y", False), ("id", True))]


@pytest.mark.parametrize("order", ORDERS)
def test_after_every_row_nulls_included(rows, order):
    ordering = [F.desc(c) if down else F.asc(c) for c, down in order]
    sorted_ = rows.orderBy(*ordering).collect()
    for seen in (1, 37, 101, 202, 303, 399, 400):
        after = tuple(sorted_[seen - 1][c] for c, _ in order)
        assert rows.where(pages._beyond(order, after)).orderBy(*ordering).collect() == sorted_[seen:]


@pytest.mark.parametrize("order", ORDERS)
def test_places_are_those_of_the_sort(rows, order):
    ordering = [F.desc(c) if down else F.asc(c) for c, down in order]
    sorted_ = rows.orderBy(*ordering).collect()
    for offset, limit in ((0, 5), (3, 400), (130, 77), (395, 10), (400, 3), (900, 3)):
        assert pages._from_place(rows, ordering, offset, limit).collect() == sorted_[offset:offset + limit]


def test_deep_page_is_the_shallow_one(loaded):
    shallow = pages.page(loaded, "sales", limit=50, offset=700).collect()
    deep = pages.page(loaded, "sales", limit=50, offset=700, deep=10)
    assert deep.collect() == shallow and len(shallow) == 50
    plan = deep._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "_place" in plan and "limit=50," in plan.replace(" ", "").replace("limit=50", "limit=50,")
    assert pages.page(loaded, "sales", limit=50, offset=10**6).count() == 0


def test_pages_behind_one_another_are_the_whole(loaded):
    whole, after = [], None
    order = pages.RESOURCES["service"].order
    while part := pages.page(loaded, "service", limit=300, after=after).collect():
        whole += part
        after = tuple(part[-1][c] for c, _ in order)
    assert len(whole) == loaded.table("service_detail").count() == len({r.appointment_id for r in whole})

"""Temperature mixing against its SQL twin and against its own promises."""

from __future__ import annotations

import math
from collections import Counter, defaultdict

import duckdb
import pytest

from forecourt.llm import mixing, oracle, queries
from forecourt.llm.stages import written
from conftest import SF


@pytest.mark.parametrize("folder", [SF, "/root/testdata/sf0.01"])
def test_twin(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    cursor = con.execute(oracle.OP4)
    names = [d[0] for d in cursor.description]
    want = Counter(cursor.fetchall())
    frame = queries.source_mixing(spark, folder).select(names)
    assert Counter(map(tuple, frame.collect())) == want and sum(want.values()) > 0


def rows_of(spark, sizes, each=10):
    rows = [(i * 1000 + k, None if s == 0 else f"s{s}", each, "t") for i, s in enumerate(sizes) for k in range(sizes[s] // each)]
    return spark.createDataFrame(rows, "doc_id bigint, source string, n_tokens bigint, rest string"), rows


def test_budget_epochs_and_blocks(spark):
    sizes = {0: 4000, 1: 400, 2: 200, 3: 40}
    frame, rows = rows_of(spark, sizes)
    mix = mixing.Mix(entropy_share=0.9, repetitions=3.0, block_tokens=256)
    plan = {r.source: r for r in mixing.source_plan(frame, mix, written(spark, "t")).collect()}
    drawn = mixing.mixed(frame, written(spark, "t"), mix).collect()
    total, by = sum(sizes.values()), defaultdict(Counter)
    for r in drawn:
        by[r.source][r.doc_id] += 1
        assert r.rest == "t"
    weights = [p.weight for p in plan.values()]
    entropy = -sum(w * math.log(w) for w in weights)
    assert abs(sum(weights) - 1) < 1e-12
    assert all(p.quota <= 3.0 * p.tokens + 1 for p in plan.values())
    assert entropy >= 0.9 * math.log(4) - 1e-9 or max(p.quota / p.tokens for p in plan.values()) > 2.99
    for source, p in plan.items():
        used = 10 * sum(by[source].values())
        assert p.quota - 10 < used <= p.quota
        assert set(by[source].values()) <= {p.epochs, p.epochs + 1}
    assert sum(p.quota for p in plan.values()) <= total


def test_limit_wins_and_small_budget(spark):
    frame, _ = rows_of(spark, {1: 9000, 2: 100})
    tight = mixing.Mix(entropy_share=1.0, repetitions=1.5)
    plan = {r.source: r for r in mixing.source_plan(frame, tight, written(spark, "t")).collect()}
    assert plan["s2"].quota <= 150 and plan["s2"].quota >= 148
    few = mixing.mixed(frame, written(spark, "t"), mixing.Mix(budget=500, entropy_share=0.5)).collect()
    assert sum(r.n_tokens for r in few) <= 500 and all(r.epoch == 0 for r in few)
    over = mixing.Mix(budget=50_000, repetitions=2.0)
    assert {r.epochs for r in mixing.source_plan(frame, over, written(spark, "t")).collect()} == {5}


def test_odd_rows(spark):
    rows = spark.createDataFrame([(1, "a", 5, 9), (1, "a", 5, 9), (None, "a", 5, 9), (2, None, 5, 9), (3, "b", 0, 9), (4, "b", None, 9)],
                                 "doc_id bigint, source string, n_tokens bigint, left int")
    got = mixing.mixed(rows, written(spark, "t"), mixing.Mix(entropy_share=0.1)).collect()
    assert sorted((r.doc_id or 0, r.source or "", r.left) for r in got) == [(0, "a", 9), (1, "a", 9), (1, "a", 9), (2, "", 9)]
    assert mixing.mixed(rows.limit(0), written(spark, "t")).count() == 0
    counted = spark.createDataFrame([("a\x0bb c",), (None,), ("",)], "text string").select(mixing.word_count().alias("n"))
    assert [r.n for r in counted.collect()] == [3, 0, 0]

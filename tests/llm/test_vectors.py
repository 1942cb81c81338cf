"""Embedding near-duplicates and exact top-k against brute force."""

from __future__ import annotations

import duckdb
import numpy as np
import pytest

from forecourt.llm import caps, oracle, queries, vafile
from forecourt.llm.stages import written
from conftest import SF


def twin(name, columns):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    return sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({oracle.SQL[name]})").fetchall())


def test_twins(spark):
    names = ["vec_id", "n_links", "component_id", "kept"]
    got = sorted(map(tuple, queries.embedding_near_dedup(spark, SF).select(names).collect()))
    assert got == twin("op6_embedding_near_dedup", names)
    names = ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, queries.exact_top_k(spark, SF).select(names).collect())) == twin("op8_exact_top_k", names)


def clustered(n=600, dims=24, seed=2):
    rng = np.random.default_rng(seed)
    heads = rng.normal(size=(n // 12, dims))
    x = np.concatenate([heads[rng.integers(0, len(heads), n - 40)] + rng.normal(size=(n - 40, dims)) * rng.choice([0, .02, .08, .16, 3], (n - 40, 1)),
                        np.repeat(heads[:1], 40, 0) + rng.normal(size=(40, dims)) * .1])
    return x.astype(np.float32), rng.integers(0, 2, n)


@pytest.mark.parametrize("chunk", [2048, 8])
def test_links_as_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(caps, "CHUNK", chunk)
    x, label = clustered()
    frame = spark.createDataFrame([(i * 3 % 600, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, label))],
                                  "vec_id bigint, embedding array<float>, label int")
    ids, units = np.arange(600) * 3 % 600, x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    # ids repeat for i and i + 200 and i + 400: rows count each
    near = (units @ units.T >= .98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    got = caps.near_duplicates(frame, written(spark, "t")).collect()
    assert sorted((r.vec_id, r.n_links) for r in got) == sorted(zip(ids.tolist(), near.sum(axis=1).tolist()))


def test_components_and_odd_vectors(spark):
    one, nan, inf = [1.0, 0.0, 0.0], float("nan"), float("inf")
    rows = [(5, one, 1), (3, [2.0, 0.0, 0.0], 1), (9, one, 1), (1, one, 2), (2, one, None), (4, None, 1), (6, [0.0, 0.0, 0.0], 1),
            (7, [nan, 1.0, 0.0], 1), (8, [inf, 1.0, 0.0], 1), (10, [None, 1.0, 0.0], 1), (11, [1.0], 1), (None, one, 1), (12, [], 1)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").withColumn("kept", frame_lit())
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in caps.near_duplicates(frame, written(spark, "t")).collect()}
    alone = {i: (0, i, True) for i in (1, 2, 4, 6, 7, 8, 10, 11, 12)}
    assert got == {5: (2, 3, False), 3: (2, 3, True), 9: (2, 3, False), None: (0, None, True), **alone}
    assert caps.near_duplicates(frame.limit(0), written(spark, "t")).count() == 0


def frame_lit():
    from pyspark.sql import functions as F

    return F.lit("other")


def test_top_k_with_ties_and_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(vafile, "QUERIES", 3)
    monkeypatch.setattr(vafile, "SHARD", 50)
    monkeypatch.setattr(vafile, "STEP", 4)
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(300, 5)) * 2) / 4
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(900, None), (901, [None] * 5), (902, [float("nan")] * 5), (903, [1.0]), (904, []),
                                                         (905, [3e5, -7e5, 1.0, 2.0, 3.0]), (None, [1.0] * 5), (17, x[3].tolist())]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    file = vafile.approximate(vafile.integer_vectors(frame), written(spark, "t"))
    asked = file.exact.where("vec_id % 50 = 0 or vec_id in (903, 904, 905)").select("vec_id", "v")
    got = sorted(map(tuple, vafile.top_k(file, asked, 10).collect()))
    exact = [(i, np.floor(np.array(v) * 1024).astype(np.int64)) for i, v in rows if i is not None and v is not None and None not in v and not np.isnan(v).any()]
    want = []
    for q, v in exact:
        if q % 50 == 0 or q in (903, 904, 905):
            scored = sorted((-int(v @ w), i) for i, w in exact if i != q and len(w) == len(v))[:10]
            want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    assert got == sorted(want)
    assert vafile.top_k(file, asked.limit(0)).count() == 0
    nothing = vafile.approximate(vafile.integer_vectors(frame.limit(0)), written(spark, "t"))
    assert vafile.top_k(nothing, asked).count() == 0


def test_scan_moves_cells_and_reads_few_exact_vectors(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(3000, 32)).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id bigint, embedding array<float>")
    made = {}

    def stage(step, frame, real=written(spark, "t")):
        made[step] = frame
        return real(step, frame)

    file = vafile.approximate(vafile.integer_vectors(frame), stage)
    assert file.cells.columns == ["dims", "shard", "row", "vec_id", "cells"]
    assert {len(r.cells) for r in file.cells.limit(5).collect()} == {32}
    vafile.top_k(file, file.exact.where("vec_id % 100 = 0").select("vec_id", "v"), 10).collect()
    assert made["possible"].count() < 30 * 40  # of 30 * 2999
    for line in made["bounds"]._jdf.queryExecution().executedPlan().toString().splitlines():
        assert "FileScan" not in line or "cells" in line or "asked" in line


@pytest.mark.parametrize("large", [1e16, 1e300, -5e12])
def test_components_too_large_fail(spark, large):
    frame = spark.createDataFrame([(0, [large]), (1, [1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large to search"):
        vafile.approximate(vafile.integer_vectors(frame), written(spark, "t"))


def test_scores_too_large_fail(spark):
    frame = spark.createDataFrame([(0, [4e12]), (1, [4e12])], "vec_id bigint, embedding array<double>")
    file = vafile.approximate(vafile.integer_vectors(frame), written(spark, "t"))
    with pytest.raises(Exception, match="may not fit"):
        vafile.top_k(file, file.exact.select("vec_id", "v"), 1).collect()


def test_caps_find_pairs_at_the_threshold():
    """Random pairs of cosine 0.98 share a cap, for tables of any size."""
    rng = np.random.default_rng(6)
    a = rng.normal(size=(300, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.normal(size=(300, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98 ** 2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    for vectors in (50_000, 10 ** 7):
        held = caps.Caps(64, caps.side_of(vectors))
        (row, code), (other, same) = held.decode(a), held.decode(b)
        one, two = set(zip(row.tolist(), code.tolist())), set(zip(other.tolist(), same.tolist()))
        assert len({r for r, _ in one & two}) >= 297

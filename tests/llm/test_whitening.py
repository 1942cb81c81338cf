"""Whitening against numpy on dense matrices, and its eigenvectors on hard ones."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import queries, whitening
from forecourt.llm.stages import written
from conftest import SF


def checked(v, k):
    values, units = whitening.leading_components(v, k)
    want = np.linalg.eigvalsh(v)[::-1][:len(values)]
    size = np.abs(want).max()
    assert np.allclose(values, want, atol=1e-13 * size, rtol=0)
    assert np.abs(units.T @ units - np.eye(len(values))).max() < 1e-12
    assert np.abs(v @ units - units * values).max() < 1e-12 * size
    return values, units


def test_eigenvectors():
    rng = np.random.default_rng(3)
    for p in (1, 2, 3, 17, 64, 150):
        x = rng.normal(size=(4 * p, p)) * rng.uniform(.1, 30, p)
        assert len(checked(x.T @ x, 32)[0]) == min(32, p)
    turn = np.linalg.qr(rng.normal(size=(40, 40)))[0]
    for e in (np.r_[np.full(20, 5.0), np.full(20, 1.0)], np.r_[5.0, 5 + 1e-9, 5 - 1e-12, np.linspace(1, 2, 37)], np.ones(40)):
        assert len(checked(turn * e @ turn.T, 32)[0]) == 32
    checked(np.diag(np.arange(1.0, 50)), 32)  # nothing beside the diagonal
    low = rng.normal(size=(40, 6))
    assert len(checked(low @ low.T, 32)[0]) == 6
    assert len(whitening.leading_components(np.zeros((5, 5)), 3)[0]) == 0


def brute(vectors):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, total = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, total)) for row in x]
    d = (n * x - total) / n
    v = d.T @ d / n
    values, units = np.linalg.eigh(v)
    return n, deviation, d, values[::-1], units[:, ::-1], np.trace(v)


def test_whole_query_as_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviation, d, values, units, trace = brute([r.embedding for r in rows])
    out = queries.embedding_whitening(spark, SF)
    assert dict(out.dtypes)["deviation"] == "bigint"
    out = out.toPandas().sort_values(["vec_id", "component"])
    assert len(out) == 32 * len(rows) and (out.n == n).all()
    assert out.vec_id.tolist() == [r.vec_id for r in rows for _ in range(32)]
    assert out.component.tolist() == list(range(1, 33)) * n
    assert out.deviation.tolist() == [x for x in deviation for _ in range(32)]
    assert np.allclose(out.explained.to_numpy().reshape(n, 32), values[:32] / trace, rtol=1e-10)
    assert out.identity_error.nunique() == 1 and out.identity_error.max() < 1e-10
    got, want = out.whitened.to_numpy().reshape(n, 32), d @ units[:, :32] / np.sqrt(values[:32])
    assert np.abs(got - want * np.sign((got * want).sum(axis=0))).max() < 1e-8


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 7), float(i * i % 5), 1e6 if i == 3 else 0.25]) for i in range(40)]
    odd = [(50, None), (51, [nan, 1.0, 2.0]), (52, [inf, 1.0, 2.0]), (53, [None, 1.0, 2.0]), (54, []), (55, [3.0, 4.0]), (56, [9.0])]
    rows = [*good, (None, [1.0, 2.0, 3.0]), (5, [5.0, 0.0, 0.25]), *odd, (57, [3.0, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumns({"whitened": F.lit("x"), "dims": F.lit(1), "x": F.lit(2)})
    out = whitening.whiten(frame, written(spark, "t")).collect()
    three = [v for i, v in [*good, (None, [1.0, 2.0, 3.0]), (5, [5.0, 0.0, 0.25])]]
    n, deviation, d, values, units, _ = brute(three)
    got = sorted((r.vec_id if r.vec_id is not None else -1, int(r.deviation)) for r in out if r.n == n and r.component == 1)
    ids = [*range(40), -1, 5]
    assert got == sorted(zip(ids, deviation))
    assert {(r.vec_id, r.component, r.n, int(r.deviation)) for r in out if r.n == 2} == {(55, 1, 2, 4096), (57, 1, 2, 4096)}
    assert {r.n for r in out} == {n, 2} and len(out) == 3 * n + 2
    assert abs(sum(r.whitened ** 2 for r in out if r.n == n and r.component == 2) / n - 1) < 1e-9
    assert whitening.whiten(frame.limit(0), written(spark, "t")).count() == 0
    large = spark.createDataFrame([(1, [1e300]), (2, [1.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(Exception, match="too large to whiten"):
        whitening.whiten(large, written(spark, "t")).count()


def test_exact_beyond_64_bits():
    space = whitening.Space(1 << 30, [3, -(1 << 62)])
    x = np.array([[1 << 39, -5]])
    want = (int(x[0, 0]) * space.n - 3) ** 2 + (-5 * space.n + (1 << 62)) ** 2
    assert [int(v) for v in whitening.deviations(whitening.Space(1 << 20, [3, 7]).numerators(x // 8)).to_pylist()] == [
        ((int(x[0, 0]) // 8) * (1 << 20) - 3) ** 2 + (-1 * (1 << 20) - 7) ** 2]
    with pytest.raises(Exception):
        whitening.deviations(whitening.Space(1 << 60, [0, 0]).numerators(x))  # 40 digits
    assert space.numerators(x)[0].tolist() == [int(x[0, 0]) * space.n - 3, -5 * space.n + (1 << 62)] and want > 1 << 64


def test_space_too_large(spark, monkeypatch):
    monkeypatch.setattr(whitening, "MATRIX_BYTES", 64)
    frame = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "vec_id bigint, embedding array<double>")
    with pytest.raises(ValueError, match="too large"):
        whitening.whiten(frame, written(spark, "t"))

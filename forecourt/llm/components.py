"""Connected components of a large edge table by alternating stars.

One round is a large star (every node hands its larger neighbours its smallest neighbour) and
a small star (every node hands its smaller neighbours and itself the smallest of them). Both
are one aggregate and one join; the number of rounds grows with the logarithm of the longest
path. Each round is written to the shared folder, so a lost executor never costs earlier rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.stages import Stage


THINNED = 1 << 20


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) -> for THINNED edges at a time, (node, smallest node that they connect it to)."""
    kin: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := kin.setdefault(x, x)) != x:
            kin[x] = x = kin[up]
        return x

    def met() -> pa.RecordBatch:
        found = [(x, y) for x in kin if (y := root(x)) != x]
        return pa.record_batch([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64())], ["a", "b"])

    seen = 0
    for batch in batches:
        for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
            x, y = sorted((root(a), root(b)))
            kin[y] = x
        if (seen := seen + batch.num_rows) >= THINNED:
            yield met()
            kin.clear()
            seen = 0
    yield met()


def thinned(edges: DataFrame) -> DataFrame:
    """Fewer edges (a, b) that connect the same nodes: each task ties what its own edges connect to the smallest node of it.

    For tables with far more edges than nodes; their ends are bigint and not null.
    """
    return edges.select("a", "b").mapInArrow(_stars, "a bigint, b bigint")


def _star(arcs: DataFrame) -> DataFrame:
    """Arcs (u, v) -> (u, v, m) with m the smallest of u and all its v."""
    least = arcs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return arcs.join(least, "u")


def _large(edges: DataFrame) -> DataFrame:
    arcs = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    arcs = arcs.union(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _star(arcs).where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))


def _small(edges: DataFrame) -> DataFrame:
    arcs = _star(edges.select(F.col("a").alias("u"), F.col("b").alias("v")))
    handed = arcs.select(F.explode(F.array(
        F.struct(F.col("u").alias("a"), F.col("m").alias("b")),
        F.struct(F.col("v").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
    return handed.where("a > b").distinct()


def connected_components(edges: DataFrame, stage: Stage) -> DataFrame:
    """(node, component) for every node of an edge table (a, b); component is the smallest node.

    Edges in either direction, repeated edges and loops are fine; edges with a null end are
    left out. Nodes without an edge to another node do not occur. No edges give no rows.
    """
    oriented = edges.where("a is not null and b is not null and a <> b") \
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, before = stage("edges", oriented), None
    while True:
        seen = current.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("b").cast("double"))).first()
        if seen == before or seen[0] == 0:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                current.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        before, current = seen, stage("round", _small(_large(current)))

"""Exact top-k inner products through vector-approximation files.

A vector is cut into cells: each dimension of its integer components is quantised to one of
``CELLS`` equal steps between the smallest and the largest component of that dimension over the
whole table, a byte per dimension. For a query, the cell of a candidate bounds its score from
above and below (each component takes the cell's far or near end by the sign of the query's). The
file of cells is scanned alone: a shard hands on what its own k-th best lower bound does not rule
out, and what the k-th best lower bound over all shards rules out goes next. Only then are exact
vectors read, by row: for each query first the k candidates of the best upper bounds, then those
whose upper bound reaches the k-th exact score so far, after which the answer is certain.

The scan moves cells and queries, never the exact vectors; the grid of a vector length is two
numbers per dimension and goes with the task. Queries come in chunks of ``QUERIES``, which bounds
what a task holds; each chunk meets every shard of at most about ``SHARD`` vectors once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.stages import Stage

CELLS, QUERIES, SHARD, STEP = 256, 4096, 16_384, 64
GRID_ROWS = 1 << 20
ENTRY_BITS = 52


def usable(vector: Column) -> Column:
    """True for a vector that is not null and has only finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def integer_vectors(vectors: DataFrame, scale: int = 1024) -> DataFrame:
    """(vec_id, v): usable vectors with components floor(scale * x), x as double; 2^52 and more fail the job."""

    def whole(x):
        scaled = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(scaled) < float(1 << ENTRY_BITS), F.floor(scaled)).otherwise(
            F.raise_error(F.concat(F.lit("a component is too large to search: "), x.cast("string"))).cast("bigint"))

    return vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select("vec_id", F.transform("embedding", whole).alias("v"))


@dataclass
class File:
    """An approximation file: ``cells`` (dims, shard, row, vec_id, cells), ``exact`` (row, vec_id, v) and the grid of each length."""

    cells: DataFrame
    exact: DataFrame
    grids: dict[int, tuple[np.ndarray, np.ndarray]]
    stage: Stage


def _coded(grids: dict[int, tuple[np.ndarray, np.ndarray]]):
    def coded(vectors: pa.Array) -> pa.Array:
        out = []
        for v in vectors:
            x = v.values.to_numpy()
            low, step = grids.get(len(x), (x, x))
            out.append(((x - low) // step).astype(np.uint8).tobytes() if len(x) else b"")
        return pa.array(out, pa.binary())

    return F.arrow_udf(coded, "binary")


def approximate(vectors: DataFrame, stage: Stage) -> File:
    """The approximation file of (vec_id, v). Vectors of different length never meet."""
    # Rows are numbered when they are written; whatever reads them again finds the same numbers.
    exact = stage("exact", vectors.withColumn("row", F.monotonically_increasing_id()))
    sized = exact.withColumn("dims", F.size("v"))
    ends = sized.select("dims", F.posexplode("v")).groupBy("dims", "pos").agg(F.min("col").alias("a"), F.max("col").alias("b"))
    found = ends.orderBy("dims", "pos").limit(GRID_ROWS + 1).collect()
    if len(found) > GRID_ROWS:
        raise ValueError(f"more than {GRID_ROWS} dimensions over all vector lengths")
    columns: dict[int, list[tuple[int, int]]] = {}
    for r in found:
        columns.setdefault(r.dims, []).append((r.a, (r.b - r.a) // CELLS + 1))
    grids = {d: tuple(np.array(c, np.int64) for c in zip(*g)) for d, g in columns.items()}
    counts = sized.groupBy("dims").agg(F.ceil(F.count("*") / SHARD).cast("bigint").alias("shards"))
    cells = stage("cells", sized.join(counts, "dims").select(
        "dims", F.pmod(F.xxhash64("row"), F.col("shards")).alias("shard"), "row", "vec_id", _coded(grids)("v").alias("cells")))
    return File(cells, exact, grids, stage)


def _matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    parts = [c.flatten().to_numpy() for c in column.chunks]
    return (np.concatenate(parts) if parts else np.empty(0, np.int64)).reshape(n, -1)


def _scanned(k: int, grids: dict[int, tuple[np.ndarray, np.ndarray]]):
    def scan(key: tuple, rows: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list[np.ndarray]] = {"query_id": [], "row": [], "best": [], "worst": []}
        n = rows.num_rows
        if n and queries.num_rows:
            ids, row = rows.column("vec_id").to_numpy(), rows.column("row").to_numpy()
            cells = np.frombuffer(b"".join(rows.column("cells").to_pylist()), np.uint8).reshape(n, -1).astype(float)
            low, step = grids.get(cells.shape[1], (np.empty(0), np.empty(0)))
            near = low + cells * step
            far = near + (step - 1)
            del cells
            widest = np.maximum(np.abs(near), np.abs(far)).max(axis=0)
            asked, query_ids = _matrix(queries.column("asked_v"), queries.num_rows).astype(float), queries.column("asked_vec_id").to_numpy()
            for at in range(0, len(asked), STEP):
                q, own = asked[at:at + STEP], query_ids[at:at + STEP]
                up, down = np.maximum(q, 0), np.minimum(q, 0)
                slack = 1e-12 * (np.abs(q) @ widest)[:, None]
                best, worst = up @ far.T + down @ near.T + slack, up @ near.T + down @ far.T - slack
                best[own[:, None] == ids] = worst[own[:, None] == ids] = -np.inf
                kth = np.partition(worst, n - k, axis=1)[:, n - k] if n > k else np.full(len(q), -np.inf)
                a, b = np.nonzero((best >= kth[:, None]) & (best > -np.inf))
                for name, values in (("query_id", own[a]), ("row", row[b]), ("best", best[a, b]), ("worst", worst[a, b])):
                    out[name].append(values)
        kinds = {"query_id": np.int64, "row": np.int64, "best": float, "worst": float}
        return pa.table({c: np.concatenate(v) if v else np.empty(0, kinds[c]) for c, v in out.items()})

    return scan


@F.arrow_udf(T.LongType())
def _score(vectors: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for batch in vectors:
        scores = []
        for v, q in zip(*batch):
            x, y = v.values.to_numpy(), q.values.to_numpy()
            if len(x) * int(np.abs(x).max(initial=0)) * int(np.abs(y).max(initial=0)) >= 1 << 63:
                raise OverflowError("a score may not fit 64 bits")
            scores.append(int(x @ y))
        yield pa.array(scores, pa.int64())


def top_k(file: File, queries: DataFrame, k: int = 10) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query (vec_id, v) its k best rows of the file but itself.

    Scores are exact integers, and one that might not fit 64 bits fails the job; ties go to the
    smaller vec_id; a query with fewer candidates gets all. Only vectors of the query's own length
    are candidates. Repeated candidates count each, a candidate with the query's id never; a
    repeated query is answered once. An empty file or no queries give an empty result.
    """
    asked = file.stage("asked", queries.dropDuplicates(["vec_id"]).withColumn("dims", F.size("v")))
    chunks = max(1, -(-asked.count() // QUERIES))
    chunked = asked.withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)))
    shards = file.cells.select("dims", "shard").distinct()
    dealt = chunked.join(shards, "dims").select(*[F.col(c).alias(f"asked_{c}") for c in ("dims", "shard", "chunk", "vec_id", "v")])
    rows = file.cells.join(chunked.select("dims", "chunk").distinct(), "dims").select("dims", "shard", "chunk", "row", "vec_id", "cells")
    found = file.stage("bounds", rows.groupBy("dims", "shard", "chunk").cogroup(dealt.groupBy("asked_dims", "asked_shard", "asked_chunk"))
                       .applyInArrow(_scanned(k, file.grids), "query_id bigint, row bigint, best double, worst double"))
    by = Window.partitionBy("query_id")
    least = found.withColumn("place", F.row_number().over(by.orderBy(F.desc("worst")))).where(F.col("place") <= k) \
        .groupBy("query_id").agg(F.min("worst").alias("least"), F.count("*").alias("n"))
    possible = found.join(least, "query_id").where((F.col("n") < k) | (F.col("best") >= F.col("least"))) \
        .select("query_id", "row", "best", F.row_number().over(by.orderBy(F.desc("best"), "row")).alias("place"))
    possible = file.stage("possible", possible)

    def read(candidates: DataFrame) -> DataFrame:
        wanted = asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("asked_v"))
        return candidates.select("query_id", "row").join(file.exact, "row").join(wanted, "query_id") \
            .select("query_id", "vec_id", _score("v", "asked_v").alias("score"))

    first = file.stage("first", read(possible.where(F.col("place") <= k)))
    certain = first.groupBy("query_id").agg(F.min("score").alias("kth"))
    more = read(possible.where(F.col("place") > k).join(certain, "query_id").where(F.col("best") >= F.col("kth")))
    ranked = first.union(more).withColumn("rank", F.row_number().over(by.orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

"""Embedding near-duplicates by spherical-cap filters.

Filter directions are a structured random product code: the rotated space is cut into ``BLOCKS``
blocks, each with ``side`` random unit vectors, and every choice of one vector per block is a
direction. A vector is list-decoded to all directions whose inner product exceeds the cap's
height: block by block, prefixes that cannot reach the height any more are dropped, so the
side^BLOCKS directions are never enumerated. Vectors join on (label, direction) and their
cosines are computed exactly. The number of directions follows the size of the table, so that a
cap holds about ``PER_CAP`` vectors at every size.

Equal vectors are one vector with a count. A pair that shares several caps counts in the first
of them only, so link counts are exact for all pairs found and no pair is ever emitted: a cap
returns link counts and a spanning forest of its links. A cap of more than ``CHUNK`` vectors is
compared chunk against chunk in separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.components import connected_components
from forecourt.llm.stages import Stage

COSINE, BLOCKS, LISTED, LEAST, PER_CAP, CHUNK, SEED = 0.98, 4, 24, 16, 64, 2048, 11


class Caps:
    """A product code for one vector length and a decoder of the caps that hold a vector."""

    def __init__(self, dims: int, side: int, listed: int = LISTED, least: int = LEAST):
        rng = np.random.default_rng([SEED, dims, side])
        self.dims, self.side = dims, side
        self.turn = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
        self.blocks = [b for b in np.array_split(np.arange(dims), BLOCKS) if len(b)]
        self.codes = []
        for block in self.blocks:
            code = rng.normal(size=(side, len(block)))
            self.codes.append(code / np.linalg.norm(code, axis=1, keepdims=True) / np.sqrt(len(self.blocks)))
        directions = side ** len(self.blocks)
        self.least = min(least, directions)
        self.step = dims ** -0.5
        share = min(0.5, listed / directions)
        self.height = self.step * NormalDist().inv_cdf(1 - share)

    def decode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, direction) of every cap that holds a unit vector, at least ``least`` caps each, by row and direction."""
        turned = units @ self.turn
        gains = [turned[:, b] @ c.T for b, c in zip(self.blocks, self.codes)]
        rest = np.zeros((len(gains) + 1, len(units)))
        for i in range(len(gains) - 1, -1, -1):
            rest[i] = rest[i + 1] + gains[i].max(axis=1)
        found_rows, found = [], []
        open_, height = np.arange(len(units)), self.height
        while len(open_):
            row, code, score = open_, np.zeros(len(open_), np.int64), np.zeros(len(open_))
            for i, gain in enumerate(gains):
                total = score[:, None] + gain[row]
                a, b = np.nonzero(total + rest[i + 1][row][:, None] >= height)
                row, code, score = row[a], code[a] * self.side + b, total[a, b]
            enough = np.bincount(row, minlength=len(units)) >= self.least
            keep = enough[row]
            found_rows.append(row[keep])
            found.append(code[keep])
            open_ = open_[~enough[open_]]
            height -= self.step / 4
        rows, codes = np.concatenate(found_rows or [open_]), np.concatenate(found or [open_])
        order = np.lexsort((codes, rows))
        return rows[order], codes[order]


def side_of(vectors: int) -> int:
    """Code vectors per block for about ``PER_CAP`` vectors in a cap."""
    return max(2, round((max(1, vectors) * LISTED / PER_CAP) ** (1 / BLOCKS)))


def _usable(vectors: DataFrame) -> DataFrame:
    """Rows that can link: id and label known, a vector that is not zero and has finite components only."""
    embedding = F.col("embedding")
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vectors.where("vec_id is not null and label is not null") \
        .where(F.coalesce(~bad & F.exists(embedding, lambda x: x != 0), F.lit(False)))


def _units(column: pa.Array, dims: int) -> np.ndarray:
    x = column.flatten().to_numpy().astype(float).reshape(-1, dims)
    return x / np.linalg.norm(x / np.abs(x).max(axis=1, keepdims=True), axis=1, keepdims=True) / np.abs(x).max(axis=1, keepdims=True)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    made: dict[tuple[int, int], Caps] = {}
    for batch in batches:
        dims, side = batch.column("dims").to_numpy(), batch.column("side").to_numpy()
        for d, s in {*zip(dims.tolist(), side.tolist())}:
            part = batch.filter(pa.array((dims == d) & (side == s)))
            caps = made.setdefault((d, s), Caps(d, s))
            rows, codes = caps.decode(_units(part.column("embedding"), d))
            ends = np.cumsum(np.bincount(rows, minlength=part.num_rows))
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(codes))
            yield part.select(["label", "dims", "id", "place", "n", "embedding"]).append_column("caps", lists)


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """A spanning forest of the links a[i] < b[i] among n members; a is ascending."""
    kin, out = np.arange(n), []
    starts = np.flatnonzero(np.concatenate(([True], a[1:] != a[:-1]))) if len(a) else []
    for s, e in zip(starts, [*starts[1:], len(a)]):
        i, near = a[s], b[s:e]
        near = near[kin[near] != kin[i]]
        if len(near):
            met, first = np.unique(kin[near], return_index=True)
            out += [(int(i), int(j)) for j in near[first]]
            kin[np.isin(kin, met)] = kin[i]
    return out


def _compared(cosine: float):
    def compared(key: tuple, rows: pa.Table) -> pa.Table:
        dims, cap, one, two = (k.as_py() for k in key[1:])
        rows = rows.combine_chunks()
        found: dict[str, list] = {"id": [], "place": [], "links": [], "other": []}
        if rows.num_rows > 1:
            ids, places, weight, chunk = (rows.column(c).to_numpy() for c in ("id", "place", "n", "chunk"))
            units = _units(rows.column("embedding").chunk(0), dims)
            near = np.triu(units @ units.T >= cosine, 1)
            if one != two:
                near &= chunk[:, None] != chunk[None, :]
            if near.any():
                lists = rows.column("caps").chunk(0)
                flat, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(ids)), np.diff(lists.offsets.to_numpy()))
                flat, row = flat[earlier := flat < cap], row[earlier]
                codes, place = np.unique(flat, return_inverse=True)
                holds = np.zeros((len(ids), len(codes)), np.float32)
                holds[row, place] = 1
                near &= holds @ holds.T == 0  # pairs with an earlier cap in common count there
                a, b = np.nonzero(near)
                links = np.bincount(a, weight[b], len(ids)) + np.bincount(b, weight[a], len(ids))
                some = np.flatnonzero(links)
                edges = _forest(a, b, len(ids))
                found = {"id": [*ids[some].tolist(), *(int(ids[i]) for i, _ in edges)],
                         "place": [*places[some].tolist(), *[None] * len(edges)],
                         "links": [*links[some].astype(np.int64).tolist(), *[0] * len(edges)],
                         "other": [*[None] * len(some), *(int(ids[j]) for _, j in edges)]}
        return pa.table(found, pa.schema([("id", pa.int64()), ("place", pa.int64()), ("links", pa.int64()), ("other", pa.int64())]))

    return compared


def near_duplicates(vectors: DataFrame, stage: Stage, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), one row per row of ``vectors`` (vec_id, embedding, label).

    Rows link within a label when the cosine in double precision is at least ``cosine``. A null
    label, id or vector, a zero vector and one with a null or non-finite component link with
    nothing: no links, a component of their own, kept (component_id null where vec_id is).
    Vectors of different length do not link. Equal vectors link with each other and have equal
    links; rows that repeat a vec_id count as rows each, and
    different vectors under one vec_id share its component. Other columns are ignored; an empty
    table gives an empty result.
    """
    usable = _usable(vectors).select("vec_id", "label", "embedding")
    distinct = usable.groupBy("label", "embedding").agg(F.min("vec_id").alias("id"), F.count("*").alias("n")) \
        .withColumns({"dims": F.size("embedding"), "place": F.xxhash64("label", "embedding")})
    distinct = stage("distinct", distinct)
    sides = distinct.groupBy("label", "dims").agg(F.greatest(F.lit(2), F.round(
        F.pow(F.count("*") * (LISTED / PER_CAP), 1 / BLOCKS))).cast("int").alias("side"))
    kind = dict(distinct.dtypes)
    listed = stage("caps", distinct.join(sides, ["label", "dims"]).select("label", "dims", "side", "id", "place", "n", "embedding").mapInArrow(
        _listed, f"label {kind['label']}, dims int, id bigint, place bigint, n bigint, embedding {kind['embedding']}, caps array<bigint>"))
    held = listed.withColumn("cap", F.explode("caps"))
    cap = ["label", "dims", "cap"]
    full = stage("full", listed.select("label", "dims", F.explode("caps").alias("cap")).groupBy(cap)
                 .agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks")).where("chunks > 1"))
    dealt = held.join(full, cap, "left").withColumn("chunks", F.coalesce("chunks", F.lit(1))) \
        .withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")) \
        .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
        .withColumns({"one": F.least("chunk", "with"), "two": F.greatest("chunk", "with")})
    links = stage("links", dealt.groupBy(*cap, "one", "two").applyInArrow(
        _compared(cosine), "id bigint, place bigint, links bigint, other bigint"))
    joined = connected_components(links.where("other is not null").select(F.col("id").alias("a"), F.col("other").alias("b")), stage)
    counts = links.where("place is not null").groupBy("id", "place").agg(F.sum("links").alias("links"))
    classes = distinct.join(counts, ["id", "place"], "left").join(joined, distinct.id == joined.node, "left").select(
        F.col("label").alias("of"), F.col("embedding").alias("at"),
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("found"), F.coalesce("component", "id").alias("class"))
    named = vectors.select("vec_id", "label", "embedding") \
        .join(classes, (F.col("label") == F.col("of")) & (F.col("embedding") == F.col("at")) & F.col("vec_id").isNotNull(), "left")
    return named.select("vec_id", F.coalesce("found", F.lit(0)).cast("bigint").alias("n_links"),
                        F.coalesce("class", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))

"""SimHash near-duplicates by covering locality-sensitive hashing.

A fingerprint bit is set where more than half of a document's shingle hashes have it. Documents
link when their fingerprints differ in at most ``RADIUS`` bits. Candidates come from a covering
family of bit masks: every bit gets a non-zero vector of r + 1 bits, and every non-zero v of
r + 1 bits is a mask that keeps the bits whose vector has an odd product with v. The vectors of
any r bits leave some v orthogonal to all of them, so any two fingerprints within the radius
agree under that mask: no pair is missed, whatever the data.

Equal fingerprints are reduced to one first. Buckets of up to ``BUCKET`` distinct fingerprints
are compared inside one task, which returns a spanning forest of their links, not all pairs.
A fuller bucket is not cut: the same construction is applied again to the bits that its mask
leaves open, so its members spread over buckets that agree in half as many open bits. As a
bucket with c open bits holds at most 2^c fingerprints, this ends after a few rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forecourt.llm.components import connected_components, thinned
from forecourt.llm.stages import Stage, raw_bytes, released

BITS, RADIUS, BUCKET, SEED = 64, 3, 2048, 42
FORWARD = T.ArrayType(T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))


def shingle_hashes(words: list[bytes], shingle: int) -> Iterator[np.ndarray]:
    """64-bit hashes of the shingles of a text, repeats included, some at a time; of fewer words the whole sequence."""
    if not words:
        return
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= shingle:
        starts, ends = starts[:len(words) - shingle + 1], ends[shingle - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    for at in range(0, len(starts), 1 << 16):
        yield np.array([digest(view[a:b], SEED) for a, b in
                        zip(starts[at:at + (1 << 16)].tolist(), ends[at:at + (1 << 16)].tolist())], dtype="<u8")


def _words(raw: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return raw.lower().split()


def _majority(hashes: Iterator[np.ndarray], width: int) -> np.ndarray:
    """Of rows of ``width`` 64-bit words, the bits that more than half have set."""
    count, n = np.zeros(BITS * width, dtype=np.int64), 0
    for part in hashes:
        count += np.unpackbits(part.view(np.uint8).reshape(-1, 8 * width), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(part) // width
    return np.packbits(2 * count > n, bitorder="little").view("<u8")


def fingerprint_of(raw: bytes, shingle: int) -> int:
    """Unsigned fingerprint of one text."""
    return int(_majority(shingle_hashes(_words(raw), shingle), 1)[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """The 64 bits as a signed ``bigint``. Null or blank text has fingerprint zero."""

    @F.arrow_udf(T.LongType())
    def fingerprints(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in released(texts):
            out = np.fromiter((fingerprint_of(raw_bytes(t), shingle) for t in batch), dtype=np.uint64, count=len(batch))
            yield pa.array(out.view(np.int64))

    return fingerprints(text)


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Masks over the given bit positions; any ``radius`` positions are left out by at least one."""
    vectors = {bit: 1 + i % ((2 << radius) - 1) for i, bit in enumerate(bits)}
    return sorted({sum(1 << b for b, m in vectors.items() if (m & v).bit_count() % 2) for v in range(1, 2 << radius)})


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def _finer(spark: SparkSession, masks: list[int], radius: int) -> DataFrame:
    """(mask, finer): each mask with those that also cover its open bits; some per mask, so a small table."""
    rows = [(_signed(m), _signed(m | sub)) for m in masks
            for sub in covering_masks([b for b in range(BITS) if not m >> b & 1], radius)]
    return spark.createDataFrame(sorted(set(rows)), "mask bigint, finer bigint")


def _forest(radius: int):
    def forest(groups: Iterator[pa.Array]) -> Iterator[pa.Array]:
        """A spanning forest of the links among the members of each bucket."""
        for batch in released(groups):
            found = []
            for group in batch.to_pylist():
                marks = np.array([m["fp"] for m in group], dtype=np.int64)
                kin, links = np.arange(len(marks)), []
                for i in range(len(marks) - 1):
                    near = i + 1 + np.flatnonzero(np.bitwise_count((marks[i + 1:] ^ marks[i]).view(np.uint64)) <= radius)
                    near = near[kin[near] != kin[i]]
                    if len(near):
                        met, first = np.unique(kin[near], return_index=True)
                        links += [{"a": group[i]["id"], "b": group[j]["id"]} for j in near[first].tolist()]
                        kin[np.isin(kin, met)] = kin[i]
                found.append(links)
            yield pa.array(found, pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())])))

    return F.arrow_udf(forest, FORWARD)


def links(marks: DataFrame, stage: Stage, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) that connect the distinct fingerprints (id, fp) exactly as all links within the radius do."""
    spark = marks.sparkSession
    whole, masks, found = marks, [0], []
    while masks:
        if masks == [0]:
            first = F.array(*[F.lit(_signed(m)) for m in covering_masks(list(range(BITS)), radius)])
            keyed = whole.select("id", "fp", F.explode(first).alias("mask"))
        else:
            keyed = whole.join(F.broadcast(_finer(spark, masks, radius)), "mask").select("id", "fp", F.col("finer").alias("mask"))
        keyed = keyed.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        bucket = ["mask", "key"]
        sizes = keyed.groupBy(bucket).agg(F.count("*").alias("n")).where("n > 1")
        members = stage("buckets", keyed.join(sizes, bucket))
        found.append(stage("links", members.where(F.col("n") <= BUCKET).groupBy(bucket)
                           .agg(F.sort_array(F.collect_list(F.struct("fp", "id"))).alias("group"))
                           .select(F.explode(_forest(radius)("group")).alias("e")).select("e.a", "e.b").distinct()))
        whole = members.where(F.col("n") > BUCKET).select("id", "fp", "mask").distinct()
        masks = [r.mask & ((1 << BITS) - 1) for r in whole.select("mask").distinct().collect()]
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def near_duplicates(documents: DataFrame, stage: Stage, shingle: int = 3) -> DataFrame:
    """(doc_id, fp, component_id), one row per row of ``documents`` (doc_id, text).

    Whole texts are read. Blank and null texts share fingerprint zero and link like any other;
    rows repeated under one doc_id are fingerprinted each and belong to the component of their
    own fingerprint. A row without doc_id links nothing and has a null component. Other columns
    are ignored; an empty table gives an empty result.
    """
    marks = stage("fingerprints", documents.select("doc_id", fingerprint("text", shingle).alias("fp")))
    distinct = stage("distinct", marks.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("id"))
                     .select("id", "fp"))
    # One doc_id can stand for several fingerprints only where ids repeat; those fingerprints then share a node.
    joined = connected_components(links(distinct, stage), stage)
    classes = distinct.join(joined, distinct.id == joined.node, "left") \
        .select("fp", F.coalesce("component", "id").alias("component_id"))
    named = marks.join(classes, "fp", "left")
    return named.select("doc_id", "fp", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


# -- similarity of shingle sets ----------------------------------------------------------------------

PRINTS, TABLES, SAMPLED = 8, 192, 32
#: Of the bits of a text's shingles. At a cosine of 0.8 about 105 of 512 differ, with a deviation of 9.
APART = 154
BROADCAST_IDS = 1_000_000  # 8 bytes each
BLOCK, TEXTS, COLUMNS = 1 << 18, 1024, 1 << 21


def _spread(hashes: np.ndarray) -> np.ndarray:
    """``PRINTS`` independent 64-bit words for each hash, one hash after another."""
    x = hashes[:, None] + np.arange(1, PRINTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return (x ^ x >> np.uint64(31)).ravel()


def _wide(hashes: np.ndarray) -> np.ndarray:
    """The fingerprint of ``PRINTS`` times 64 bits of a set of hashes; of none, zero."""
    if not len(hashes):
        return np.zeros(PRINTS, np.int64)
    return _majority((_spread(hashes[at:at + 4096]) for at in range(0, len(hashes), 4096)), PRINTS).view(np.int64)


def _lists(rows: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]).astype(np.int32)), pa.array(flat))


def _marks(shingle: int):
    """The digest of a text's set of shingles, and the wide fingerprints of its set of words and of its set of shingles."""

    def marked(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in released(texts):
            of, prints, order = [], [], []
            for text in batch:
                words = _words(raw_bytes(text))
                shingles = np.unique(np.concatenate([np.empty(0, "<u8"), *map(np.unique, shingle_hashes(words, shingle))]))
                of.append(xxhash.xxh3_128_digest(shingles.tobytes()))
                once = set(words)
                prints.append(_wide(np.fromiter((xxhash.xxh3_64_intdigest(w, SEED) for w in once), np.uint64, len(once))))
                order.append(_wide(shingles))
            yield pa.StructArray.from_arrays([pa.array(of, pa.binary()), _lists(prints), _lists(order)], ["of", "prints", "order"])

    return F.arrow_udf(marked, "struct<of:binary,prints:array<bigint>,order:array<bigint>>")


def _shingle_set(shingle: int):
    def sets(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in released(texts):
            yield _lists([np.unique(np.concatenate([np.empty(0, "<u8"), *shingle_hashes(_words(raw_bytes(t)), shingle)])).view(np.int64) for t in batch])

    return F.arrow_udf(sets, "array<bigint>")


def _places(each: int, seed: int) -> np.ndarray:
    """The bits that each table reads, drawn once for all: (TABLES, each) places in a wide fingerprint."""
    rng = np.random.default_rng(seed)
    return np.array([rng.choice(BITS * PRINTS, each, replace=False) for _ in range(TABLES)])


def _bits(marks: np.ndarray) -> np.ndarray:
    return np.unpackbits(marks.view(np.uint8).reshape(-1, 8 * PRINTS), axis=1, bitorder="little")


def _keys():
    """Of a wide fingerprint, its bucket in each table: the number of the table and the bits themselves."""
    places, table = _places(SAMPLED, SEED).ravel(), np.arange(TABLES, dtype=np.int64) << SAMPLED

    def keyed(prints: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in released(prints):
            marks, out = batch.flatten().to_numpy().reshape(-1, PRINTS), [np.empty(0, np.int64)]
            for at in range(0, len(marks), 1024):
                read = np.packbits(_bits(marks[at:at + 1024])[:, places].reshape(-1, SAMPLED), axis=1).view("<u4")
                out.append((table + read.reshape(-1, TABLES)).ravel())
            yield pa.ListArray.from_arrays(pa.array(np.arange(len(batch) + 1, dtype=np.int32) * TABLES), pa.array(np.concatenate(out)))

    return F.arrow_udf(keyed, "array<bigint>")


def nearest_forest(marks: np.ndarray, apart: int) -> list[tuple[int, int]]:
    """A minimum spanning forest of fingerprints (rows) at most ``apart`` bits apart, as pairs of places.

    For every smaller limit, too, it connects what all pairs within that limit connect.
    """
    left, near = np.arange(1, len(marks)), np.zeros(len(marks), np.int64)
    far, found, now = np.full(len(marks), marks.shape[1] * BITS + 1), [], 0
    while len(left):
        new = np.bitwise_count(marks[left] ^ marks[now]).sum(axis=1)
        closer = new < far[left]
        far[left[closer]], near[left[closer]] = new[closer], now
        at = int(np.argmin(far[left]))
        now, left = int(left[at]), np.delete(left, at)
        if far[now] <= apart:
            found.append((int(near[now]), now))
    return found


def _blocks(start: int, end: int) -> Iterator[tuple[int, int]]:
    """Of the members of a bucket, BUCKET at a time; of more, each meets half a block before and behind it."""
    for at in range(start, max(start + 1, end - BUCKET // 2), BUCKET // 2):
        yield at, min(at + BUCKET, end)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of the nearest forest of each bucket, of rows (key, id, order) sorted by key; a bucket may span batches."""

    def edges(key: np.ndarray, ids: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
        cuts = np.concatenate(([0], np.flatnonzero(np.diff(key)) + 1, [len(key)])).tolist()
        pairs = [(ids[at + i], ids[at + j]) for bucket in zip(cuts[:-1], cuts[1:]) for at, end in _blocks(*bucket)
                 for i, j in nearest_forest(marks[at:end], APART)]
        found = np.unique(np.sort(np.array(pairs, np.int64).reshape(-1, 2), axis=1), axis=0)
        return pa.record_batch([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    held = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, PRINTS), np.uint64)]
    for batch in released(batches):
        came = [batch.column("key").to_numpy(), batch.column("id").to_numpy(),
                batch.column("order").flatten().to_numpy().view(np.uint64).reshape(-1, PRINTS)]
        held = [np.concatenate(both) for both in zip(held, came)]
        last = int(np.searchsorted(held[0], held[0][-1])) if len(held[0]) else 0
        # Of the last bucket so far, its full blocks go on, and what the next block shares with them stays.
        full = [at for at, end in _blocks(last, len(held[0])) if end - at == BUCKET]
        done, keep = (full[-1] + BUCKET, full[-1] + BUCKET // 2) if full else (last, last)
        if done:
            yield edges(*(h[:done] for h in held))
            held = [h[keep:] for h in held]
    if len(held[0]):
        yield edges(*held)


def _in_blocks(members: DataFrame) -> DataFrame:
    """(key, id) of buckets fuller than ``BUCKET``: dealt into blocks of half of it, each two blocks under a key of their own."""
    blocks = F.ceil(F.col("size") / F.lit(max(1, BUCKET // 2)))
    dealt = members.withColumn("block", F.pmod(F.row_number().over(Window.partitionBy("key").orderBy("id")).cast("bigint"), blocks))
    return dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), blocks - 1))) \
        .select(F.xxhash64("key", F.least("block", "other"), F.greatest("block", "other")).alias("key"), "id")


def _candidates(distinct: DataFrame, stage: Stage) -> DataFrame:
    """Edges (a, b) between texts (id, prints, order) that share a bucket of some table.

    One shuffle brings the rows (key, id) of all tables together, and only buckets of two and
    more are kept. Their members are connected by a minimum spanning forest over the
    fingerprints of their shingles, so the edges of a large group stay in proportion to its
    texts. It connects all that differ in at most ``APART`` bits; of a bucket of more than
    ``BUCKET`` texts, every two blocks are connected in a group of their own.
    """
    parts, bucket = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), Window.partitionBy("key")
    keyed = distinct.select("id", "prints").repartition(parts, "id").select("id", F.explode(_keys()("prints")).alias("key"))
    met = keyed.repartition(parts, "key").withColumns({"more": F.min("id").over(bucket) < F.max("id").over(bucket), "size": F.count("*").over(bucket)})
    members = stage("members", met.where("more").select("key", "id", "size").distinct())
    rows = members.where(F.col("size") <= BUCKET).select("key", "id").unionByName(_in_blocks(members.where(F.col("size") > BUCKET)))
    own = rows.join(distinct.select("id", "order"), "id").select("key", "id", "order")
    edges = own.repartition(parts, "key").sortWithinPartitions("key", "id").mapInArrow(_forests, "a bigint, b bigint")
    return stage("candidates", edges.where("a < b").distinct())


def _links(similarity: float):
    def linked(group: pa.Table) -> pa.Table:
        """Of rows (group, one, two, block, id, s): a spanning forest of the pairs alike between blocks ``one`` and ``two``, or within one."""
        one, two, block, ids = (group.column(c).to_numpy() for c in ("one", "two", "block", "id"))
        lists = group.column("s").combine_chunks()
        size, flat = pc.list_value_length(lists).to_numpy(), lists.flatten().to_numpy()
        left, right = np.flatnonzero(block == one[0]), np.flatnonzero(block == two[0])
        value, column, times = np.unique(flat, return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(ids)), size)
        # Only shingles of two texts count; a column for each, some at a time.
        shared = np.cumsum(times > 1) - 1
        seen = times[column] > 1
        owner, column = owner[seen], shared[column[seen]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        common, step = np.zeros((len(left), len(right)), np.float32), max(1, COLUMNS // len(ids))
        for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
            here = slice(*np.searchsorted(column, [at, at + step]))
            x = np.zeros((len(ids), step), np.float32)
            x[owner[here], column[here] - at] = 1
            common += x[left] @ x[right].T
        alike = (common > 0) & (common >= similarity * np.sqrt(size[left, None].astype(float) * size[right]))
        kin, found = np.arange(len(ids)), []
        for i, row in zip(left.tolist(), alike):
            near = right[row]
            near = near[kin[near] != kin[i]]
            if len(near):
                met, first = np.unique(kin[near], return_index=True)
                found += [(ids[i], ids[j]) for j in near[first].tolist() if ids[i] != ids[j]]
                kin[np.isin(kin, met)] = kin[i]
        pairs = np.sort(np.array(found, np.int64).reshape(-1, 2), axis=1)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return linked


def _alike(sets: DataFrame, groups: DataFrame, stage: Stage, similarity: float) -> DataFrame:
    """Edges (a, b) that connect the texts (id, s) of each group (node, component) as all pairs with that cosine do.

    Every text of a group is compared with every other one on the shingle sets. A large group is
    dealt into blocks by id, and each two blocks meet in a task of their own: a task holds about
    two times ``BLOCK`` shingles and twice ``TEXTS`` texts, however large the group is.
    """
    held = sets.join(groups.toDF("id", "group"), "id")
    sizes = held.groupBy("group").agg(F.ceil(F.greatest(F.sum(F.size("s")) / BLOCK, F.count("*") / TEXTS, F.lit(1))).cast("bigint").alias("blocks"))
    dealt = held.join(sizes, "group").withColumn("block", F.pmod(F.xxhash64("id"), "blocks")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))) \
        .select("group", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "id", "s")
    return stage("similar", dealt.groupBy("group", "one", "two").applyInArrow(_links(similarity), "a bigint, b bigint").distinct())


def near_copies(documents: DataFrame, stage: Stage, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, component_id), one row per row of ``documents`` (doc_id, text): documents whose shingle sets are similar.

    Similar are texts whose sets of word shingles have a cosine of at least ``similarity``; equal
    sets are one. Candidates agree in all ``SAMPLED`` bits that one of ``TABLES`` tables reads of a
    SimHash fingerprint of their sets of words, which near copies change less than their shingles.
    Those of a bucket, however full, that differ in at most ``APART`` bits of SimHash fingerprints of
    their shingles form a group, and within a group every pair is checked on the shingle sets
    themselves. Two texts without a common word order are never joined; a pair is missed only if
    neither a table nor a chain of candidates brings it together.
    Blank and null texts have one set. A row without doc_id links nothing and has a null
    component. Other columns are ignored; an empty table gives an empty result.
    """
    marks = stage("marks", documents.select("doc_id", _marks(shingle)("text").alias("m")).select("doc_id", "m.*"))
    distinct = stage("sets", marks.where("doc_id is not null").groupBy("of")
                     .agg(F.min("doc_id").alias("id"), F.first("prints").alias("prints"), F.first("order").alias("order")))
    groups = stage("groups", connected_components(thinned(_candidates(distinct, stage)), stage))
    # Only the texts of candidates are read again; a short list of them goes to every executor.
    ends = groups.select(F.col("node").alias("doc_id"))
    ends = F.broadcast(ends) if groups.count() <= BROADCAST_IDS else ends
    sets = stage("shingles", documents.select("doc_id", "text").join(ends, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
                 .select(F.col("doc_id").alias("id"), _shingle_set(shingle)("text").alias("s")))
    joined = connected_components(thinned(_alike(sets, groups, stage, similarity)), stage)
    classes = distinct.join(joined, distinct.id == joined.node, "left").select("of", F.coalesce("component", "id").alias("component_id"))
    named = marks.join(classes, "of", "left")
    return named.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))

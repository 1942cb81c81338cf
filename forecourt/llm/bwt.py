"""Repeated byte strings by merging Burrows-Wheeler transforms of shards.

A byte goes when a string of ``LENGTH`` bytes over it also starts somewhere else. Only strings
whose anchor (see ``windows``) repeats can do so; their starts are cut into strips, runs of starts
with one anchor and the bytes behind them. Equal strips meet by their digest first: with two
places or more, every start in them repeats, and one of them goes on. What can repeat beyond that
are parts of different strips with one anchor, and only the bytes of those are sent.

They come in shards, the strips of some tasks each. The alphabet is ``SYMBOL`` bytes wide, so a
string of ``LENGTH`` bytes is a few symbols, and a strip is read as SYMBOL chains of symbols, one
per phase. A shard's transform is built once: its suffixes in order, and the symbol before each.
The shards are merged by iterative interleave refinement. The interleave only says which shard
the next suffix comes from; a round reads the transforms in step with it and deals its members
stably by the symbol before them, which orders it by one symbol more. No suffix is compared or
sorted again. Blocks of members that agree so far are carried along and give the common prefixes;
members that still share a block when LENGTH bytes are covered, or when no block splits any more,
are repeats of each other.

An anchor with more than ``CROWD`` bytes of different strips, such as a line inside ever different
texts, is no group: its strips are cut again by the anchors of longer grams, and meet again, first
by half a string, then by whole strings, of which equal ones have met by their digest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.stages import dealt_table, raw_bytes, released, sliced, written
from forecourt.llm.windows import CHUNK, bucket_count, document_key, flat, packed, rabin_karp, repeated_anchors, runs, sliding

LENGTH, GRAM, SYMBOL, BYTES_PER_BUCKET = 400, 64, 80, 8 << 20
CROWD, MERGED, SHARDS = 1 << 19, 1 << 19, 16


def byte_symbols(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)


def _second(symbols: np.ndarray) -> np.ndarray:
    """Other symbols for a second hash of the same bytes."""
    return symbols * symbols + np.uint64(0x51ED27) * symbols


# -- transforms and their merge --------------------------------------------------------------------

def stable_order(ids: np.ndarray) -> np.ndarray:
    """Stable order of small non-negative ids: counting sorts over 16 bits at a time."""
    order = np.argsort((ids & 0xFFFF).astype(np.uint16), kind="stable")
    top = int(ids.max()) if len(ids) else 0
    for shift in range(16, top.bit_length(), 16):
        order = order[np.argsort((ids[order] >> shift & 0xFFFF).astype(np.uint16), kind="stable")]
    return order


def _concat(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate(parts).astype(np.int32) if parts else np.empty(0, np.int32)


class Transform:
    """The suffixes of the symbol chains of some strips, in the order of their first ``rounds`` symbols.

    ``place`` is where each starts in the joined strips (a strip has one place more than bytes),
    ``symbol`` the id of the symbol before it, -1 at the head of a chain. The first ``ends``
    suffixes are the empty ones.
    """

    def __init__(self, ids: list[np.ndarray], width: int, rounds: int):
        symbol, before, ends, base = [], [], [], 0
        for chain in ids:  # chain[p] is the symbol that starts at byte p of a strip; len(chain) = bytes - width + 1
            n = len(chain) + width  # suffixes at every byte and behind the last, those of fewer than width bytes empty
            own = np.arange(n)
            symbol.append(np.concatenate((np.full(width, -1), chain)))
            before.append(np.where(own >= width, own - width + base, -1))
            ends.append(base + np.arange(n - width, n))
            base += n
        symbol, before, ends = _concat(symbol), _concat(before), _concat(ends)
        order = self.order(symbol, before, ends, rounds)
        self.place, self.symbol, self.ends = order, symbol[order], len(ends)

    @staticmethod
    def order(symbol: np.ndarray, before: np.ndarray, ends: np.ndarray, rounds: int) -> np.ndarray:
        """The suffixes sorted by their first symbols, least significant first."""
        order = np.arange(len(symbol), dtype=np.int32)
        for _ in range(rounds):
            lead = symbol[order]
            some = np.flatnonzero(lead >= 0)
            order = np.concatenate((ends, before[order[some[stable_order(lead[some])]]]))
        return order


def merge(shards: list[Transform], rounds: int) -> np.ndarray:
    """For the suffixes of the shards, shard after shard in the order of each, the block that they share with their equals."""
    sizes, ends = [len(s.symbol) for s in shards], [s.ends for s in shards]
    symbols, which = np.concatenate([s.symbol for s in shards]), np.arange(len(shards), dtype=np.int16)
    interleave, empty = np.repeat(which, sizes), np.repeat(which, ends)
    block, blocks = np.zeros(len(symbols), np.int32), 1
    for _ in range(rounds):
        lead = np.empty(len(symbols), np.int32)
        lead[np.argsort(interleave, kind="stable")] = symbols  # each shard's symbols are read in turn
        some = np.flatnonzero(lead >= 0)
        dealt = some[stable_order(lead[some])]
        opened = runs(lead[dealt], block[dealt])
        interleave = np.concatenate((empty, interleave[dealt]))
        block = np.concatenate((np.zeros(len(empty), np.int32), np.cumsum(opened, dtype=np.int32)))
        if (now := int(block[-1]) + 1) == blocks:
            break  # no block splits any more
        blocks = now
    return block[np.argsort(interleave, kind="stable")]


def symbol_width(length: int) -> int:
    """The widest symbol of up to ``SYMBOL`` bytes that divides the length."""
    return max(w for w in range(1, min(SYMBOL, length) + 1) if length % w == 0)


def repeated_starts(shards: list[list[bytes]], length: int) -> list[list[np.ndarray]]:
    """For each strip of each shard: which starts of ``length`` bytes begin a string that starts elsewhere too."""
    width = symbol_width(length)
    rounds = length // width
    strips = [s for shard in shards for s in shard]
    sizes = np.array([len(s) for s in strips])
    symbols = [byte_symbols(s) for s in strips]
    first, second = (np.concatenate([rabin_karp(f(s), width) for s in symbols]) for f in (lambda s: s, _second))
    order = np.argsort(first)
    if np.any((first[order][1:] == first[order][:-1]) & (second[order][1:] != second[order][:-1])):
        order = np.lexsort((second, first))  # two symbols with one hash
    ids = np.empty(len(order), np.int32)
    ids[order] = np.cumsum(runs(first[order], second[order]), dtype=np.int32) - 1
    del first, second, order, symbols
    chains = np.split(ids, np.cumsum(sizes - width + 1)[:-1])
    built, taken, base, places = [], 0, 0, []
    for shard in shards:
        built.append(Transform(chains[taken:taken + len(shard)], width, rounds))
        places.append(built[-1].place + base)
        base += len(built[-1].place)
        taken += len(shard)
    block, place = merge(built, rounds), np.concatenate(places)
    starts = np.concatenate([np.concatenate((np.ones(n - length + 1, bool), np.zeros(length, bool))) for n in sizes.tolist()])
    is_start = starts[place]
    count = np.bincount(block[is_start], minlength=int(block.max()) + 1)
    again = np.zeros(len(starts), bool)
    again[place] = is_start & (count[block] > 1)
    marks = [a[:n - length + 1] for a, n in zip(np.split(again, np.cumsum(sizes + 1)[:-1]), sizes.tolist())]
    out, taken = [], 0
    for shard in shards:
        out.append(marks[taken:taken + len(shard)])
        taken += len(shard)
    return out


# -- strips and where they meet --------------------------------------------------------------------

Strips = tuple[np.ndarray, ...]  # anchor, start, size, inner, d1, d2


def strips_of(raw: bytes, anchors: np.ndarray | None, length: int, gram: int) -> Iterator[Strips]:
    """The runs of starts with one anchor, of given ones or all: anchor, start, bytes, whether it stands there twice, digest.

    Strings themselves (``gram`` = ``length``) are a strip each.
    """
    span = length - gram
    for at in range(0, max(0, len(raw) - length + 1), CHUNK):
        part = raw[at:at + CHUNK + length - 1]
        symbols = byte_symbols(part)
        grams = rabin_karp(symbols, gram)
        own = sliding(np.minimum, grams, span + 1)
        wanted = np.ones(len(own), bool) if anchors is None else np.isin(own, anchors)
        if gram == length:
            heads = np.flatnonzero(wanted)
            yield (own[heads], heads + at, np.full(len(heads), length), np.zeros(len(heads), bool), own[heads],
                   rabin_karp(_second(symbols), gram)[heads])
            continue
        heads = np.flatnonzero(wanted & runs(own))
        tails = np.flatnonzero(wanted & np.concatenate((own[1:] != own[:-1], [True]))) + 1
        if len(heads):
            pairs = list(zip(heads.tolist(), tails.tolist()))
            inner = [np.count_nonzero(grams[a:b + span] == own[a]) > 1 for a, b in pairs]
            digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(part[a:b + length - 1]) for a, b in pairs), np.uint64)
            yield own[heads], heads + at, tails - heads + length - 1, np.array(inner), digest[::2], digest[1::2]


COLUMNS = {"d1": np.uint64, "d2": np.uint64, "anchor": np.uint64, "doc": np.int64, "twin": np.int64, "start": np.int64,
           "size": np.int32, "inner": bool, "many": bool}
SENT = "bucket int, settled boolean, " + ", ".join(
    f"{c} array<{'int' if t is np.int32 else 'boolean' if t is bool else 'bigint'}>" for c, t in COLUMNS.items())
MET = "strip boolean, anchor bigint, doc bigint, twin bigint, start bigint, size int, inner boolean, many boolean"
SPANS = "doc bigint, twin bigint, first int, end int"


def _collapsed(strips: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """(one strip of each digest, the strips that are found to stand at several places now).

    ``many`` marks a strip that is known to: its own place is settled already.
    """
    keys = [strips[c] for c in ("start", "twin", "doc", "many", "d2", "d1")]
    order = np.lexsort(keys)
    order = order[runs(*(k[order] for k in reversed(keys)))]  # the same place twice is one
    ordered = {c: v[order] for c, v in strips.items()}
    head = runs(ordered["d1"], ordered["d2"])
    group = np.cumsum(head) - 1
    several = (np.bincount(group, minlength=1) > 1)[group]
    if len(group):
        several |= np.bincount(group, ordered["many"])[group] > 0
    one = {c: v[head] for c, v in ordered.items()}
    one["many"] = several[head]
    found = several & ~ordered["many"]
    return one, {c: v[found] for c, v in ordered.items()}


def _packed(strips: dict[str, np.ndarray], settled: bool, bucket: np.ndarray) -> pa.RecordBatch:
    made = packed(bucket.astype(np.int64), {c: v.view(np.int64) if v.dtype == np.uint64 else v for c, v in strips.items()})
    return pa.record_batch({"bucket": made.pop("bucket"), "settled": pa.array(np.full(len(next(iter(made.values()))), settled)), **made})


def _dealt(parts: list[dict[str, np.ndarray]], buckets: int) -> Iterator[pa.RecordBatch]:
    if parts:
        one, found = _collapsed({c: np.concatenate([p[c] for p in parts]).astype(t) for c, t in COLUMNS.items()})
        if len(one["d1"]):
            yield _packed(one, False, one["d1"] % np.uint64(buckets))
        if len(found["d1"]):
            yield _packed(found, True, (found["doc"] ^ found["twin"]) % buckets)


def _named(strips: Strips, doc: int, twin: int, start: int = 0, many: bool = False) -> dict[str, np.ndarray]:
    anchor, at, size, inner, d1, d2 = strips
    n = len(anchor)
    return {"d1": d1, "d2": d2, "anchor": anchor, "doc": np.full(n, doc, np.int64), "twin": np.full(n, twin, np.int64),
            "start": at + start, "size": size, "inner": inner, "many": np.full(n, many)}


HELD, HELD_BYTES = 1 << 18, 4 << 20


def _of_texts(gram: int, length: int, buckets: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(sliced(batches)):
            parts, held = [], 0
            texts = pa.compute.struct_field(batch.column("row"), "text")
            for doc, twin, text, anchors in zip(batch.column("doc").to_pylist(), batch.column("twin").to_pylist(), texts, batch.column("anchors")):
                for strips in strips_of(raw_bytes(text), anchors.values.to_numpy().view(np.uint64), length, gram):
                    parts.append(_named(strips, doc, twin))
                    held += len(strips[0])
                if held >= HELD:
                    yield from _dealt(parts, buckets)
                    parts, held = [], 0
            yield from _dealt(parts, buckets)

    return cut


def _of_strips(gram: int, length: int, buckets: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(sliced(batches)):
            parts, held = [], 0
            for strip, doc, twin, start, many in zip(*(batch.column(c).to_pylist() for c in ("strip", "doc", "twin", "start", "many"))):
                for strips in strips_of(strip, None, length, gram):
                    parts.append(_named(strips, doc, twin, start, many))
                    held += len(strips[0])
                if held >= HELD:
                    yield from _dealt(parts, buckets)
                    parts, held = [], 0
            yield from _dealt(parts, buckets)

    return cut


def _joined(doc: np.ndarray, twin: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping and touching spans of a document as one."""
    order = np.lexsort((first, twin, doc))
    doc, twin, first, end = doc[order], twin[order], first[order], end[order]
    other = runs(doc, twin)
    group = np.cumsum(other)
    far = int(end.max(initial=0)) + 1
    reach = np.maximum.accumulate(end + group * far) - group * far if len(end) else end  # of this document
    other[1:] |= first[1:] > reach[:-1]
    heads = np.flatnonzero(other)
    return doc[heads], twin[heads], first[heads], reach[np.append(heads[1:], len(doc))[:len(heads)] - 1]


def _met(last: bool):
    """Strips that met, one of each, and the spans of those that repeat. After the ``last`` level only spans go on."""

    def met(table: pa.Table) -> pa.Table:
        settled = table.column("settled")
        done, open_ = table.filter(settled), table.filter(pa.compute.invert(settled))
        one, found = _collapsed({c: flat(open_, c, np.int64).view(t) if t is np.uint64 else flat(open_, c, t) for c, t in COLUMNS.items()})
        doc, twin, start, size = (np.concatenate((found[c], flat(done, c))) for c in ("doc", "twin", "start", "size"))
        doc, twin, first, end = _joined(doc, twin, start, start + size)
        none = np.zeros(len(doc), np.int64)
        rows = [pa.table({"strip": none.astype(bool), "anchor": none, "doc": doc, "twin": twin, "start": first, "size": (end - first).astype(np.int32),
                          "inner": none.astype(bool), "many": none.astype(bool)})]
        if not last:
            rows.append(pa.table({"strip": np.ones(len(one["doc"]), bool), "anchor": one["anchor"].view(np.int64),
                                  **{c: one[c] for c in ("doc", "twin", "start", "size", "inner", "many")}}))
        return pa.concat_tables(rows)

    return met


def _pulled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted strips."""
    task = TaskContext.get().partitionId() % SHARDS
    for batch in released(sliced(batches)):
        texts = pa.compute.struct_field(batch.column("row"), "text")
        wanted = batch.column("wanted")
        flat_, row = wanted.flatten(), np.repeat(np.arange(batch.num_rows), np.diff(wanted.offsets.to_numpy()))
        doc, twin, start, size = (flat_.field(c).to_numpy(zero_copy_only=False) for c in ("doc", "twin", "start", "size"))
        # Another text may share the key.
        own = np.flatnonzero((doc == batch.column("doc").to_numpy()[row]) & (twin == batch.column("twin").to_numpy()[row]))
        reach = np.cumsum(size[own].astype(np.int64)) // HELD_BYTES
        for part in np.split(own, np.flatnonzero(np.diff(reach)) + 1) if len(own) else ():
            strips, last, raw = [], -1, b""
            for i in part.tolist():
                if row[i] != last:
                    last, raw = row[i], raw_bytes(texts[int(row[i])])
                strips.append(raw[start[i]:start[i] + size[i]])
            picked = flat_.take(pa.array(part))
            yield pa.record_batch({"anchor": picked.field("anchor"), "shard": pa.array(np.full(len(part), task, np.int32)), "strip": pa.array(strips, pa.binary()),
                                   "doc": picked.field("doc"), "twin": picked.field("twin"), "start": picked.field("start"), "many": picked.field("many")})


PULLED = "anchor bigint, shard int, strip binary, doc bigint, twin bigint, start bigint, many boolean"


def _merged(length: int):
    def merged(table: pa.Table) -> pa.Table:
        strips = table.column("strip").to_pylist()
        anchor, shard, doc, twin, start, many = (table.column(c).to_numpy() for c in ("anchor", "shard", "doc", "twin", "start", "many"))
        found: list[tuple[int, int, int, int]] = []

        def settle(members: list[int]) -> None:
            shards: dict[int, list[int]] = {}
            for i in members:
                shards.setdefault(int(shard[i]), []).append(i)
            order = [shards[s] for s in sorted(shards)]
            for own, marks in zip(order, repeated_starts([[strips[i] for i in m] for m in order], length)):
                for i, again in zip(own, marks):
                    if not many[i]:
                        turn = np.flatnonzero(np.diff(np.concatenate(([0], again.view(np.int8), [0]))))
                        found.extend((doc[i], twin[i], start[i] + a, start[i] + b - 1 + length) for a, b in zip(turn[::2], turn[1::2]))

        # Strings of different anchors are different: anchors go together only to save calls.
        members, held, order = [], 0, np.lexsort((start, twin, doc, anchor))
        # Rows that are one document bring a strip each.
        order = order[runs(*(c[order] for c in (anchor, doc, twin, start)))]
        for i, new in zip(order.tolist(), runs(anchor[order]).tolist()):
            if new and held >= MERGED:
                settle(members)
                members, held = [], 0
            members.append(i)
            held += len(strips[i])
        if members:
            settle(members)
        names = [f.split()[0] for f in SPANS.split(", ")]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*found) if found else [()] * 4, [pa.int64()] * 2 + [pa.int32()] * 2)], names=names)

    return merged


def _cut(texts: pa.Array, repeats: pa.Array) -> pa.Array:
    total, removed, count, kept, spans = [], [], [], [], []
    for text, repeat in zip(texts, repeats):
        raw = raw_bytes(text)
        total.append(len(raw))
        if not repeat.is_valid or not len(repeat.values):
            removed.append(0)
            count.append(0)
            kept.append(raw)
            spans.append([])
            continue
        first, last = (repeat.values.field(c).to_numpy().astype(np.int64) for c in ("first", "end"))
        order = np.argsort(first, kind="stable")
        first, reach = first[order], np.maximum.accumulate(last[order])
        new = np.concatenate(([True], first[1:] > reach[:-1]))
        heads, tails = first[new], reach[np.concatenate((new[1:], [True]))]
        removed.append(int((tails - heads).sum()))
        count.append(len(heads))
        edges = [0, *np.column_stack((heads, tails)).ravel().tolist(), len(raw)]
        kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2])))
        spans.append([{"first": a, "end": b} for a, b in zip(heads.tolist(), tails.tolist())])
    return pa.StructArray.from_arrays(
        [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary()),
         pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
        ["n_bytes", "n_removed", "n_spans", "kept", "spans"])


CUT = "n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, spans array<struct<first:bigint,end:bigint>>"


def remove_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """The rows with ``n_bytes``, ``n_removed``, ``n_spans``, ``kept`` (binary) and ``spans`` (removed bytes, [first, end)).

    Texts are their bytes, UTF-8 or not, null is empty; strings never cross texts and are judged
    on the whole input. All places of a repeated string go, the first too. Rows that repeat both
    doc_id and text are one document and get the same result; different texts under one doc_id
    and texts without doc_id are documents each. Other columns pass through; columns with the
    names above are replaced. An empty table gives an empty result.
    """
    spark = documents.sparkSession
    grams = sorted({max(1, min(GRAM, length // 2)), max(1, length // 2), length})
    buckets = bucket_count(documents, BYTES_PER_BUCKET)
    passed = [c for c in documents.columns if c.lower() not in ("n_bytes", "n_removed", "n_spans", "kept", "spans")]
    doc, twin = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("twin")
    known = F.when(F.col("doc") < (1 << 63) - 1, F.col("doc"))
    key = document_key(known, F.col("twin")).alias("key")
    keyed = documents.select(doc, twin, F.struct(*[F.col(f"`{c}`") for c in passed]).alias("row")).select(key, "doc", "twin", "row")
    # The texts are dealt by document once; all joins below read that.
    dealt = dealt_table(spark, "suffix-dedup-texts", keyed, "key")
    places = documents.select(doc, twin, "text").select(key, "text").toDF("doc", "text")
    replies = repeated_anchors(places, byte_symbols, grams[0], length, buckets).withColumnRenamed("doc", "key")
    sent = dealt.join(replies, "key").select("doc", "twin", "row", "anchors").mapInArrow(_of_texts(grams[0], length, buckets), SENT)
    stage, spans = written(spark, "suffix-dedup"), []

    def pulled(strips: DataFrame) -> DataFrame:
        wanted = strips.groupBy(key).agg(F.collect_list(F.struct("anchor", "doc", "twin", "start", "size", "many")).alias("wanted"))
        return dealt.join(wanted, "key").select("doc", "twin", "row", "wanted").mapInArrow(_pulled, PULLED)

    for level, gram in enumerate(grams):
        met = stage("met", sent.groupBy("bucket").applyInArrow(_met(gram == length), MET))
        spans.append(met.where("not strip").select("doc", "twin", F.col("start").cast("int").alias("first"), (F.col("start") + F.col("size")).cast("int").alias("end")))
        if gram == length:
            break  # equal strings have met
        strips = met.where("strip")
        groups = strips.groupBy("anchor").agg(F.count("*").alias("strips"), F.sum("size").alias("bytes"), F.bool_or(F.expr("inner and not many")).alias("within")) \
            .where("strips > 1 or within").select("anchor", (F.col("bytes") > CROWD).alias("crowded"))
        unsure = stage("unsure", strips.join(groups, "anchor"))
        sizes = {r.crowded: r.bytes for r in unsure.groupBy("crowded").agg(F.sum("size").alias("bytes")).collect()}
        if False in sizes:
            bucket = F.pmod(F.xxhash64("anchor"), F.lit(max(64, sizes[False] // BYTES_PER_BUCKET * 2)))
            spans.append(pulled(unsure.where("not crowded")).withColumn("bucket", bucket).groupBy("bucket").applyInArrow(_merged(length), SPANS))
        if True not in sizes:
            break
        # A strip has a string, and so a row, for about every second byte.
        finer = max(64, sizes[True] * 32 // BYTES_PER_BUCKET)
        sent = pulled(unsure.where("crowded")).mapInArrow(_of_strips(grams[level + 1], length, finer), SENT)
    found = reduce(DataFrame.union, spans).groupBy(key).agg(F.collect_list(F.struct("first", "end", "twin")).alias("repeats"))
    own = F.filter("repeats", lambda r: r["twin"] == F.col("twin"))
    return dealt.join(found, "key", "left").select("row", F.arrow_udf(_cut, CUT)(F.col("row.text"), own).alias("cut")).select("row.*", "cut.*")

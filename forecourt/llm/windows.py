"""Hashes of fixed-length windows, and which windows can repeat at all.

Shared by the operators that look for repeated passages. A window of W symbols contains
W - G + 1 grams of G symbols; its anchor is the smallest gram hash among them. Equal windows
have equal anchors, so a window whose anchor value stands at one place only in the whole table
occurs once. Counting anchors first (about 2 of W - G + 2 positions are one) therefore settles
most windows without shuffling them, and loses none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.llm.stages import raw_bytes, released, sliced

BASE = np.uint64(0x9E3779B97F4A7C15)
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
CHUNK, KEY_BITS = 1 << 20, 12
Symbols = Callable[[bytes], np.ndarray]

_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(12, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        _powers[size] = tuple(np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(size - 1, b, np.uint64))))
                              for b in (BASE, INVERSE))
    up, down = _powers[size]
    return up[:n], down[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 64-bit value over all its bits (a bijection)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def rabin_karp(symbols: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` symbols (uint64): a polynomial modulo 2^64, rolled by prefix sums."""
    n = len(symbols)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = _power_tables(n)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(symbols * down, out=total[1:])
    return mixed((total[width:] - total[:-width]) * up[:n - width + 1])


def sliding(best: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``best`` (minimum or maximum) over every run of ``width`` values."""
    out, reach = values, 1
    while 2 * reach <= width:
        out, reach = best(out[:-reach], out[reach:]), 2 * reach
    rest = width - reach
    return best(out[:-rest], out[rest:]) if rest else out


def window_anchors(symbols: np.ndarray, gram: int, window: int) -> np.ndarray:
    """The anchor of every window."""
    return sliding(np.minimum, rabin_karp(symbols, gram), window - gram + 1)


def anchor_places(symbols: np.ndarray, gram: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the grams that are the anchor of some window; long inputs go in overlapping chunks."""
    places, hashes, span = [], [], window - gram
    for at in range(0, max(1, len(symbols) - window + 1), CHUNK):
        part = symbols[at:at + CHUNK + window - 1]
        if len(part) < window:
            break
        grams = rabin_karp(part, gram)
        anchors = sliding(np.minimum, grams, span + 1)
        edge = np.zeros(span, np.uint64)
        chosen = np.flatnonzero(sliding(np.maximum, np.concatenate((edge, anchors, edge)), span + 1) == grams)
        places.append(chosen + at)
        hashes.append(grams[chosen])
    if len(places) <= 1:
        return (places[0], hashes[0]) if places else (np.empty(0, np.int64), np.empty(0, np.uint64))
    unique, first = np.unique(np.concatenate(places), return_index=True)
    return unique, np.concatenate(hashes)[first]


def lists(ends: np.ndarray, values: np.ndarray) -> pa.ListArray:
    """List arrays cut from one numpy array at the given ends."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(values))


def packed(buckets: np.ndarray, columns: dict[str, np.ndarray]) -> dict[str, pa.Array]:
    """One row per bucket present, with the members' values of each column as a list."""
    order = np.argsort(buckets, kind="stable")
    ordered = buckets[order]
    ends = np.flatnonzero(np.concatenate((ordered[1:] != ordered[:-1], [True]))) + 1 if len(order) else np.empty(0, np.int64)
    return {"bucket": pa.array(ordered[ends - 1].astype(np.int32)),
            **{name: lists(ends, values[order]) for name, values in columns.items()}}


def flat(table: pa.Table, name: str, dtype=np.int64) -> np.ndarray:
    """All members of a list column, in row order."""
    parts = [chunk.flatten().to_numpy(zero_copy_only=False) for chunk in table.column(name).chunks]
    return np.concatenate(parts).astype(dtype, copy=False) if parts else np.empty(0, dtype)


def bucket_count(texts: DataFrame, bytes_per_bucket: int) -> int:
    """Buckets that keep the work of one of them bounded whatever the size of the table."""
    total = texts.agg(F.sum(F.octet_length("text").cast("double"))).first()[0] or 0
    return int(min(max(64, total // bytes_per_bucket), 1 << 30))


def document_key(doc_id: Column, twin: Column) -> Column:
    """What a document's rows are dealt by: its id with some bits of the hash of its text, or that hash alone.

    Texts without id, and texts under one id, spread over tasks. Texts that share a key have the
    same id, so key and ``twin`` name a document.
    """
    small = doc_id.between(0, (1 << 62 - KEY_BITS) - 1)
    joined = F.shiftleft(doc_id.cast("bigint"), KEY_BITS).bitwiseOR(twin.bitwiseAND(F.lit((1 << KEY_BITS) - 1)))
    # Never null, also to the optimiser: a join would else filter one of two equal exchanges, and read both.
    return F.coalesce(F.when(small, joined).when(doc_id.isNotNull(), F.xxhash64(doc_id, twin)).otherwise(twin), F.lit(0))


def runs(*columns: np.ndarray) -> np.ndarray:
    """True where a row differs from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


REPLIES = "doc bigint, anchors array<bigint>"


def _replies(docs: np.ndarray, anchors: np.ndarray) -> pa.RecordBatch:
    order = np.lexsort((anchors, docs))
    docs, anchors = docs[order], anchors[order]
    once = runs(docs, anchors)
    docs, anchors = docs[once], anchors[once]
    ends = np.flatnonzero(np.concatenate((runs(docs)[1:], [True]))) + 1 if len(docs) else np.empty(0, np.int64)
    return pa.record_batch({"doc": pa.array(docs[ends - 1]), "anchors": lists(ends, anchors)})


def repeated_anchors(texts: DataFrame, symbols: Symbols, gram: int, window: int, buckets: int) -> DataFrame:
    """(doc, anchors): for each document with any, its anchors that stand at two or more places of the table.

    ``texts`` is (doc, text), doc being any 64-bit key of the row. Places are counted per input
    batch before the shuffle: an anchor seen often in a batch is answered there and sent on once,
    so a passage shared by a third of all documents costs one entry per batch.
    """

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(sliced(batches)):
            docs, found = [], []
            for doc, text in zip(batch.column("doc").to_pylist(), batch.column("text")):
                hashes = anchor_places(symbols(raw_bytes(text)), gram, window)[1]
                docs.append(np.full(len(hashes), doc, np.int64))
                found.append(hashes)
            if not found:
                continue
            doc, anchor = np.concatenate(docs), np.concatenate(found)
            order = np.argsort(anchor, kind="stable")
            doc, anchor = doc[order], anchor[order]
            new = runs(anchor)
            alone = new & np.concatenate((new[1:], [True])) if len(new) else new
            sent = packed((anchor[new] % np.uint64(buckets)).astype(np.int64), {
                "anchor": anchor[new].view(np.int64), "doc": doc[new], "many": ~alone[new]})
            rows = pa.record_batch(sent)
            yield rows.append_column("settled", pa.array(np.zeros(rows.num_rows, bool))).select(names)
            if not alone.all():
                sure = _replies(doc[~alone], anchor[~alone].view(np.int64))
                spread = pa.array((sure.column("doc").to_numpy() % buckets).astype(np.int32))
                sizes = np.diff(sure.column("anchors").offsets.to_numpy())
                doc_of = np.repeat(sure.column("doc").to_numpy(), sizes)
                ends = np.cumsum(sizes)
                yield pa.record_batch({"bucket": spread, "settled": pa.array(np.ones(len(spread), bool)),
                                       "anchor": sure.column("anchors"), "doc": lists(ends, doc_of),
                                       "many": lists(ends, np.zeros(len(doc_of), bool))}).select(names)

    def met(table: pa.Table) -> pa.Table:
        sure = table.filter(table.column("settled"))
        open_ = table.filter(pa.compute.invert(table.column("settled")))
        anchor, doc, many = flat(open_, "anchor"), flat(open_, "doc"), flat(open_, "many", bool)
        order = np.argsort(anchor, kind="stable")
        anchor, doc, many = anchor[order], doc[order], many[order]
        group = np.cumsum(runs(anchor)) - 1
        count = np.bincount(group, weights=1 + many) if len(group) else np.empty(0)
        pick = (count >= 2)[group] & ~many
        return pa.Table.from_batches([_replies(np.concatenate((doc[pick], flat(sure, "doc"))),
                                               np.concatenate((anchor[pick], flat(sure, "anchor"))))])

    names = ["bucket", "settled", "anchor", "doc", "many"]
    sent = texts.mapInArrow(places, "bucket int, settled boolean, anchor array<bigint>, doc array<bigint>, many array<boolean>")
    return sent.groupBy("bucket").applyInArrow(met, REPLIES).groupBy("doc").agg(F.flatten(F.collect_list("anchors")).alias("anchors"))

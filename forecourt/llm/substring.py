"""Substring de-duplication by Rabin-Karp hashes of every window of ``WINDOW`` words.

Every window of a text is hashed. Windows whose anchor (see ``windows``) repeats are counted in
Spark by a 128-bit hash, bucketed by that hash: within a bucket the earliest start of each hash
stays and all later starts are repeats. Runs of repeated starts merge into maximal intervals of
words, and the words inside them are removed. A task settles what repeats inside its own batch
and sends each distinct window once, so a passage that very many documents share is no hot key;
nor is a line inside ever different words, whose windows share an anchor but no hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.llm.stages import raw_bytes, released, sliced
from forecourt.llm.windows import (bucket_count, document_key, flat, lists, packed, rabin_karp, repeated_anchors, runs,
                                   window_anchors)

WINDOW, GRAM = 20, 8
BYTES_PER_BUCKET = 8 << 20
WORDS_KEPT = 1 << 16


class _WordHashes(dict):
    """64-bit hashes of the words seen last."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word, self.seed)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_first, _second = _WordHashes(1), _WordHashes(2)


def words_of(raw: bytes) -> list[bytes]:
    """Words between ASCII white space, unchanged."""
    return raw.split()


def word_symbols(raw: bytes) -> np.ndarray:
    return _first.of(words_of(raw))


SENT = ["bucket", "settled", "h1", "h2", "doc", "twin", "start"]


def _starts(doc: np.ndarray, twin: np.ndarray, start: np.ndarray) -> dict[str, pa.Array]:
    """Window starts -> maximal runs (doc, twin, first, last)."""
    order = np.lexsort((start, twin, doc))
    doc, twin, start = doc[order], twin[order], start[order]
    new = runs(doc, twin)
    new[1:] |= np.diff(start) > 1
    heads = np.flatnonzero(new)
    tails = np.concatenate((heads[1:], [len(doc)])) - 1 if len(heads) else heads
    return {"doc": doc[heads], "twin": twin[heads], "first": start[heads], "last": start[tails]}


def _later(h1, h2, doc, twin, start) -> tuple[np.ndarray, np.ndarray]:
    """Order of the windows by hash and place, and which of them start later than an equal window."""
    order = np.lexsort((start, twin, doc, h2, h1))
    new = runs(h1[order], h2[order])
    first = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    return order, (doc[order] != doc[first]) | (twin[order] != twin[first]) | (start[order] != start[first])


def _sent(gram: int, window: int, buckets: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(sliced(batches)):
            parts: list[tuple[np.ndarray, ...]] = []
            texts = pa.compute.struct_field(batch.column("row"), "text")
            for doc, twin, text, anchors in zip(batch.column("doc").to_pylist(), batch.column("twin").to_pylist(),
                                                texts, batch.column("anchors")):
                words = words_of(raw_bytes(text))
                symbols = _first.of(words)
                own = window_anchors(symbols, gram, window)
                at = np.flatnonzero(np.isin(own, anchors.values.to_numpy().view(np.uint64)))
                parts.append((rabin_karp(symbols, window)[at], rabin_karp(_second.of(words), window)[at],
                              np.full(len(at), doc, np.int64), np.full(len(at), twin, np.int64), at))
            if not parts:
                continue
            h1, h2, doc, twin, start = (np.concatenate(p) for p in zip(*parts))
            order, later = _later(h1, h2, doc, twin, start)
            keep, over = order[~later], order[later]
            rows = pa.record_batch(packed((h1[keep] % np.uint64(buckets)).astype(np.int64), {
                "h1": h1[keep].view(np.int64), "h2": h2[keep].view(np.int64), "doc": doc[keep], "twin": twin[keep],
                "start": start[keep].astype(np.int32)}))
            yield rows.append_column("settled", pa.array(np.zeros(rows.num_rows, bool))).select(SENT)
            if len(over):
                none = np.zeros(len(over), np.int64)
                rows = pa.record_batch(packed(doc[over] % buckets, {
                    "h1": none, "h2": none, "doc": doc[over], "twin": twin[over], "start": start[over].astype(np.int32)}))
                yield rows.append_column("settled", pa.array(np.ones(rows.num_rows, bool))).select(SENT)

    return windows


def _counted(table: pa.Table) -> pa.Table:
    settled, open_ = table.filter(table.column("settled")), table.filter(pa.compute.invert(table.column("settled")))
    h1, h2, doc, twin, start = (flat(open_, n) for n in ("h1", "h2", "doc", "twin", "start"))
    order, later = _later(h1, h2, doc, twin, start)
    over = order[later]
    found = _starts(*(np.concatenate((c[over], flat(settled, n))) for n, c in (("doc", doc), ("twin", twin), ("start", start))))
    return pa.table({c: v.astype(np.int32) if c in ("first", "last") else v for c, v in found.items()})


def _cut(window: int):
    def cut(texts: pa.Array, repeats: pa.Array) -> pa.Array:
        total, removed, kept, spans = [], [], [], []
        for text, repeat in zip(texts, repeats):
            words = words_of(raw_bytes(text))
            total.append(len(words))
            if not repeat.is_valid:
                removed.append(0)
                kept.append(b" ".join(words))
                spans.append([])
                continue
            edge, n = np.zeros(len(words) + 1, np.int64), len(words) + 1
            edge += np.bincount(repeat.values.field(0).to_numpy(), minlength=n)
            edge -= np.bincount(repeat.values.field(1).to_numpy() + window, minlength=n)
            gone = np.cumsum(edge[:-1]) > 0
            removed.append(int(gone.sum()))
            kept.append(b" ".join([w for w, g in zip(words, gone.tolist()) if not g]))
            turn = np.flatnonzero(np.diff(np.concatenate(([0], gone.view(np.int8), [0]))))
            spans.append([{"first": a, "end": b} for a, b in zip(turn[::2].tolist(), turn[1::2].tolist())])
        return pa.StructArray.from_arrays(
            [pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).view(pa.string()),
             pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))],
            ["n_words", "n_removed", "kept_text", "spans"])

    return F.arrow_udf(cut, "n_words bigint, n_removed bigint, kept_text string, spans array<struct<first:bigint,end:bigint>>")


def remove_repeats(documents: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows with ``n_words``, ``n_removed``, ``kept_text`` and ``spans`` (removed words, [first, end)).

    Words are judged on the whole input texts: a word goes when a window over it also starts
    earlier, in a smaller doc_id or earlier in its own text. Null and blank texts have no words
    and an empty ``kept_text``. Texts shorter than a window stay whole. Rows that repeat both
    doc_id and text count as one document and get the same result; different texts under one
    doc_id are ordered by their hash; a null doc_id counts as the largest. Other columns pass
    through; columns with the names above are replaced. An empty table gives an empty result.
    """
    buckets = bucket_count(documents, BYTES_PER_BUCKET)
    spark = documents.sparkSession
    gram = max(1, min(GRAM, window // 2))
    passed = [c for c in documents.columns if c.lower() not in ("n_words", "n_removed", "kept_text", "spans")]
    doc, twin = F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("doc"), F.xxhash64("text").alias("twin")
    known = F.when(F.col("doc") < (1 << 63) - 1, F.col("doc"))
    key = document_key(known, F.col("twin")).alias("key")
    keyed = documents.select(doc, twin, F.struct(*[F.col(f"`{c}`") for c in passed]).alias("row")).select(key, "twin", "row")
    # The texts are dealt by document once; both joins below read this one exchange.
    dealt = keyed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "key")
    places = documents.select(doc, twin, "text").select(key, "text").toDF("doc", "text")
    replies = repeated_anchors(places, word_symbols, gram, window, buckets).withColumnRenamed("doc", "key")
    # Whole rows go in here too: with fewer columns the exchange would be another one.
    sent = dealt.join(replies, "key").select(F.coalesce("row.doc_id", F.lit((1 << 63) - 1)).alias("doc"), "twin", "row", "anchors").mapInArrow(
        _sent(gram, window, buckets), "bucket int, settled boolean, h1 array<bigint>, h2 array<bigint>, "
                                      "doc array<bigint>, twin array<bigint>, start array<int>")
    found = sent.groupBy("bucket").applyInArrow(_counted, "doc bigint, twin bigint, first int, last int") \
        .groupBy(key).agg(F.collect_list(F.struct("first", "last", "twin")).alias("repeats"))
    own = F.filter("repeats", lambda r: r["twin"] == F.col("twin"))
    out = dealt.join(found, "key", "left").select("row", _cut(window)(F.col("row.text"), own).alias("cut"))
    return out.select("row.*", "cut.*")

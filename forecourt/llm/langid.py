"""Language identification by language-bitmask n-gram filters.

Each language has a Bloom filter of the letter n-grams that are typical of it: not rare in the
language, and not much rarer there than in the language that uses them most. The filters are bit-sliced:
a slot holds one bit per language, so three slots and two ANDs return the mask of all languages
that contain a gram. The bits of each language are counted over all grams of a text, and what its
filter would answer by mistake, known from its fill, is taken off; the highest count decides.

Gram counts come from all training documents, added up per input batch and then in Spark. A
language has at most 1 / ``RARE`` grams of each length, whatever the size of the corpus, which
bounds the filters; they alone are sent to the executors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.stages import Stage, released, sliced
from forecourt.llm.windows import BASE, mixed, runs

LENGTHS = (1, 2, 3, 4)
RARE, SHARED = 1e-4, 0.5
PROBES, SPREAD, SLOT_BITS = 3, 16, 21
FILTER_BYTES, LANGUAGES = 256 << 20, 4096
CHUNK, BATCH_CHARS = 1 << 18, 1 << 21
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)


def decoded(text: pa.Scalar) -> str:
    """A text in lower case; null is empty, and bytes that are no UTF-8 become the replacement character."""
    return text.as_buffer().to_pybytes().decode(errors="replace").lower() if text.is_valid else ""


def grams(joined: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, hashes) of the letter grams of a text: letters, with any other character as an edge at either end."""
    for at in range(0, len(joined), CHUNK):
        part = joined[at:at + CHUNK + LENGTHS[-1] - 1]
        code = np.frombuffer(part.encode("utf-32-le"), np.uint32)
        letter = _letters()[code]
        code = np.where(letter, code, 0).astype(np.uint64)
        for n in LENGTHS:
            size = min(CHUNK, len(code) - n + 1)
            if size <= 0:
                break
            inside = letter[1:-1] if n > 2 else letter
            good = np.ones(size, bool) if n > 2 else letter[:size].copy()
            if n == 2:
                good |= letter[1:size + 1]
            for i in range(n - 2):
                good &= inside[i:i + size]
            places = np.flatnonzero(good)
            h = np.full(len(places), n, np.uint64)
            for i in range(n):
                h = h * BASE + code[places + i]
            yield n, places + at, mixed(h)


def _joined(texts: list[str]) -> Iterator[tuple[int, str, np.ndarray]]:
    """Texts one behind the other with line feeds between, some at a time: (first text, joined, ends)."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text) + 1
        if size >= BATCH_CHARS or i + 1 == len(texts):
            yield first, "\n" + "\n".join(held) + "\n", np.cumsum([len(t) + 1 for t in held]) + 1
            first, held, size = i + 1, [], 0


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in released(sliced(batches)):
        langs = batch.column("lang").to_pylist()
        for lang in sorted(set(langs)):
            own = [decoded(t) for t, l in zip(batch.column("text"), langs) if l == lang]
            for _, joined, _ in _joined(own):
                found: dict[int, list[np.ndarray]] = {n: [] for n in LENGTHS}
                for n, _, h in grams(joined):
                    found[n].append(h)
                for n, parts in found.items():
                    h = np.sort(np.concatenate(parts)) if parts else np.empty(0, np.uint64)
                    heads = np.flatnonzero(runs(h))
                    yield pa.record_batch({
                        "lang": pa.array([lang] * len(heads), pa.string()), "length": pa.array(np.full(len(heads), n, np.int32)),
                        "gram": pa.array(h[heads].view(np.int64)), "n": pa.array(np.diff(np.append(heads, len(h))).astype(np.int64))})


@dataclass
class Filters:
    """Bit-sliced filters: ``slots`` (slot, word) of language bits, and how often each language's filter errs."""

    languages: list[str]
    slots: np.ndarray
    wrong: np.ndarray

    @classmethod
    def of(cls, languages: list[str], slots: np.ndarray) -> Filters:
        fill = np.array([(slots[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).mean() for i in range(len(languages))])
        return cls(languages, slots, fill ** PROBES)

    def containing(self, hashes: np.ndarray) -> np.ndarray:
        """(gram, word): the languages that contain each gram."""
        least = np.uint64(len(self.slots) - 1)
        found = self.slots[hashes & least]
        for i in range(1, PROBES):
            found &= self.slots[hashes >> np.uint64(SLOT_BITS * i) & least]
        return found

    def judge(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """(language, score) of lower-case texts: the largest corrected share of grams; the first language wins ties."""
        total, hits = np.zeros(len(texts)), np.zeros((len(texts), len(self.languages)))
        for first, joined, ends in _joined(texts):
            for _, places, h in grams(joined):
                # A gram that starts with the line feed before a text belongs to that text.
                doc = np.searchsorted(ends - 1, places, side="right")
                keep = doc < len(ends)
                doc, found = doc[keep], self.containing(h[keep])
                heads = np.flatnonzero(runs(doc))
                if not len(heads):
                    continue
                at = doc[heads] + first
                total[at] += np.diff(np.append(heads, len(doc)))
                for i in range(len(self.languages)):
                    bits = (found[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(np.int64)
                    hits[at, i] += np.add.reduceat(bits, heads)
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        share = np.clip((hits / np.maximum(total, 1)[:, None] - self.wrong) / (1 - self.wrong), 0, 1)
        best = share.argmax(axis=1)
        return ([self.languages[b] if t else UNKNOWN for b, t in zip(best, total)],
                np.where(total > 0, share[np.arange(len(texts)), best], 0.0))


def learn(documents: DataFrame, stage: Stage) -> Filters:
    """Filters of the languages of (text, lang): typical grams of all rows with a language."""
    spark = documents.sparkSession
    known = documents.where("lang is not null")
    names = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES + 1).select("lang").collect()
    languages = [r.lang for r in names]
    if len(languages) > LANGUAGES:
        raise ValueError(f"more than {LANGUAGES} languages")
    counts = stage("grams", known.select("text", "lang").mapInArrow(_counted, "lang string, length int, gram bigint, n bigint")
                   .groupBy("lang", "length", "gram").agg(F.sum("n").alias("n")))
    totals = counts.groupBy("lang", "length").agg(F.sum("n").alias("total"))
    rated = counts.join(totals, ["lang", "length"]).withColumn("rate", F.col("n") / F.col("total")).where(F.col("rate") >= RARE)
    typical = stage("typical", rated.withColumn("top", F.max("rate").over(Window.partitionBy("gram")))
                    .where(F.col("rate") >= SHARED * F.col("top")).select("lang", "gram"))
    largest = typical.groupBy("lang").count().agg(F.max("count")).first()[0] or 0
    slots = 1 << min(SLOT_BITS, max(6, (SPREAD * largest - 1).bit_length()))
    words = max(1, -(-len(languages) // 64))
    if slots * words * 8 > FILTER_BYTES:
        raise ValueError(f"filters of {len(languages)} languages are too large to send to every executor")
    order = spark.createDataFrame([(lang, i) for i, lang in enumerate(languages)], "lang string, i int")
    probes = F.explode(F.array(*[F.shiftrightunsigned("gram", SLOT_BITS * i).bitwiseAND(F.lit(slots - 1)) for i in range(PROBES)]))
    bits = typical.join(order, "lang").select(probes.alias("slot"), F.expr("int(i div 64)").alias("word"), F.expr("shiftleft(1L, i % 64)").alias("bit")) \
        .groupBy("slot", "word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table = np.zeros((slots, words), np.uint64)
    table[bits.column("slot").to_numpy(), bits.column("word").to_numpy()] = bits.column("bits").to_numpy().view(np.uint64)
    return Filters.of(languages, table)


def held_out(doc_id: Column) -> Column:
    """The rows that nothing is learned from; a row without id is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(documents: DataFrame, stage: Stage) -> DataFrame:
    """The rows with ``held_out``, ``lang_pred`` and ``score``, learned from the text and lang of rows not held out.

    Whole texts count. Null texts and texts without a letter are ``und`` with score 0, as is every text where no language
    was learned. Of equal counts, the language with more training documents wins, then the
    smaller name; so does it, with score 0, for a text that no filter knows. The score is the
    corrected share of a text's grams that its language contains. Predictions read the text
    alone. Repeated rows get equal results; other columns pass through, columns with the names
    above are replaced. An empty table gives an empty result.
    """
    passed = [F.col(f"`{c}`") for c in documents.columns if c.lower() not in ("held_out", "lang_pred", "score")]
    shared = documents.sparkSession.sparkContext.broadcast(
        learn(documents.where(~held_out(F.col("doc_id"))).select("text", "lang"), stage))

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in released(batches):
            langs, scores = [], []
            for at in range(0, len(texts), 2048):
                lang, score = shared.value.judge([decoded(t) for t in texts[at:at + 2048]])
                langs += lang
                scores.append(score)
            yield pa.StructArray.from_arrays([pa.array(langs, pa.string()), pa.array(np.concatenate([np.empty(0), *scores]))], ["lang_pred", "score"])

    return documents.select(*passed, held_out(F.col("doc_id")).alias("held_out"), judged("text").alias("_judged")) \
        .select(*passed, "held_out", "_judged.*")

"""Language identification: filters against plain sets, gram counts against a plain count, held-out accuracy."""

from __future__ import annotations

import collections
import zlib

import numpy as np
from pyspark.sql import functions as F

from forecourt.llm import langid, queries
from forecourt.llm.stages import written
from conftest import SF

TEXTS = ["", "abc", "Don't stop.", "ÄÖ ß1x\n\nпривет 東京", "İstanbul", "  a  ", "42 !!", "é" * 30, "\x00a\x00", "𝒳y 🙂z"]


def plain_grams(text):
    """(length, gram) of a text by slicing, edges as spaces."""
    low = " " + "".join(c if c.isalpha() else " " for c in text.lower()) + " "
    for n in langid.LENGTHS:
        for i in range(len(low) - n + 1):
            gram = low[i:i + n]
            if (n == 1 and gram != " ") or (n == 2 and gram != "  ") or (n > 2 and " " not in gram[1:-1]):
                yield n, gram


def hashes(joined):
    return collections.Counter((n, h) for n, _, hs in langid.grams(joined) for h in hs.tolist())


def test_grams(monkeypatch):
    plain, own = collections.Counter(), collections.Counter()
    for text in TEXTS:
        mine, theirs = hashes("\n" + text.lower() + "\n"), collections.Counter(plain_grams(text))
        assert sorted(mine.values()) == sorted(theirs.values()) and {n for n, _ in mine} == {n for n, _ in theirs}
        plain.update(theirs)
        own.update(mine)
    assert sorted(plain.values()) == sorted(own.values())  # equal grams of two texts have equal hashes, others do not
    whole = "\n" + "\n".join(TEXTS).lower() + "\n"
    once = hashes(whole)
    monkeypatch.setattr(langid, "CHUNK", 5)
    assert hashes(whole) == once


def test_counts_as_plain_count(spark):
    rows = spark.createDataFrame([(t, "x" if i % 2 else "y") for i, t in enumerate(TEXTS * 3)] + [(None, "x")], "text string, lang string")
    got = collections.Counter()
    for r in rows.mapInArrow(langid._counted, "lang string, length int, gram bigint, n bigint").collect():
        got[r.lang, r.length, r.gram] += r.n
    want = collections.Counter((("x" if i % 2 else "y"), *g) for i, t in enumerate(TEXTS * 3) for g in plain_grams(t))
    assert sorted((k[:2], v) for k, v in got.items()) == sorted((k[:2], v) for k, v in want.items())


def test_filters_lose_nothing_and_know_their_errors():
    rng = np.random.default_rng(0)
    sets = [set(rng.integers(0, 1 << 63, n).astype(np.uint64).tolist()) for n in (3000, 900, 50)]
    slots = np.zeros((1 << 13, 2), np.uint64)
    for i, s in zip((0, 1, 70), sets):
        for h in s:
            for k in range(langid.PROBES):
                slots[h >> langid.SLOT_BITS * k & 8191, i // 64] |= np.uint64(1 << i % 64)
    filters = langid.Filters.of([str(i) for i in range(71)], slots)
    member = lambda found, i: (found[:, i // 64] >> np.uint64(i % 64) & np.uint64(1)).astype(bool)
    for i, s in zip((0, 1, 70), sets):
        assert member(filters.containing(np.array(sorted(s), np.uint64)), i).all()
        strangers = langid.mixed(np.arange(200_000, dtype=np.uint64))
        assert abs(member(filters.containing(strangers), i).mean() - filters.wrong[i]) < 0.01
    assert filters.wrong[2] == 0 and 0.2 < filters.wrong[0] < 0.4


def test_judge_takes_off_false_answers():
    """A full filter answers everything and so counts for nothing."""
    slots = np.full((64, 1), 0b10, np.uint64)
    text = "hello"
    for _, _, h in langid.grams(f"\n{text}\n"):
        for k in range(langid.PROBES):
            slots[h >> np.uint64(langid.SLOT_BITS * k) & np.uint64(63), 0] |= np.uint64(1)
    filters = langid.Filters(["right", "full"], slots, np.array([0.1, 0.999999]))
    assert filters.judge([text, "", "12"]) [0] == ["right", langid.UNKNOWN, langid.UNKNOWN]


def test_held_out_accuracy(spark):
    folder = SF.replace("0.001", "0.1")
    out = queries.language_id(spark, folder)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"}
    rows = {r.doc_id: r for r in out.collect()}
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang", F.length("text").alias("n")).collect()
    assert len(rows) == len(texts)
    assert all(rows[t.doc_id].held_out == (zlib.crc32(str(t.doc_id).encode()) % 4 == 2) for t in texts)
    held = [t for t in texts if rows[t.doc_id].held_out]
    assert sum(rows[t.doc_id].lang_pred == t.lang for t in held) / len(held) > 0.995
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, f"haus und maus {i}", "de") for i in range(40)] + [(i, f"the house cat {i}", "en") for i in range(40, 90)]
    learned = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    kept = [(i, t, lang if (i, t, lang) in learned else "xx") for i, t, lang in rows]
    schema = "doc_id bigint, text string, lang string"
    a = sorted(map(tuple, langid.identify(spark.createDataFrame(rows, schema), written(spark, "t")).drop("lang").collect()))
    b = sorted(map(tuple, langid.identify(spark.createDataFrame(kept, schema), written(spark, "t")).drop("lang").collect()))
    assert a == b and {r[3] for r in a} == {"de", "en"}


def test_odd_rows(spark):
    rows = [(1, "haus maus", "de", "s"), (2, None, "de", "s"), (3, "", "en", "s"), (4, "house cat", "en", "s"), (None, "katze haus", None, "s"),
            (4, "house cat", "en", "s"), (7, "123 ... !", "de", "s"), (8, "жук", None, "s"), (9, "haus " * 200_000, None, "s"), (11, "zebra", "", "s")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string").withColumn("Held_Out", F.lit(3))
    out = langid.identify(frame, written(spark, "t")).orderBy("doc_id", "text").collect()
    got = [(r.doc_id, r.lang_pred, r.held_out) for r in out]
    told = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 2, 3, 4, 7, 8, 9, 11)}
    assert ("lang" in out[0].asDict()) and len(got) == len(rows)
    assert (None, "de", False) in got
    by = {i: (lang, held) for i, lang, held in got if i}
    assert all(by[i][1] == told[i] for i in told)
    assert by[2][0] == by[3][0] == by[7][0] == "und" and by[9][0] == by[1][0] == "de" and by[4][0] == "en"
    assert by[8][0] in ("de", "en") and {r.score for r in out if r.doc_id in (2, 3, 7, 8)} == {0.0}
    assert langid.identify(frame.limit(0), written(spark, "t")).count() == 0
    none = frame.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify(none, written(spark, "t")).collect()} == {("und", 0.0)}


def test_bytes_that_are_no_text(spark):
    frame = spark.sql("select 1L as doc_id, cast(x'68c3ffc38461' as string) as text, 'de' as lang union all select 9L, 'haus', 'de'")
    assert {r.lang_pred for r in langid.identify(frame, written(spark, "t")).collect()} == {"de"}

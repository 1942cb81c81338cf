"""Repeated byte strings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from forecourt.llm import bwt, queries, windows
from conftest import SF


def plain(rows, length):
    raw = {i: (t or "").encode() for i, t in rows}
    count = Counter(r[p:p + length] for r in raw.values() for p in range(len(r) - length + 1))
    out = {}
    for i, r in raw.items():
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if count[r[p:p + length]] > 1:
                gone[p:p + length] = b"\x01" * length
        spans = sum(g and not (p and gone[p - 1]) for p, g in enumerate(gone))
        out[i] = len(r), sum(gone), spans, bytes(b for b, g in zip(r, gone) if not g)
    return out


def result(frame):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in frame.collect()}


def test_merged_transforms():
    rng = random.Random(1)
    for length in (1, 7, 40, 80):
        strips = ["".join(rng.choice("ab") for _ in range(length + rng.randrange(30))).encode() for _ in range(12)]
        shards = [strips[:3], strips[3:4], strips[4:]]
        count = Counter(s[p:p + length] for s in strips for p in range(len(s) - length + 1))
        found = [m.tolist() for shard in bwt.repeated_starts(shards, length) for m in shard]
        assert found == [[count[s[p:p + length]] > 1 for p in range(len(s) - length + 1)] for s in strips]


def test_random_passages(spark):
    rng = random.Random(6)
    passages = ["".join(rng.choice("abé \n") for _ in range(rng.randrange(20, 140))) for _ in range(10)]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(passages) if rng.random() < .4 else "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(90)))
                       for _ in range(rng.randrange(0, 6)))
        rows.append((i * 7 % 131, text))
    rows += [(900, "x" * 300), (901, "xy" * 21), (902, None), (903, ""), (904, rows[0][1]), (905, rows[0][1])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for length in (40, 60):
        assert result(bwt.remove_repeats(frame, length)) == plain(rows, length)


@pytest.mark.parametrize("crowd, held", [(1 << 19, 1 << 18), (500, 50), (0, 1 << 18)])
def test_crowded_anchors_meet_by_finer_ones(spark, monkeypatch, crowd, held):
    monkeypatch.setattr(bwt, "CROWD", crowd)
    monkeypatch.setattr(bwt, "HELD", held)
    monkeypatch.setattr(bwt, "MERGED", crowd)
    monkeypatch.setattr(bwt, "HELD_BYTES", 100)
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    long, line = word(90), word(25)
    rows = [(i, word(rng.randrange(40)) + rng.choice([long, line, long + line, line + long[:50], long[:39], long[5:44]]) + word(rng.randrange(40))) for i in range(150)]
    rows += [(200, "x" * 300), (201, None), (202, rows[0][1]), (203, long * 3), (204, "xy" * 90 + "x" * 41)]
    frame = spark.createDataFrame(rows + rows[:20], "doc_id bigint, text string").repartition(7)
    assert result(bwt.remove_repeats(frame, 40)) == plain(rows, 40)


def test_a_line_in_other_texts_everywhere_is_no_hot_group(spark, monkeypatch):
    """Strips of its anchors go on to longer grams, where no group has them all."""
    rng = random.Random(10)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    line = min((word(150) for _ in range(50)), key=lambda t: windows.rabin_karp(bwt.byte_symbols(t.encode()), 64).min())
    rows = [(i, word(400) + line + word(400)) for i in range(300)] + [(300 + i, word(100) + line + word(20)) for i in range(9)]
    rows += [(400, rows[5][1][200:700]), (401, "")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    seen, real = [], bwt._of_strips
    monkeypatch.setattr(bwt, "CROWD", 20_000)
    monkeypatch.setattr(bwt, "_of_strips", lambda gram, *more: seen.append(gram) or real(gram, *more))
    assert result(bwt.remove_repeats(frame, 400)) == plain(rows, 400)
    assert seen == [200]


def test_shards_must_be_sorted(monkeypatch):
    """The merge reads the order of each shard and makes none of its own."""
    rng = random.Random(3)
    strips = ["".join(rng.choice("abc") for _ in range(60)).encode() for _ in range(9)]
    shards = [strips[:4], strips[4:]]
    right = [m.tolist() for shard in bwt.repeated_starts(shards, 7) for m in shard]
    monkeypatch.setattr(bwt.Transform, "order", staticmethod(lambda symbol, before, ends, rounds: np.arange(len(symbol))))
    assert [m.tolist() for shard in bwt.repeated_starts(shards, 7) for m in shard] != right


def test_transform_is_that_of_the_sorted_suffixes():
    rng = random.Random(2)
    chains = [np.array([rng.randrange(3) for _ in range(n)]) for n in (9, 1, 6)]
    made = bwt.Transform(chains, 1, 20)
    suffixes = [(chain[i:].tolist(), int(chain[i - 1]) if i else -1) for chain in chains for i in range(len(chain) + 1)]
    texts = [s for s, _ in suffixes]
    assert [texts[p] for p in made.place] == sorted(texts) and made.symbol.tolist() == [suffixes[p][1] for p in made.place]


def test_merge_stops_when_no_block_splits(monkeypatch):
    """Different strips are told apart in a few rounds, whatever their length."""
    rounds, real = [], bwt.stable_order
    chains = [np.arange(50 * i, 50 * i + 50) for i in range(4)]
    shards = [bwt.Transform(chains[:2], 1, 50), bwt.Transform(chains[2:], 1, 50)]
    monkeypatch.setattr(bwt, "stable_order", lambda ids: rounds.append(1) or real(ids))
    block = bwt.merge(shards, 50)
    assert len(rounds) < 5 and len(np.unique(block)) == 201


def test_text_that_is_no_utf8(spark):
    rng = random.Random(5)
    part = bytes(rng.randrange(128, 256) for _ in range(60)).hex()
    frame = spark.sql(f"select 1L as doc_id, cast(x'{part}41' as string) as text union all select 2L, cast(x'42{part}' as string)")
    assert {(r.doc_id, r.n_removed, bytes(r.kept)) for r in bwt.remove_repeats(frame, 40).collect()} == {(1, 60, b"A"), (2, 60, b"B")}


def test_rows_without_id_are_documents_each(spark):
    rng = random.Random(12)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    shared = word(50)
    texts = [word(30) + shared + word(i) for i in range(40)]
    out = bwt.remove_repeats(spark.createDataFrame([(None, t) for t in texts], "doc_id bigint, text string"), 40)
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in out.collect()) == sorted(plain(list(enumerate(texts)), 40).values())
    texts = spark.range(20_000).select(F.xxhash64("id").alias("twin"))
    for doc in (F.lit(None), F.lit(7)):
        keys = texts.groupBy(windows.document_key(doc, F.col("twin"))).count().agg(F.count("*"), F.max("count")).first()
        assert keys[0] >= 4000 and keys[1] < 30


def test_repeated_rows_clashing_columns_and_no_rows(spark):
    rng = random.Random(8)
    text = "".join(rng.choice("abcdefgh") for _ in range(500))
    rows = [(4, text, "x"), (4, text, "y"), (2, "other", "x"), (None, "z" + text[:450], "n")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, kept string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in bwt.remove_repeats(frame).collect()) == [(0, 450), (2, 0), (4, 450), (4, 450)]
    alone = bwt.remove_repeats(frame.where("doc_id is not null"))
    assert alone.columns == ["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept", "spans"]
    assert sum(r.n_removed for r in alone.collect()) == 0
    assert bwt.remove_repeats(frame.limit(0)).count() == 0


def test_whole_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, r, s, hashlib.sha256(k).hexdigest()) for i, (n, r, s, k) in plain(rows, 400).items()}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.suffix_dedup(spark, SF).collect()}
    assert got == want and any(w[1] for w in want.values())

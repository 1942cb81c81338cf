"""Substring de-duplication against brute force."""

from __future__ import annotations

import hashlib
import random

import duckdb
import numpy as np
import pyarrow as pa

from forecourt.llm import oracle, queries, substring, windows
from conftest import SF


def plain(rows, window):
    """(doc_id, text) with distinct ids -> {doc_id: (n_words, n_removed, kept text)}."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        words = substring.words_of((text or "").encode())
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                gone[i:i + window] = [True] * window
            seen.add(key)
        out[doc_id] = len(words), sum(gone), b" ".join(w for w, g in zip(words, gone) if not g).decode()
    return out


def result(frame):
    return {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in frame.collect()}


def test_rolled_hashes():
    rng = np.random.default_rng(3)
    symbols = rng.integers(0, 4, 300).astype(np.uint64)
    for width in (1, 3, 20, 300, 301):
        h = windows.rabin_karp(symbols, width)
        keys = [tuple(symbols[i:i + width]) for i in range(max(0, 300 - width + 1))]
        assert len(h) == len(keys) and len(set(h.tolist())) == len(set(keys))
        assert len({(a, b) for a, b in zip(keys, h.tolist())}) == len(set(keys))
    for width in (1, 2, 5, 13):
        assert windows.sliding(np.minimum, symbols, width).tolist() == [min(symbols[i:i + width]) for i in range(301 - width)]


def test_anchor_places_in_chunks(monkeypatch):
    symbols = np.random.default_rng(4).integers(0, 50, 5000).astype(np.uint64)
    whole = windows.anchor_places(symbols, 8, 20)
    monkeypatch.setattr(windows, "CHUNK", 64)
    parts = windows.anchor_places(symbols, 8, 20)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()
    assert set(windows.window_anchors(symbols, 8, 20).tolist()) == set(whole[1].tolist())


def test_random_passages(spark):
    rng = random.Random(5)
    passages = [[f"w{rng.randrange(30)}" for _ in range(rng.randrange(15, 60))] for _ in range(12)]
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.randrange(0, 6)):
            words += rng.choice(passages) if rng.random() < .5 else [f"w{rng.randrange(400)}" for _ in range(rng.randrange(40))]
        rows.append((i * 7 % 151, " \n".join(words)))
    rows += [(900, "same " * 70), (901, "same " * 19), (902, None), (903, ""), (904, "é ß " * 9 + "\t")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert result(substring.remove_repeats(frame)) == plain(rows, 20)
    assert result(substring.remove_repeats(frame, 5)) == plain(rows, 5)


def test_a_line_in_other_words_everywhere_is_no_hot_bucket():
    rng, line = random.Random(7), [f"line{i}" for i in range(12)]
    texts = [" ".join([f"w{rng.getrandbits(60)}" for _ in range(30)] + line + [f"w{rng.getrandbits(60)}" for _ in range(30)]) for _ in range(400)]
    shared = windows.rabin_karp(substring.word_symbols(" ".join(line).encode()), 8).view(np.int64).tolist()
    batch = pa.record_batch({"doc": pa.array(range(400), pa.int64()), "twin": pa.array(range(400), pa.int64()),
                             "row": pa.array([{"text": t} for t in texts]), "anchors": pa.array([shared] * 400, pa.list_(pa.int64()))})
    held = np.zeros(64, np.int64)
    for rows in substring._sent(8, 20, 64)(iter([batch])):
        for bucket, starts in zip(rows.column("bucket").to_pylist(), rows.column("start").to_pylist()):
            held[bucket] += len(starts)
    assert held.sum() >= 400 and held.max() < 3 * held.mean()


def test_repeated_rows_clashing_columns_and_no_rows(spark):
    text = " ".join(f"t{i}" for i in range(30))
    rows = [(4, text, "x"), (4, text, "y"), (2, "z " + text, "x"), (None, text, "n")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, n_words string")
    out = substring.remove_repeats(frame)
    assert out.columns == ["doc_id", "text", "n_words", "n_removed", "kept_text", "spans"]
    assert sorted((r.doc_id or 99, r.n_removed) for r in out.collect()) == [(2, 0), (4, 30), (4, 30), (99, 30)]
    assert substring.remove_repeats(frame.limit(0)).count() == 0


def test_whole_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {i: (n, r, hashlib.sha256(k.encode()).hexdigest()) for i, (n, r, k) in plain(rows, 20).items()}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.substring_dedup(spark, SF).collect()} == want
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    twin = con.execute(f"SELECT doc_id, n_words, n_removed, kept_sha256 FROM ({oracle.SQL['op3_substring_dedup']})").fetchall()
    assert {r[0]: r[1:] for r in twin} == want

"""SimHash fingerprints and components against brute force."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from forecourt.llm import queries, simhash
from forecourt.llm.stages import written
from conftest import SF


def plain_fingerprint(text, shingle=3):
    words, buffer = [], bytearray()
    for byte in (text or "").encode() + b" ":
        if byte == 32 or 9 <= byte <= 13:
            if buffer:
                words.append(bytes(buffer))
            buffer = bytearray()
        else:
            buffer.append(byte + 32 if 65 <= byte <= 90 else byte)
    if not words:
        return 0
    grams = [words[i:i + shingle] for i in range(len(words) - shingle + 1)] or [words]
    hashes = [xxhash.xxh64(b" ".join(g), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(marks, radius=3):
    parent = {i: i for i in marks}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(marks), 2):
        if (marks[a] ^ marks[b]).bit_count() <= radius:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: root(i) for i in marks}


TEXTS = [None, "", " \t\n ", "one", "One two", "a b c d e f g", "A B c d e f g", "x" * 50_000, "Ä ä ö", "a b c " * 4000]


def test_fingerprints():
    for text in TEXTS:
        assert simhash.fingerprint_of((text or "").encode(), 3) == plain_fingerprint(text)


def test_spark_hash_is_the_stated_one(spark):
    row = spark.sql("select xxhash64('a b c') as h").first()
    assert row.h & ((1 << 64) - 1) == xxhash.xxh64(b"a b c", seed=42).intdigest()


def test_any_three_bits_are_left_out_by_a_mask():
    masks = simhash.covering_masks(list(range(64)))
    assert len(masks) == 15
    for bits in itertools.combinations(range(64), 3):
        pattern = sum(1 << b for b in bits)
        assert any(not m & pattern for m in masks)


@pytest.mark.parametrize("bucket", [2048, 4])
def test_links_as_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    rng, marks = random.Random(bucket), {}
    while len(marks) < 240:
        x = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 2, 30])):
            marks[len(marks)] = x
            for b in rng.sample(range(64) if rng.random() < .6 else range(14), rng.choice([1, 2, 3, 4])):
                x ^= 1 << b
    marks = {i: m for i, m in enumerate(dict.fromkeys(marks.values()))}
    rows = spark.createDataFrame([(i, simhash._signed(m)) for i, m in marks.items()], "id bigint, fp bigint")
    stage = written(spark, "test")
    found = {r.node: r.component for r in
             simhash.connected_components(simhash.links(rows, stage), stage).collect()}
    assert {i: found.get(i, i) for i in marks} == components(marks)


def test_whole_query_and_odd_rows(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    marks = {r.doc_id: plain_fingerprint(r.text) for r in rows}
    want = components(marks)
    out = queries.simhash_near_dedup(spark, SF).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in out} == {i: (f"{m:016x}", want[i]) for i, m in marks.items()}
    odd = spark.createDataFrame([(5, "a b c d", 1), (3, "a b c d", 2), (5, "a b c d", 3), (None, "a b c d", 4), (9, None, 5), (8, "", 6)],
                                "doc_id bigint, text string, fp int")
    got = simhash.near_duplicates(odd, written(spark, "test")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (3, 3), (5, 3), (5, 3), (8, 8), (9, 8)]
    assert simhash.near_duplicates(odd.limit(0), written(spark, "test")).count() == 0


def shingles(text, k=5):
    words = (text or "").lower().split()
    return {tuple(words[i:i + k]) for i in range(len(words) - k + 1)} or ({tuple(words)} if words else set())


def test_near_copies_against_shingle_sets(spark):
    """Links are never false; nine in ten of the documents that exact similarity drops are dropped."""
    folder = SF.replace("0.001", "0.1")
    rows = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 6000").select("doc_id", "text")
    sets = {r.doc_id: frozenset(shingles(r.text)) for r in rows.collect()}
    where = {}
    for i, s in sets.items():
        for x in s:
            where.setdefault(x, []).append(i)
    pairs = {(a, b) for ids in where.values() if len(ids) < 60 for a, b in itertools.combinations(ids, 2)}
    same = {}
    for i, s in sorted(sets.items()):
        same.setdefault(s, i)
    pairs |= {(same[s], i) for i, s in sets.items() if same[s] != i}
    alike = [(a, b) for a, b in pairs if len(sets[a] & sets[b]) >= 0.8 * (len(sets[a]) * len(sets[b])) ** .5]

    def grouped(links):
        parent = {i: i for i in sets}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        return {i: root(i) for i in sets}

    want = grouped(alike)
    got = {r.doc_id: r.component_id for r in simhash.near_copies(rows, written(spark, "t")).collect()}
    assert set(got) == set(want) and all(want[i] == want[c] for i, c in got.items())
    dropped = [i for i, c in want.items() if i != c]
    new = [i for i in dropped if sets[i] != sets[want[i]]]
    assert len(new) > 100 and sum(got[i] != i for i in new) / len(new) > 0.9
    assert all(got[i] != i for i in dropped if same[sets[i]] != i)


def test_near_copies_odd_rows(spark):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(5, text, 1), (3, text.upper(), 2), (9, text.replace("word7 ", "other "), 3), (None, text, 4), (8, "", 5), (7, None, 6), (6, "a b", 7), (4, "b a", 8), (5, text, 9)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, of int")
    got = simhash.near_copies(frame, written(spark, "t")).collect()
    assert sorted((r.doc_id or -1, r.component_id or -1) for r in got) == [(-1, -1), (3, 3), (4, 4), (5, 3), (5, 3), (6, 6), (7, 7), (8, 7), (9, 3)]
    assert simhash.near_copies(frame.limit(0), written(spark, "t")).count() == 0


def changed(words, places, tag):
    return " ".join(f"{tag}{i}" if i in places else w for i, w in enumerate(words))


def grouped_of(spark, texts, stage=None):
    frame = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    return {r.doc_id: r.component_id for r in simhash.near_copies(frame, stage or written(spark, "t")).collect()}


def test_a_large_group_of_near_copies_makes_few_edges(spark):
    words, rng = [f"word{i}" for i in range(300)], random.Random(1)
    texts = {i: changed(words, set(rng.sample(range(300), 6)), f"own{i}x") for i in range(500)}
    folder, counts = written(spark, "t"), {}

    def stage(step, frame):
        out = folder(step, frame)
        counts[step] = out.count()
        return out

    assert set(grouped_of(spark, texts, stage).values()) == {0}
    # The star joins read no more edges than one forest for each task that checked links.
    assert counts["edges"] < 8 * len(texts)


def test_near_copies_close_to_the_limit(spark):
    """Cosines of 0.80 to 0.82 by changes all over the text."""
    rng, texts = random.Random(5), {}
    for i in range(60):
        words = [f"t{i}w{j}" for j in range(400)]
        texts[2 * i] = " ".join(words)
        texts[2 * i + 1] = changed(words, set(range(rng.randrange(14, 24), 400, 26)), f"new{i}x")
    sets = {i: shingles(t) for i, t in texts.items()}
    alike = [i for i in range(0, 120, 2) if len(sets[i] & sets[i + 1]) >= 0.8 * (len(sets[i]) * len(sets[i + 1])) ** .5]
    found = grouped_of(spark, texts)
    assert len(alike) == 60 and sum(found[i] == found[i + 1] for i in alike) >= 57


def test_nearest_links_are_checked_first(spark):
    """Text 0 has the words of 1 and 2 in another order: it is nearest by words, but like neither."""
    rng = random.Random(3)
    pairs = {}
    for i in range(0, 90, 3):
        words = [f"t{i}w{j}" for j in range(200)]
        pairs[i + 1], pairs[i + 2] = " ".join(words), changed(words, {60, 140}, f"new{i}x")
        pairs[i] = " ".join(rng.sample(words, 200))
    found = grouped_of(spark, pairs)
    assert found == {i: i + 1 if (i % 3) == 2 else i for i in pairs} | {i + 2: i + 1 for i in range(0, 90, 3)} | {i + 1: i + 1 for i in range(0, 90, 3)}


@pytest.mark.parametrize("bucket", [2048, 20])
def test_full_buckets_of_near_copies(spark, monkeypatch, bucket):
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    words, rng = [f"word{i}" for i in range(300)], random.Random(2)
    texts = {i: changed(words, set(rng.sample(range(300), 3)), f"own{i}x") for i in range(120)}
    texts |= {i: " ".join(f"alone{i}x{j}" for j in range(50)) for i in range(120, 140)}
    assert grouped_of(spark, texts) == {i: 0 if i < 120 else i for i in texts}


def test_nearest_forest_connects_as_all_pairs_for_any_limit():
    rng = random.Random(4)
    for n in (1, 2, 3, 30):
        marks = np.full((n, simhash.PRINTS), rng.getrandbits(64), np.uint64)
        for row in marks:
            for bit in rng.sample(range(512), rng.randrange(120)):
                row[bit // 64] ^= np.uint64(1 << bit % 64)
        apart = {(i, j): int(np.bitwise_count(marks[i] ^ marks[j]).sum()) for i, j in itertools.combinations(range(n), 2)}
        forest = simhash.nearest_forest(marks, 154)

        def grouped(pairs):
            kin = list(range(n))
            for i, j in pairs:
                x, y = sorted((kin[i], kin[j]))
                kin = [x if k == y else k for k in kin]
            return kin

        for limit in (154, 110, 60):
            assert grouped(p for p in forest if apart[min(p), max(p)] <= limit) == grouped(p for p, d in apart.items() if d <= limit)


def test_forests_go_on_over_batches():
    rng = np.random.default_rng(0)
    key, ids = np.array([1, 1, 2, 2, 2, 2, 7, 7]), np.arange(8)
    marks = np.repeat(rng.integers(0, 2 ** 62, (8, 1)), simhash.PRINTS, 1)
    marks[1], marks[3:6], marks[7] = marks[0], marks[2], marks[6]
    rows = pa.RecordBatch.from_arrays([pa.array(key), pa.array(ids), pa.array(marks.tolist(), pa.list_(pa.int64()))], ["key", "id", "order"])
    whole, cut = ({(r["a"], r["b"]) for out in simhash._forests(rows.slice(at, size) for at in range(0, 8, size)) for r in out.to_pylist()} for size in (8, 3))
    assert whole == cut and len(whole) == 5
    assert not list(simhash._forests(iter([])))


@pytest.mark.parametrize("size", [1, 3, 7, 100])
def test_blocks_of_a_full_bucket_overlap(monkeypatch, size):
    monkeypatch.setattr(simhash, "BUCKET", 8)
    marks = np.array([[(1 << i) - 1] * simhash.PRINTS for i in range(50)], np.int64)  # 8 bits apart from one to the next
    rows = pa.RecordBatch.from_arrays([pa.array(np.full(50, 3)), pa.array(np.arange(50)), pa.array(marks.tolist(), pa.list_(pa.int64()))],
                                      ["key", "id", "order"])
    found = {(r["a"], r["b"]) for out in simhash._forests(rows.slice(at, size) for at in range(0, 50, size)) for r in out.to_pylist()}
    assert found == {(i, i + 1) for i in range(49)}


def swapped(words, places):
    out = list(words)
    for p in places:
        out[p], out[p + 1] = out[p + 1], out[p]
    return " ".join(out)


@pytest.mark.parametrize("bucket", [2048, 2])
def test_a_failed_link_hides_no_other(spark, monkeypatch, bucket):
    """Three texts with one set of words, all in one bucket of each table: 0 and 1 are alike, 2 is just below the limit to both."""
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    texts = {}
    for i in range(0, 120, 3):
        words, places = [f"t{i}w{j}" for j in range(400)], list(range(10, 400, 18))
        texts[i], texts[i + 1], texts[i + 2] = (swapped(words, places[at:end]) for at, end in ((0, 6), (6, 13), (13, 21)))
    sets = {i: shingles(t) for i, t in texts.items()}
    near = {(i % 3, j % 3) for i, j in itertools.combinations(texts, 2) if len(sets[i] & sets[j]) >= 0.8 * (len(sets[i]) * len(sets[j])) ** .5}
    assert near == {(0, 1)}
    assert grouped_of(spark, texts) == {i: i - (i % 3 == 1) for i in texts}


@pytest.mark.parametrize("block, texts", [(1 << 18, 1024), (60, 1024), (1 << 18, 3)])
def test_links_of_a_group_as_brute_force(spark, monkeypatch, block, texts):
    """Whatever the blocks; repeated ids link what each of their texts links, an empty set links nothing."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "TEXTS", texts)
    rng, rows = random.Random(6), [(90, []), (91, []), (5, [1, 2, 3])]
    for i in range(30):
        base = rows[-1][1] if i % 4 else [rng.randrange(-2 ** 63, 2 ** 63) for _ in range(rng.choice([5, 20, 40]))]
        rows.append((i, sorted({x for x in base if rng.random() > 0.08} | {rng.randrange(10 ** 6) for _ in range(rng.choice([0, 1, 2]))})))
    sets = spark.createDataFrame(rows, "id bigint, s array<bigint>")
    groups = spark.createDataFrame([(i, i % 2) for i in {r[0] for r in rows}], "node bigint, component bigint")
    want, kin = {i: {i} for i, _ in rows}, {i: i for i, _ in rows}
    for (i, s), (j, t) in itertools.combinations(rows, 2):
        both = len(set(s) & set(t))
        if i % 2 == j % 2 and both and both >= 0.8 * (len(s) * len(t)) ** .5:
            old, new = max(kin[i], kin[j]), min(kin[i], kin[j])
            kin = {x: new if c == old else c for x, c in kin.items()}
    stage = written(spark, "t")
    found = {r.node: r.component for r in simhash.connected_components(simhash._alike(sets, groups, stage, 0.8), stage).collect()}
    assert {i: found.get(i, i) for i in kin} == kin and len(set(kin.values())) < len(kin) - 10


def test_every_two_texts_of_a_full_bucket_share_a_group(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET", 6)
    members = spark.createDataFrame([(7, i, 20) for i in range(20)] + [(8, i, 9) for i in range(9)], "key bigint, id bigint, size bigint")
    groups = {}
    for r in simhash._in_blocks(members).collect():
        groups.setdefault(r.key, set()).add(r.id)
    pairs = {p for g in groups.values() for p in itertools.combinations(sorted(g), 2)}
    assert pairs == set(itertools.combinations(range(20), 2)) and max(map(len, groups.values())) <= 6

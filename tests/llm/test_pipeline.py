"""Every pipeline stage against brute force on its own input, and the whole run."""

from __future__ import annotations

import itertools
from collections import Counter

import corpus_pipeline as pipeline
import duckdb
import public_tokenizers
import pytest
import tiktoken
from test_simhash import shingles
from test_substring import plain

from forecourt.llm import bpe, oracle, quality
from conftest import SF


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_quality_stage(spark, documents):
    scored = quality.score(documents, spark.read.parquet(f"{SF}/labels.parquet"))
    kept = pipeline.quality_stage(spark, documents, SF)
    assert kept.columns == documents.columns
    assert texts(kept) == texts(scored.where("keep")) and 0 < kept.count() < documents.count()


def test_near_duplicate_stage(spark, documents):
    out = pipeline.near_duplicate_stage(spark, documents, SF)
    sets = {i: shingles(t) for i, t in texts(documents).items()}
    kin = {i: i for i in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * (len(sets[a]) * len(sets[b])) ** .5 > 0:
            old, new = max(kin[a], kin[b]), min(kin[a], kin[b])
            kin = {i: new if c == old else c for i, c in kin.items()}
    assert out.columns == documents.columns and set(texts(out)) == set(kin.values())


def test_substring_stage(spark, documents):
    out = pipeline.substring_stage(spark, documents, SF)
    before = texts(documents)
    want = {i: (kept if removed else before[i]) for i, (n, removed, kept) in plain(list(before.items()), 20).items()
            if not removed or removed < n}
    assert out.columns == documents.columns and texts(out) == want
    assert all(r.n_chars == len(r.text) for r in out.collect() if r.text != before[r.doc_id])


def test_mixing_stage(spark, documents):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = Counter(r[0] for r in con.execute(f"SELECT doc_id FROM ({oracle.OP4})").fetchall())
    out = pipeline.mixing_stage(spark, documents, SF)
    assert out.columns == documents.columns and Counter(r.doc_id for r in out.select("doc_id").collect()) == want


def test_token_stage_and_odd_rows(spark, documents):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, special_tokens={},
                                mergeable_ranks=bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    before = texts(documents)
    for r in pipeline.token_stage(spark, documents, SF).collect():
        assert r.decodes and r.n_tokens == len(library.encode_ordinary(before[r.doc_id] or ""))
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0)], documents.schema)
    for _, stage in pipeline.STAGES:
        assert stage(spark, odd, SF).count() <= 3
        assert stage(spark, odd.limit(0), SF).count() == 0


def test_run_is_the_stages_one_after_another(spark, documents):
    docs = documents
    for i, (_, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, SF)
        if i + 1 < len(pipeline.STAGES):
            assert docs.columns == documents.columns
    key = ["doc_id", "n_tokens", "ids_sha256"]
    assert Counter(map(tuple, docs.select(key).collect())) == Counter(map(tuple, pipeline.run(spark, SF).select(key).collect()))

"""Byte-level BPE against the tiktoken library, and back to the bytes."""

from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from forecourt.llm import bpe, queries
from conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = ["", None, "Hello world", "  two  spaces \n\n\tend  ", "ÄÖß naïve Ñandú 東京 🙂🙂", "a" * 20_000, " " * 3_000,
         "0123456789" * 500, "it's WE'LL don't", "\x00\x1c\x85 ﻿", "<|endoftext|>", "é" * 400]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH),
                             special_tokens={})


def test_perfect_hash_is_minimal_and_knows_strangers():
    ranks = bpe.read_ranks(PATH)
    vocabulary = bpe.Vocabulary(ranks)
    assert sorted(vocabulary.hash.slot(t) for t in ranks) == list(range(len(ranks)))
    assert all(vocabulary.rank(t) == r for t, r in ranks.items())
    assert vocabulary.rank(b"no such token") is None
    assert bpe.PerfectHash([b"only"]).slot(b"only") == 0


def test_texts_as_the_library(spark, library):
    codec = bpe.BytePairCodec(spark, PATH, public_tokenizers.PATTERN)
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string").repartition(3)
    out = {r.doc_id: r for r in bpe.round_trip(rows, codec).collect()}
    ids = {r.doc_id: r for r in bpe.encode_documents(rows, codec).withColumn("back", codec.decode("ids")).collect()}
    for i, text in enumerate(TEXTS):
        want = library.encode_ordinary(text or "")
        assert ids[i].ids == want and ids[i].n_tokens == out[i].n_tokens == len(want)
        assert bytes(out[i].packed) == np.array(want, dtype="<u4").tobytes()
        assert bytes(out[i].decoded) == bytes(ids[i].back) == (text or "").encode() and out[i].text == text


def test_empty_table_and_extra_columns(spark):
    codec = bpe.BytePairCodec(spark, PATH, public_tokenizers.PATTERN)
    rows = spark.createDataFrame([(1, "x y", "old", [7])], "doc_id bigint, text string, decoded string, ids array<int>")
    assert bpe.round_trip(rows, codec).first().n_tokens == 2 and bpe.encode_documents(rows, codec).first().ids != [7]
    assert bpe.round_trip(rows.limit(0), codec).count() == 0
    assert spark.sql("select cast(null as array<int>) as ids").select(codec.decode("ids").alias("b")).first().b == b""


def test_whole_query_against_the_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    out = {r.doc_id: r for r in queries.byte_bpe(spark, SF).collect()}
    assert len(out) == len(rows)
    for doc_id, text in rows:
        ids = library.encode_ordinary(text or "")
        assert out[doc_id].n_tokens == len(ids)
        assert out[doc_id].ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert out[doc_id].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()

"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm import bpe, bwt, caps, dialogue, langid, layout, mixing, oracle, quality, simhash, substring, vafile, warc, whitening
from forecourt.llm.stages import new_folder, written

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    archives = new_folder(spark, "archives")
    manifest = warc.write_archives(table(spark, folder, "pages"), archives, written(spark, "warc"))
    return warc.read_archives(spark, archives, manifest) \
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    codec = bpe.BytePairCodec(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = bpe.round_trip(table(spark, folder, "documents").select("doc_id", "text"), codec)
    return coded.select("doc_id", "n_tokens", F.sha2("packed", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substring.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


def source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    stage = written(spark, "mixing")
    counted = stage("counted", table(spark, folder, "documents").select("doc_id", "source", mixing.word_count().alias("n_tokens")))
    return mixing.mixed(counted, stage)


def quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    scored = quality.score(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select("doc_id", "content_score", "page_score", "score", "keep")


def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = bwt.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return caps.near_duplicates(table(spark, folder, "embeddings"), written(spark, "caps"))


def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = vafile.integer_vectors(table(spark, folder, "embeddings"))
    file = vafile.approximate(vectors, written(spark, "vectors"))
    return vafile.top_k(file, file.exact.where("vec_id % 100 = 0").select("vec_id", "v"), 10)


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return layout.extract(table(spark, folder, "pages")).select("page_id", "url", "text")


def simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = simhash.near_duplicates(documents, written(spark, "simhash"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    white = whitening.whiten(table(spark, folder, "embeddings"), written(spark, "whitening"))
    return white.withColumn("deviation", F.col("deviation").cast("bigint"))


def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    repaired = dialogue.repair(dialogue.damage(table(spark, folder, "conversations")))
    return dialogue.digests(repaired).select("conv_id", "report.*", "repaired_sha256")


def language_id(spark: SparkSession, folder: str) -> DataFrame:
    named = langid.identify(table(spark, folder, "documents"), written(spark, "languages"))
    return named.select("doc_id", "held_out", "lang_pred", "score")


QUERIES: dict[str, Query] = {
    "op1_warc_archives": warc_archives,
    "op2_byte_bpe": byte_bpe,
    "op3_substring_dedup": substring_dedup,
    "op4_source_mixing": source_mixing,
    "op5_suffix_dedup": suffix_dedup,
    "op6_embedding_near_dedup": embedding_near_dedup,
    "op7_quality_classifier": quality_classifier,
    "op8_exact_top_k": exact_top_k,
    "op9_html_extraction": html_extraction,
    "op10_simhash_near_dedup": simhash_near_dedup,
    "op11_embedding_whitening": embedding_whitening,
    "op12_conversation_repair": conversation_repair,
    "op13_language_id": language_id,
    "pipeline": corpus_pipeline.run,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**oracle.SQL, **whole}

"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from orestack.llm import (ann_codes, decontaminate, fill_middle, language, line_dedup, mixing, ngram_join, quality, simhash,
                          suffix_dedup, token_counts, warc, whitening)
from orestack.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_ann_codes(spark: SparkSession, folder: str) -> DataFrame:
    return ann_codes.search(table(spark, folder, "embeddings"), "vec_id", "embedding", F.col("id") % 20 == 0, k=20)


def op2_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op3_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.dedup(table(spark, folder, "documents"))
    # A cut may part the bytes of a code point.
    return found.withColumn("kept_text", F.make_valid_utf8(F.col("kept").cast("string"))).drop("kept")


def op4_token_counts(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.count_tokens(table(spark, folder, "documents").select("doc_id", "text"), vocabulary)


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = line_dedup.dedup(table(spark, folder, "documents").select("doc_id", "text"))
    return docs.select("doc_id", "lines_in", "lines_removed", F.md5("text").alias("kept_md5"))


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.archive(table(spark, folder, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.taken(table(spark, folder, "documents"))


def op8_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    filters = language.train(docs.filter(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                        language.predict(F.col("text"), filters).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.groups(table(spark, folder, "documents"), shingle=3, distance=3)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    field = quality.train(docs, table(spark, folder, "labels").filter(~held_out(F.col("doc_id"))))
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                         quality.score(F.col("text"), field).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= quality.THRESHOLD).cast("int"))


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    found = whitening.whiten(table(spark, folder, "embeddings"), count=16)
    return found.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op12_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fill_middle.digests(table(spark, folder, "documents"))


def op13_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join(table(spark, folder, "documents"), width=5, percent=80)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_ann_codes, op2_decontaminate, op3_suffix_dedup, op4_token_counts, op5_line_dedup, op6_warc, op7_mixing,
        op8_language, op9_simhash, op10_quality, op11_whitening, op12_fill_middle, op13_ngram_join)}

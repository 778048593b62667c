"""The corpus pipeline: five stages from raw documents to a weighted mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from orestack.llm import common, decontaminate, line_dedup, mixing, quality, simhash


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field rates as good; fitted on labelled documents outside the evaluation fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~common.held_out(F.col("doc_id")))
    score = common.unused(docs, "score")
    rated = docs.withColumn(score, quality.score(F.col("text"), quality.train(docs, labels)))
    return rated.filter(F.col(score) >= quality.THRESHOLD).drop(score)


def remove_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the runs of lines that repeat earlier ones; ``n_chars`` follows the text."""
    lines, removed = (common.unused(docs, name) for name in ("lines_in", "lines_removed"))
    left = line_dedup.dedup(docs, counts=(lines, removed))
    return left.withColumn("n_chars", F.when(F.col(removed) > 0, F.length("text").cast("long")).otherwise(
        F.col("n_chars"))).drop(lines, removed)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of three-word shingle fingerprints at most three bits apart."""
    return simhash.one_of_each(docs, shingle=3, distance=3)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a verified overlap with a benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, and its pieces: slot of the mix, words before it in the document, words."""
    return mixing.taken(docs, pieces=True)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", remove_lines),
    ("SimHash near-dedup", keep_one_of_each),
    ("benchmark decontamination", remove_benchmark),
    ("mixing sources to target weights", mix_sources),
]

# Trained weights, hashes and iterated links are beyond SQL; the whole run is tested against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = common.saved(docs, f"pipeline-{i}")
    return docs

"""Corpus pipeline: quality filter, near-duplicates, decontamination, secret redaction, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chosen_path, decontaminate, packing, quality, secrets
from tidemark.llm._base import cut, read


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject (score under 0.3); it is fitted on the labels of its input.
    Null and empty texts are scored as empty; an empty table stays empty."""
    model = quality.fit_quality(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality.quality_score(model, F.col("text")) >= 0.3)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group: that of the smallest id (shingles of five words, similarity 0.8). Rows
    that repeat an id, or have none, are documents like all others; null and empty texts stay."""
    return chosen_path.keep_one(docs, width=5, cents=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word window of a benchmark text occurs; null and empty texts stay, whatever their id."""
    found = decontaminate.contamination(docs, read(spark, sf_dir, "benchmark"), keep=tuple(docs.columns))
    return found.where("not contaminated").select("row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; n_chars follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else clean


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence of 2048 tokens; a null text is one end token."""
    return packing.pack(docs, "byte_bpe_50k.json", 2048)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("secrets", redact_secrets),
    ("pack", pack_sequences),
]

#: Learned scores, decoding and tokenisation are beyond SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), name)
    return docs

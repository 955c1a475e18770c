"""Bounded samples of labelled documents to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._base import is_held_out


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int, per_class: bool = False) -> DataFrame:
    """(doc_id, text, label) of at most `most` labelled rows that aren't held out, the first by a hash of doc_id.

    per_class: up to `most` of each class. Rows with a null id or label, and labels without a document, are left out;
    of repeated labels of an id the largest counts, of repeated documents the least text (null first).
    """
    rows = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label is not null")
    rows = rows.where(~is_held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("label").alias("label")).join(docs.select("doc_id"), "doc_id", "left_semi")
    first = lambda d: d.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    picked = first(rows.where("label = 1")).union(first(rows.where("label = 0"))) if per_class else first(rows)
    # at most `most` rows a class
    found = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min(F.struct("text"))["text"].alias("text")).select("doc_id", "text", "label")

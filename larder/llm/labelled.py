"""Labelled training rows and fold marks shared by the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str = "doc_id", folds: int = 4) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string")), F.lit(folds))


def held_out(doc_id: str = "doc_id", folds: int = 4, out: int = 2) -> Column:
    return F.coalesce(fold(doc_id, folds) == out, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(text, label) of at most ``bound`` labelled ids outside the held-out
    fold, chosen by a hash of the id; of rows that repeat an id, one (with the
    smallest hash of its text). The bound holds for the rows returned and makes
    the broadcast safe."""
    some = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out())
            .groupBy("doc_id").agg(F.max(F.col(label).cast("int")).alias("label"))
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound))
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    return rows.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"),
                                      F.max("label").alias("label")).select("text", "label")

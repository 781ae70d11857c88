"""Training corpus from raw documents, in five stages.

Every stage reads what the one before it wrote and calls one operator of
``larder.llm``; all but the last return the columns of ``documents``. Extra
columns pass through all filtering stages untouched, whatever their names.

Defined results: null texts count as empty (they fail the quality rules); rows
without an id stay rows of their own until the near-duplicate stage, which
keeps one row of each class and prefers the smallest id; an empty table passes
through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm import decontaminate, packing, quality_rules, simhash, toxicity
from larder.llm.common import prepare_python, saved, table
from larder.llm.tokens import tokenizer_path
from larder.session import ensure_checkpoint_dir


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    prepare_python(spark)
    return docs.filter(toxicity.score_column(model, F.col("text")) < toxicity.THRESHOLD)


def with_good_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without their failing lines."""
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), F.col("text").alias("text"))
    kept = quality_rules.apply_quality_rules(rows).filter("kept")
    new = {"text": F.col("clean_text"), "n_chars": F.length("clean_text").cast("long")}
    return kept.select(*[(new[c] if c in new else F.col("_doc").getField(c)).alias(c) for c in docs.columns])


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every near-duplicate class."""
    return simhash.drop_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    key = simhash.row_key()
    found = decontaminate.overlaps(docs.select(key.alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    bad = found.select(F.col("doc_id").alias("_bad")).distinct()
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), key.alias("_key"))
    return (rows.join(bad, F.col("_key") == F.col("_bad"), "left_anti")
            .select(*[F.col("_doc").getField(c).alias(c) for c in docs.columns]))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all token pieces in sequences of the model's length."""
    return packing.pack_documents(docs, tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", without_toxic),
    ("quality_rules", with_good_lines),
    ("simhash_near_dedup", without_copies),
    ("decontamination", without_benchmark),
    ("best_fit_packing", packed),
]

#: No SQL can express the classifier, the fingerprints and the tokenizer; the
#: stages are tested against brute force in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is written and read again."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

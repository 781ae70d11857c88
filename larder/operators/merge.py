"""Incremental upsert on plain Parquet tables partitioned by day.

``merge_upsert`` is the lazy row-level result (target rows whose key is not
in the updates, plus all updates). ``write_incremental`` publishes it while
rewriting only the day partitions that change:

1. the updates are staged in the shared checkpoint folder (lineage cut; the
   staged copy is deleted at the end);
2. touched days = days of the updates + days that hold (or held, since the last
   full refresh) one of their keys, by the table's key-to-day index (a key
   whose day moved leaves its old partition). The target is not read for this,
   and new places are added to the index before anything is published;
3. the rows of the touched days, read from their partitions alone, are merged and
   written beside the table (``pending``: whole days, and the list of days);
4. Spark's dynamic partition overwrite puts these days in place, days left without
   rows are dropped, and the pending copy is deleted. A crash before step 4
   changes nothing; the write after a crash in step 4 first repeats that step from
   the pending copy (whole days, so repeating it is harmless). A null day is a day like others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.key_index import KeyIndex, index_entry, pairs
from larder.operators.sinks import (current_folder, delete_paths, drop_partitions, new_folder, path_exists,
                                    read_table, replace_partitions, switch, write_rows)
from larder.session import scratch_path


class DuplicateKeyError(ValueError):
    pass


def merge_upsert(target: DataFrame, updates: DataFrame, key: str = "surrogate_key") -> DataFrame:
    """Update-all-columns when matched, insert when not matched.

    Rows with a null key never match (SQL equality), so they are inserted."""
    kept = target.join(updates.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def assert_unique_keys(updates: DataFrame, key: str) -> None:
    dup = (updates.where(F.col(key).isNotNull()).groupBy(key).count()
                  .where(F.col("count") > 1).limit(1).collect())
    if dup:
        raise DuplicateKeyError(f"duplicate {key} in updates: {dup[0][key]!r}")


def write_incremental(spark: SparkSession, updates: DataFrame, path: str,
                      key: str = "surrogate_key", partition_col: str = "order_date",
                      cluster_by: list | None = None, replace: bool = False) -> dict:
    """Create the table from ``updates`` on the first run (or when
    ``replace``: a full refresh), else upsert. Returns what was written.
    Duplicate keys in merge updates raise ``DuplicateKeyError``."""
    folder = current_folder(spark, path)
    if replace or folder is None:
        # Full build: key uniqueness is checked by the table's declared
        # unique test after publishing, not by a second pass here.
        folder = new_folder(path)
        write_rows(updates, folder, partition_col, cluster_by)
        KeyIndex.build(_rows(spark, folder, updates), folder, key, partition_col)
        switch(spark, path, folder)
        return {"mode": "create", "touched_partitions": None}

    publish_pending(spark, folder, updates, partition_col, cluster_by)  # left by a crash, if any
    scratch = scratch_path(spark, f"merge-updates-{uuid.uuid4().hex}")
    try:
        # Computed once: every later step reads the staged copy.
        updates.write.parquet(scratch)
        staged = spark.read.schema(updates.schema).parquet(scratch)
        assert_unique_keys(staged, key)
        entry = index_entry(spark, folder)
        if entry is None:  # published without an index
            index = KeyIndex.build(read_table(spark, path), folder, key, partition_col)
        else:
            index = KeyIndex(spark, folder, entry, updates.schema[partition_col].dataType.simpleString())
        # Days only (bounded by the number of days touched); null is a day too.
        touched = {r[0] for r in staged.select(partition_col).distinct().collect()}
        if not touched:
            return {"mode": "merge", "touched_partitions": 0}
        touched |= set(index.record(pairs(staged, key, partition_col)))
        day = F.col(partition_col)
        held = _rows(spark, folder, updates).where(day.isin([d for d in touched if d is not None]) | (
            day.isNull() if None in touched else F.lit(False)))
        stage_pending(merge_upsert(held, staged, key), folder, partition_col, touched)
    finally:
        delete_paths(spark, [scratch])
    return {"mode": "merge", **publish_pending(spark, folder, updates, partition_col, cluster_by)}


def _rows(spark: SparkSession, folder: str, like: DataFrame) -> DataFrame:
    return spark.read.schema(like.schema).parquet(f"{folder}/rows")


def stage_pending(rows: DataFrame, folder: str, partition_col: str, days: set) -> None:
    """Whole days to be published, and which days these are."""
    spark, pending = rows.sparkSession, f"{folder}/pending"
    schema = f"{partition_col} {rows.schema[partition_col].dataType.simpleString()}"
    spark.createDataFrame([(d,) for d in days], schema).write.mode("overwrite").parquet(f"{pending}/days")
    rows.write.mode("overwrite").parquet(f"{pending}/rows")


def publish_pending(spark: SparkSession, folder: str, like: DataFrame, partition_col: str,
                    cluster_by: list | None) -> dict:
    """Put the pending days in place, if there are complete ones."""
    pending = f"{folder}/pending"
    if not path_exists(spark, f"{pending}/rows/_SUCCESS"):
        return {}
    rows = spark.read.schema(like.schema).parquet(f"{pending}/rows")
    days = {r[0] for r in spark.read.parquet(f"{pending}/days").collect()}
    present = {r[0] for r in rows.select(partition_col).distinct().collect()}
    replace_partitions(rows, folder, partition_col, cluster_by)
    # A stale pair of the index names a day that the table does not hold.
    emptied = drop_partitions(spark, folder, partition_col, sorted(days - present, key=str))
    delete_paths(spark, [pending])
    return {"touched_partitions": len(present) + emptied, "emptied_partitions": emptied}

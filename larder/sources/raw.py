"""Raw-source scans and database helpers."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.session import shuffles_freed
from larder.sources.schemas import RAW_SCHEMAS, RUN_LOG_SCHEMA

# Join / grouping key each raw table is bucketed on when landed in the
# catalog. Orders and their lines share order_id and the bucket count, so
# the line aggregate per order and the line-to-order join need no shuffle.
RAW_BUCKET_KEYS = {
    "orders": "order_id",
    "order_items": "order_id",
    "products": "product_id",
    "customers": "customer_id",
    "inventory": "product_id",
    "promotions": None,
}

# Day column that splits a landed table into partitions: queries of one snapshot
# open only that day's files.
RAW_PARTITIONS = {"inventory": "snapshot_date"}


#: Keys looked at for hot ones, and items the frequency sketch tracks.
TOP_KEYS = 256
SKETCH_ITEMS = 10_000
#: Table property: files of hot keys beside the one of each bucket.
HOT_FILES = "larder.hot_files"


#: Landed files are packed tighter than Spark's default (snappy): read more often than
#: written, they stay for the whole session.
CODEC = "zstd"


@dataclass(frozen=True)
class Derived:
    """A raw table as expressions over the rows of narrower files. Landing moves those
    rows, not the wider ones made of them. ``fan_out`` (rows of the files to rows
    of the table) adds columns and rows, none that the key needs."""
    rows: DataFrame
    columns: dict[str, Column]
    fan_out: Callable[[DataFrame], DataFrame] | None = None

    def table(self, rows: DataFrame) -> DataFrame:
        made = self.fan_out(rows) if self.fan_out else rows
        return made.select(*[c.alias(n) for n, c in self.columns.items()])


def read_raw(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Scan one raw table from ``<root>/<name>`` (Parquet) with its fixed
    schema, or from the catalog when ``root`` is a database name prefixed
    with ``table:``.

    A bucketed scan reads a bucket in one task, whatever its size. Where
    landing found hot keys, the table's files are read without the buckets
    instead: even splits, and a shuffle where the key is needed."""
    if root.startswith("table:"):
        full = f"{root[len('table:'):]}.{name}"
        found = spark.sql(f"SHOW TBLPROPERTIES {full} ('{HOT_FILES}')").first()
        if found is None or not found[1].isdigit() or found[1] == "0":
            return spark.table(full)
        where = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {full}").collect()}["Location"]
        return spark.read.schema(RAW_SCHEMAS[name]).parquet(where)
    return spark.read.schema(RAW_SCHEMAS[name]).parquet(f"{root.rstrip('/')}/{name}")


def ensure_db(spark: SparkSession, db: str, location: str | None = None) -> None:
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{loc}")


def hot_keys(df: DataFrame, key: str, buckets: int) -> list[tuple]:
    """[(key, files)] of the keys (null too) that hold more rows than an average
    bucket, by a frequency sketch over the key column: how many files of about
    the size of the other buckets their rows need. At most ``TOP_KEYS`` + 1 items reach the driver;
    every key beyond them is smaller than an average bucket if there are fewer
    buckets than that, else smaller than the smallest one listed."""
    total, nulls, top = df.agg(
        F.count(F.lit(1)), F.count_if(F.col(key).isNull()),
        F.expr(f"approx_top_k({key}, {TOP_KEYS}, {SKETCH_ITEMS})")).first()
    share = max(1, -(-total // buckets))
    counts = [(None, nulls)] + [(t["item"], t["count"]) for t in top or [] if t["item"] is not None]
    hot = [(k, n) for k, n in counts if n > share]
    # Files as large as the other keys' buckets, but no more than four times as many.
    size = max(-(-(total - sum(n for _, n in hot)) // buckets), -(-total // (4 * buckets)), 1)
    return [(k, -(-n // size)) for k, n in hot]


def spread(df: DataFrame, key: Column, buckets: int, hot: list[tuple]) -> DataFrame:
    """One partition for each bucket, and for each hot key as many of its own as
    it needs: every task writes files of about one size. Rows of a hot key are
    dealt by a hash of the row and its input split, the same in a repeated task."""
    if not hot:
        return df.repartition(buckets, key)
    at = F.pmod(F.hash(key), F.lit(buckets))
    salt = F.xxhash64(*df.columns, F.spark_partition_id())
    n = buckets
    for value, files in hot:
        is_hot = key.isNull() if value is None else key.eqNullSafe(F.lit(value))
        at = F.when(is_hot, F.lit(n) + F.pmod(salt, F.lit(files)).cast("int")).otherwise(at)
        n += files
    return df.repartitionById(n, at)


def land_raw_tables(spark: SparkSession, raw: dict, db: str, buckets: int,
                    location: str | None = None) -> dict:
    """Truncate-and-load the raw tables into catalog tables of ``db``,
    bucketed (and sorted) on their keys; returns the rows loaded per table,
    counted while writing. With ``location`` the data files live under that
    folder (e.g. the shared checkpoint folder).

    A key (or null) with more rows than an average bucket gets files of its own
    within its bucket, so no task writes much more than another. The tables are
    loaded side by side: a small one, with few input splits, leaves no core idle.
    The shuffle of a table is deleted as soon as the table is loaded."""
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import inheritable_thread_target
    ensure_db(spark, db, location)
    load = inheritable_thread_target(spark)(
        lambda name: _land_table(spark, name, raw[name], db, buckets, location))
    with shuffles_freed(spark), ThreadPoolExecutor(max_workers=len(raw) or 1) as pool:
        loads = {name: pool.submit(load, name) for name in raw}
    return {name: f.result() for name, f in loads.items()}


def _land_table(spark: SparkSession, name: str, raw: DataFrame | Derived, db: str, buckets: int,
                location: str | None) -> int:
    from pyspark.sql import Observation
    obs = Observation(f"land_{db}_{name}")
    key = RAW_BUCKET_KEYS.get(name)
    rows, table = (raw.rows, raw.table) if isinstance(raw, Derived) else (raw, lambda moved: moved)
    hot = hot_keys(table(rows), key, buckets) if key else []
    if key:
        # Partitioned on the bucket first: each task then writes exactly
        # one bucket file, all buckets in parallel.
        rows = spread(rows, raw.columns[key] if isinstance(raw, Derived) else F.col(key), buckets, hot)
    df = table(rows).observe(obs, F.count(F.lit(1)).alias("rows"))
    w = df.write.mode("overwrite").format("parquet").option("compression", CODEC)
    if name in RAW_PARTITIONS:
        w = w.partitionBy(RAW_PARTITIONS[name])
    if key:
        w = w.bucketBy(buckets, key).sortBy(key)
    if location:
        w = w.option("path", f"{location.rstrip('/')}/{name}")
    w.saveAsTable(f"{db}.{name}")
    spark.sql(f"ALTER TABLE {db}.{name} SET TBLPROPERTIES ('{HOT_FILES}' = '{sum(n for _, n in hot)}')")
    return int(obs.get["rows"])


def table_name(layer: str, target: str, name: str, project: str = "larder") -> str:
    """``<project>_<target>_<layer>.<name>``: one database per layer and target."""
    return f"{project}_{target}_{layer}.{name}"


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Run-result JSON documents (one per run) -> one row per node result:
    run_id, elapsed_time, status, unique_id."""
    doc = spark.read.schema(RUN_LOG_SCHEMA).option("multiLine", True).json(path)
    if "run_id" not in doc.columns:
        doc = doc.withColumn("run_id", F.input_file_name())
    doc = doc.withColumn("run_id", F.coalesce("run_id", F.input_file_name()))
    return (doc.select("run_id", "elapsed_time", F.explode_outer("results").alias("r"))
            .select("run_id", "elapsed_time", F.col("r.status").alias("status"),
                    F.col("r.unique_id").alias("unique_id")))

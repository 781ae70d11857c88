"""Helpers shared by the operators: tables, shared scratch, ranks, let-binding."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.session import scratch_path

#: White space that separates words everywhere in this subpackage (ASCII).
SPACES = r"[\x20\x09-\x0D]+"

_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_path(spark: SparkSession, label: str) -> str:
    """A fresh folder below spark.checkpoint.dir, visible to all executors."""
    return scratch_path(spark, f"{label}-{uuid.uuid4().hex}")


def saved(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh shared folder and read it back: cuts the lineage
    with a copy that survives any lost executor."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it any number of times in
    ``body`` (a one-element transform; the optimizer never copies a lambda
    variable, unlike an aliased column)."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words of a text (null: none) as an array of strings."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


#: Rows of a batch in which whole texts are scanned.
SCAN_ROWS = 256


def scan_in_small_batches(spark: SparkSession) -> None:
    """Parquet scans decode ``SCAN_ROWS`` rows at a time, not Spark's 4,096: a task's
    buffers then hold some hundred whole texts, however long, not thousands."""
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(SCAN_ROWS))


def prepare_python(spark: SparkSession, rows: int = 250) -> None:
    """Make the package importable in Python workers and keep Arrow batches at
    ``rows`` rows: with whole texts in a column a task then holds a few MB of
    them at a time; bounded results reach the driver as Arrow columns, not as
    row objects. The package goes out once per application, as a zip file
    that the driver hands to the executors (like ``--py-files``)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.join(tempfile.mkdtemp(prefix="larder-zip-"), "larder_package.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(package):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)


def publish_file(store, own: str, final: str) -> None:
    """Put a finished file in its place; a repeated task replaces its own by one
    rename. Only stores that refuse to rename onto a file delete it before."""
    from pyarrow import fs
    try:
        store.move(own, final)
    except OSError:
        if store.get_file_info(final).type == fs.FileType.NotFound:
            raise
        store.delete_file(final)
        store.move(own, final)


def with_rank(df: DataFrame, keys: list[str], bucket: Column, order: list[Column],
              name: str = "rank", weight: Column | None = None) -> DataFrame:
    """Exact 0-based rank of every row within ``keys`` (or the sum of
    ``weight`` over the rows before it), without gathering a key in one task.

    Rows of a key are dealt over the values of ``bucket``; the bucket totals (at
    most keys x buckets rows) give each bucket its offset, and a window numbers
    the rows inside a bucket by ``order``. The rank follows a total order of the
    key's rows: by bucket, then by ``order``. Keys and buckets are never null."""
    w = F.lit(1).cast("long") if weight is None else weight
    b = df.withColumns({"_bucket": bucket, "_w": w})
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = (Window.partitionBy(*keys, "_bucket").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, -1))
    offsets = (b.groupBy(*keys, "_bucket").agg(F.sum("_w").alias("_n"))
               .withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")))
               .drop("_n"))
    ranked = b.withColumn("_in", F.coalesce(F.sum("_w").over(inside), F.lit(0).cast("long")))
    return (ranked.join(offsets, [*keys, "_bucket"])
            .withColumn(name, F.col("_in") + F.col("_before"))
            .select(*df.columns, name))


def hash_bucket(columns: list, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")

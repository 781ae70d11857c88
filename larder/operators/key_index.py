"""Key-to-day index of a published day-partitioned table.

The index holds a pair (hash of the key, day) for every place where a row of that
key may be. An upsert looks its keys up here, so it finds the rows that leave
their old day without reading the table: the lookup is a join on the hash with
a bucketed table (one shuffle at most, that of the updates; none if they are
small enough to broadcast).

Pairs are appended before the rows they announce are published, and none is
taken out before the next full refresh. The index therefore covers every place at any time, also
after a crash between the two steps; a pair too many only has its day
rewritten. Two keys with one hash do no more harm than that.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.operators.joins import materialize

#: Name prefix of an index folder, beside the rows of its table.
PREFIX = "keys="
#: Rows of a bucket of a new index. A task sorts one bucket, at some 120 bytes a row
#: in memory.
BUCKET_ROWS = 1_000_000
LEAST_BUCKETS = 8


def index_buckets(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


def _register(spark: SparkSession, folder: str, day_type: str) -> str:
    """The catalog table over an index folder; its bucket number is in the name."""
    name = "larder_keys_" + hashlib.sha1(folder.encode()).hexdigest()[:16]
    buckets = int(folder.rsplit("-b", 1)[1])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (h BIGINT, day {day_type}) USING parquet "
              f"CLUSTERED BY (h) INTO {buckets} BUCKETS LOCATION '{folder}'")
    return name


def pairs(rows: DataFrame, key: str, day: str) -> DataFrame:
    """(h, day) of the rows that have a key."""
    return rows.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("h"), F.col(day).alias("day"))


class KeyIndex:
    def __init__(self, spark: SparkSession, data: str, entry: str, day_type: str):
        self.spark, self.entry = spark, entry
        self.folder = f"{data.rstrip('/')}/{entry}"
        self.table = _register(spark, self.folder, day_type)
        self.buckets = int(entry.rsplit("-b", 1)[1])

    @classmethod
    def build(cls, rows: DataFrame, data: str, key: str, day: str) -> KeyIndex:
        """A new index over all of ``rows`` (key and day are read once, keys are
        shuffled into their buckets); one file a bucket."""
        p = pairs(rows, key, day)
        buckets = index_buckets(rows.count())
        out = cls(rows.sparkSession, data, f"{PREFIX}{uuid.uuid4().hex}-b{buckets}", p.schema["day"].dataType.simpleString())
        out.append(p)
        return out

    def append(self, p: DataFrame) -> None:
        p.repartition(self.buckets, "h").sortWithinPartitions("h").write.insertInto(self.table)
        self.spark.catalog.refreshTable(self.table)

    def places(self, p: DataFrame) -> DataFrame:
        """(h, day): every place known for the keys of ``p``."""
        return self.spark.table(self.table).join(p.select("h").distinct(), "h").select("h", "day")

    def record(self, p: DataFrame) -> list:
        """Add the new places of ``p``; returns the days that held its keys
        before (distinct days only reach the driver)."""
        known = materialize(self.places(p), "key-places")
        days = [r[0] for r in known.select("day").distinct().collect()]
        k = known.distinct().select(F.col("h").alias("kh"), F.col("day").alias("kday"))
        new = p.distinct().join(k, (F.col("h") == F.col("kh")) & F.col("day").eqNullSafe(F.col("kday")), "left_anti")
        self.append(new)
        return days


def index_entry(spark: SparkSession, folder: str) -> str | None:
    """The complete index beside a table's rows."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(folder)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = sorted(s.getPath().getName() for s in fs.listStatus(at))
    return next((n for n in names if n.startswith(PREFIX) and fs.exists(hadoop.Path(f"{folder}/{n}/_SUCCESS"))), None)

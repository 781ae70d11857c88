"""Publishing: views, full-refresh tables, clustered partitioned writes."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


#: Folder name of the null partition value (fixed by the file layout).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def register_view(df: DataFrame, name: str) -> DataFrame:
    """View materialisation: a named, lazily evaluated query."""
    df.createOrReplaceTempView(name)
    return df


#: Bits of each column in an interleaved key, and rows sampled for its cuts.
Z_BITS = 6
Z_SAMPLE = 10_000


def _interval(c: Column, cuts: list) -> Column:
    """How many of the ascending ``cuts`` are at most the value, by bisection."""
    def bisect(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c < F.lit(cuts[mid]), bisect(lo, mid)).otherwise(bisect(mid + 1, hi))
    return F.when(c.isNull(), F.lit(0)).otherwise(bisect(0, len(cuts)))


def z_order_key(df: DataFrame, columns: list[str], bits: int = Z_BITS) -> Column:
    """Interleaved key: each column's interval among quantiles of a bounded
    sample (``Z_SAMPLE`` rows at most, by a hash of the row), its bits taken in turn with
    the others'. Files sorted by it are narrow in every column at once. The
    sample places the cuts only; nulls come first."""
    # The rows of the smallest hashes: a top-k by map-side partial results.
    rows = df.select(F.xxhash64(*df.columns).alias("_h"), *columns).orderBy("_h").limit(Z_SAMPLE).collect()
    key = F.lit(0).cast("long")
    for j, name in enumerate(columns):
        values = sorted(r[name] for r in rows if r[name] is not None)
        cuts = sorted({values[len(values) * q // (1 << bits)] for q in range(1, 1 << bits)}) if values else []
        at = _interval(F.col(name), cuts).cast("long")
        for b in range(bits):
            key = key.bitwiseOR(F.shiftleft(F.shiftright(at, b).bitwiseAND(F.lit(1).cast("long")), b * len(columns) + j))
    return key


def cluster_by_z_order(df: DataFrame, columns: list[str], files: int | None = None,
                       tiebreak: list | None = None) -> DataFrame:
    """Range-partitioned and sorted by the interleaved key of ``columns``."""
    keyed = df.withColumn("_z", z_order_key(df, columns))
    order = ["_z", *(tiebreak or [])]
    parts = keyed.repartitionByRange(files, *order) if files else keyed.repartitionByRange(*order)
    return parts.sortWithinPartitions(*order).drop("_z")


def file_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    """Least and largest value of each column in every file of a Parquet table
    (read through the hidden ``_metadata`` column): what a scan can skip by."""
    bounds = [f(c).alias(f"{n}_{c}") for c in columns for f, n in ((F.min, "min"), (F.max, "max"))]
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("rows"), *bounds)


def cluster_for_write(df: DataFrame, partition_col: str | None, cluster_by: list,
                      tiebreak: list | None = None) -> DataFrame:
    """Lay out rows for pruning: rebalance on the partition column (AQE
    splits oversized days into several files and merges tiny ones), then sort
    each file by the clustering columns so Parquet min/max statistics skip
    row groups on filters over them. Unpartitioned tables are range
    partitioned on the clustering columns plus ``tiebreak`` (a unique key),
    so a clustering value held by a third of the rows still spreads over
    several files instead of one."""
    if partition_col:
        df = df.hint("rebalance", partition_col)
        return df.sortWithinPartitions(partition_col, *cluster_by)
    if cluster_by:
        order = list(cluster_by) + list(tiebreak or [])
        return df.repartitionByRange(*order).sortWithinPartitions(*order)
    return df


def write_table(df: DataFrame, path: str, partition_by: str | None = None,
                cluster_by: list | None = None, tiebreak: list | None = None) -> None:
    """Full refresh (SCD type 1): a fresh folder replaces the whole table.
    Readers see the old rows until the new ones are complete."""
    folder = new_folder(path)
    write_rows(df, folder, partition_by, cluster_by, tiebreak)
    switch(df.sparkSession, path, folder)


# ---- published tables -----------------------------------------------------------
# <path>/rows-<id>/rows holds the table's files as Spark writes them, <path>/current
# names the folder that readers use. One writer a table at a time.

def new_folder(path: str) -> str:
    return f"{path.rstrip('/')}/rows-{uuid.uuid4().hex}"


def write_rows(df: DataFrame, folder: str, partition_by: str | None, cluster_by: list | None = None,
               tiebreak: list | None = None) -> None:
    """``df`` as the rows of a folder that no reader knows yet."""
    w = cluster_for_write(df, partition_by, cluster_by or [], tiebreak).write
    # Nothing in a new folder is read before it is complete, so tasks may put
    # their files in place themselves instead of leaving all renames to the driver.
    w = w.option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    (w.partitionBy(partition_by) if partition_by else w).parquet(f"{folder}/rows")


def current_folder(spark: SparkSession, path: str) -> str | None:
    """The folder that readers use, or None without a table."""
    pointer = f"{path.rstrip('/')}/current"
    if not path_exists(spark, pointer):
        return None
    return f"{path.rstrip('/')}/{spark.read.text(pointer).first()[0]}"


def switch(spark: SparkSession, path: str, folder: str) -> None:
    """Make ``folder`` the table, in one rename. The folder it replaces stays for
    open readers; older ones, and those of crashed refreshes, are deleted."""
    root, before = path.rstrip("/"), current_folder(spark, path)
    fs, own = _fs(spark, f"{root}/_next-{uuid.uuid4().hex}")
    out = fs.create(own)
    try:
        out.write(bytearray(folder.rsplit("/", 1)[1].encode()))
    finally:
        out.close()
    _replace(spark, own, f"{root}/current")
    _, at = _fs(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(at)]
    keep = {f.rsplit("/", 1)[1] for f in (folder, before) if f}
    delete_paths(spark, [f"{root}/{n}" for n in names if n.startswith(("rows-", "_next-")) and n not in keep])


def _replace(spark: SparkSession, source, target: str) -> None:
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    hadoop = jvm.org.apache.hadoop.fs
    option = getattr(hadoop, "Options$Rename")
    options = gateway.new_array(option, 1)
    options[0] = option.OVERWRITE
    to = hadoop.Path(target)
    hadoop.FileContext.getFileContext(to.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(source, to, options)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a published table."""
    folder = current_folder(spark, path)
    if folder is None:
        raise FileNotFoundError(f"no table at {path}")
    return spark.read.parquet(f"{folder}/rows")


def replace_partitions(df: DataFrame, folder: str, partition_by: str, cluster_by: list | None = None) -> None:
    """The partitions that ``df`` has rows of take these rows (Spark's dynamic
    partition overwrite); the folder's other partitions are left alone."""
    w = cluster_for_write(df, partition_by, cluster_by or []).write.mode("overwrite")
    w.option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(f"{folder}/rows")


def drop_partitions(spark: SparkSession, folder: str, partition_by: str, values: list) -> int:
    """Delete partitions; returns how many there were."""
    paths = [f"{folder}/rows/{partition_by}={NULL_PARTITION if v is None else v}" for v in values]
    held = [p for p in paths if path_exists(spark, p)]
    delete_paths(spark, held)
    return len(held)


def load_table(df: DataFrame, path: str) -> int:
    """Truncate-and-load; returns the row count observed while writing
    (no second pass over the data)."""
    obs = Observation(f"load_{uuid.uuid4().hex[:8]}")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return int(obs.get["rows"])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _files(spark: SparkSession, paths: list[str]) -> list:
    out = []
    for path in paths:
        fs, p = _fs(spark, path)
        out += [s for s in fs.listStatus(p) if s.isFile()]
    return out


def input_bytes(spark: SparkSession, paths: list[str]) -> int:
    return sum(s.getLen() for s in _files(spark, paths))


def input_mark(spark: SparkSession, paths: list[str]) -> int:
    """Changes when a file of ``paths`` is added, removed or rewritten."""
    return hash(tuple(sorted((s.getPath().toString(), s.getLen(), s.getModificationTime())
                             for s in _files(spark, paths))))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        fs, p = _fs(spark, path)
        if fs.exists(p):
            fs.delete(p, True)

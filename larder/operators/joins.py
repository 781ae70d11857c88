"""Join helpers: null-safe lookup joins, materialized key sets, and
referential checks. Broadcasts are left to the planner's measured sizes."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.session import scratch_path, shuffles_freed

# Prefix of the per-row stand-in for a null join key: no real key starts
# with a NUL character, so the stand-in never matches.
_NULL_SALT = "\u0000"


def lookup_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str,
                salt_col: str, how: str = "left") -> DataFrame:
    """``left`` joined to a lookup table on ``left_key = right_key``.

    The planner broadcasts the lookup if its measured size allows, else both
    sides shuffle. Left rows with a null key (which never match) would then all
    hash to one partition; they get a unique non-matching stand-in key derived
    from ``salt_col`` instead, so they spread evenly. A hot key is left to
    AQE's skew-join splitting."""
    stand_in = F.concat(F.lit(_NULL_SALT), F.col(salt_col).cast("string"))
    lk = "_lookup_key"
    keyed = left.withColumn(lk, F.coalesce(F.col(left_key).cast("string"), stand_in))
    out = keyed.join(right, keyed[lk] == right[right_key].cast("string"), how)
    return out.drop(lk)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back: its
    source is scanned once however many joins use it, and joins see the real
    size of the files, so the planner may broadcast it."""
    return materialize_in_turns([df], name)


def materialize_in_turns(parts: list[DataFrame], name: str) -> DataFrame:
    """The rows of all ``parts``, written one part after another: the disk holds the
    files and the shuffles of one part at a time."""
    spark = parts[0].sparkSession
    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex}")
    with shuffles_freed(spark):
        for df in parts:
            df.write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.schema(parts[0].schema).parquet(path)


#: Bytes of files that a step shuffles at a time (``turns_of``), and the most turns: the
#: written copy, not the shuffle, takes most of the disk from there on.
TURN_BYTES = 256 << 20
MOST_TURNS = 8
#: Keys looked at for each turn to place the cuts between turns.
CUT_KEYS = 64


def source_bytes(df: DataFrame) -> int:
    """Bytes of the files (or of the local rows) that ``df`` is made of."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def turns_of(left: DataFrame, right: DataFrame) -> int:
    """In how many turns ``left`` is joined to a lookup: one if the planner will
    broadcast the lookup, so that ``left`` is not shuffled."""
    limit = left.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if int(right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()) <= limit:
        return 1
    return max(1, min(MOST_TURNS, -(-source_bytes(left) // TURN_BYTES)))


def key_ranges(df: DataFrame, key: str, n: int) -> list[tuple]:
    """At most ``n`` ranges (above, up to) that hold every key but null once, of about as
    many rows each. Files sorted by the key are skipped over outside a range. The
    cuts are taken from a bounded choice of keys, which places them only."""
    found = (df.select(key).where(F.col(key).isNotNull()).orderBy(F.rand(0)).limit(CUT_KEYS * n).collect())
    keys = sorted(r[0] for r in found)
    cuts = sorted({keys[len(keys) * q // n] for q in range(1, n)}) if keys else []
    return list(zip([None, *cuts], [*cuts, None]))


def in_range(df: DataFrame, key: str, above, up_to) -> DataFrame:
    c = F.col(key)
    df = df if above is None else df.where(c > F.lit(above))
    return df if up_to is None else df.where(c <= F.lit(up_to))


def relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null foreign key has no parent row."""
    keys = parent.select(F.col(pk).alias(fk)).where(F.col(fk).isNotNull())
    return child.where(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


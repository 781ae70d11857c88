"""Window operators: keep-first, row-based and calendar-based lag / rolling sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def keep_first(df: DataFrame, partition_by: list, order_by: list) -> DataFrame:
    """One row per partition key: the first by ``order_by`` (QUALIFY
    row_number() = 1). Spark plans this with a partial WindowGroupLimit before
    the shuffle, so at most one row per key leaves each map task."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def lag_rows(df: DataFrame, value: str, n: int, partition_by: list, order_by: str,
             name: str) -> DataFrame:
    """Value from ``n`` rows earlier in the partition (null if fewer rows)."""
    w = Window.partitionBy(*partition_by).orderBy(order_by)
    return df.withColumn(name, F.lag(value, n).over(w))


def rolling_rows(df: DataFrame, value: str, n: int, partition_by: list, order_by: str,
                 name: str) -> DataFrame:
    """Sum over the current row and the ``n - 1`` rows before it."""
    w = Window.partitionBy(*partition_by).orderBy(order_by).rowsBetween(-(n - 1), 0)
    return df.withColumn(name, F.sum(value).over(w))


def _day_number(date_col: str):
    return F.datediff(F.col(date_col), F.lit("1970-01-01").cast("date"))


def lag_days(df: DataFrame, value: str, n: int, partition_by: list, date_col: str,
             name: str) -> DataFrame:
    """Value on the calendar day exactly ``n`` days earlier in the partition,
    null when that day has no row. Expects one row per (partition, day)."""
    w = Window.partitionBy(*partition_by).orderBy(_day_number(date_col)).rangeBetween(-n, -n)
    return df.withColumn(name, F.first(value).over(w))


def rolling_days(df: DataFrame, value: str, n: int, partition_by: list, date_col: str,
                 name: str) -> DataFrame:
    """Sum over the trailing ``n`` calendar days including the current day."""
    w = Window.partitionBy(*partition_by).orderBy(_day_number(date_col)).rangeBetween(-(n - 1), 0)
    return df.withColumn(name, F.sum(value).over(w))

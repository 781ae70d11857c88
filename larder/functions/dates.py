"""Date helpers. "Today" and "now" always come from the pinned Params."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def today(p) -> Column:
    return F.lit(p.as_of).cast("date")


def now_utc(p) -> Column:
    """Pinned run timestamp, read as UTC (the session time zone)."""
    return F.lit(p.now_ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def week_sunday(d) -> Column:
    """Week of year with weeks starting on Sunday; days before the first
    Sunday are week 0 (the warehouse's ``extract(week)``, not ISO weeks)."""
    d = _col(d)
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def quarter_label(d) -> Column:
    """'Q3-2024' style label."""
    d = _col(d)
    return F.concat(F.lit("Q"), F.ceil(F.month(d) / 3).cast("string"), F.lit("-"),
                    F.year(d).cast("string"))


def date_spine(spark: SparkSession, start: dt.date, end: dt.date,
               include_end: bool = False, name: str = "date_day") -> DataFrame:
    """One row per day from ``start`` to ``end`` (end excluded by default).

    Built from ``spark.range`` so the rows are generated in parallel."""
    n = (end - start).days + (1 if include_end else 0)
    n = max(n, 0)
    return spark.range(0, n).select(
        F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias(name))

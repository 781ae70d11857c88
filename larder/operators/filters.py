"""Row filters shared by the models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import today


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def since_lookback(df: DataFrame, date_col, p, days: int | None = None) -> DataFrame:
    """Rows whose date is within the incremental lookback window
    (``date >= as_of - lookback_days``). On a date derived from a timestamp
    Catalyst turns this into a timestamp range that reaches the scan."""
    days = p.lookback_days if days is None else days
    return df.where(_col(date_col) >= F.date_sub(today(p), days))


def limit_data_in_dev(df: DataFrame, date_col, p, days: int | None = None) -> DataFrame:
    """Development target only: keep the last ``days`` days; prod is unchanged."""
    if p.target != "dev":
        return df
    days = p.dev_days if days is None else days
    return df.where(_col(date_col) >= F.date_sub(today(p), days))


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the most recent snapshot: ``date = (select max(date))``.

    The max runs once as an uncorrelated scalar subquery (a global aggregate
    with map-side partial results), then filters the scan. On a table landed by
    snapshot day the max reads the days alone, no column of the files, and
    the filter is one on partitions: only the last day's files are opened."""
    latest = df.select(F.max(date_col)).scalar()
    return df.where(F.col(date_col) == latest)

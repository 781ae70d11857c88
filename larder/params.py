"""Run parameters.

Every time-dependent expression in the models reads the pinned ``as_of`` date
(and ``as_of_ts`` timestamp) instead of the wall clock, so a run is
reproducible and comparable with an independent SQL oracle.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Params:
    # Date of the run; the day it starts on (UTC) unless given.
    as_of: dt.date = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).date())
    # Pinned "current_timestamp()"; unset: the time the run started if as_of is
    # that day, else (a run for another day) midnight UTC of as_of.
    as_of_ts: dt.datetime | None = None
    # First day of the date dimension (project variable in the reference).
    start_date: dt.date = dt.date(2023, 1, 1)
    # dev | prod; dev applies the recent-days limiter.
    target: str = "prod"
    dev_days: int = 90
    lookback_days: int = 3
    # Independent models published concurrently (Spark jobs from a thread pool).
    threads: int = 4
    # Value bands on lifetime value: high >= first, mid >= second, low > 0.
    value_bands: tuple = (2000, 500)
    # Product tiers on revenue: hero >= first, core >= second, tail > 0.
    product_tiers: tuple = (10000, 1000)
    # Customer segments by days since last delivered order.
    segment_days: tuple = (30, 90, 180)
    # Date spine horizon after as_of, and whether the end day is included.
    date_spine_days_ahead: int = 730
    date_spine_include_end: bool = False
    # Source freshness thresholds in hours.
    freshness_warn_hours: int = 25
    freshness_error_hours: int = 48
    extra: dict = field(default_factory=dict)
    # When the run started (UTC), captured once and used by all its models.
    started_at: dt.datetime = field(default_factory=lambda: dt.datetime.now(dt.timezone.utc).replace(tzinfo=None),
                                    repr=False, compare=False)

    @property
    def now_ts(self) -> dt.datetime:
        if self.as_of_ts is not None:
            return self.as_of_ts
        if self.started_at.date() == self.as_of:
            return self.started_at
        return dt.datetime.combine(self.as_of, dt.time(0, 0))

    def starting_now(self) -> Params:
        """The same parameters for a run that starts at this moment."""
        return replace(self, started_at=dt.datetime.now(dt.timezone.utc).replace(tzinfo=None))


# Parameters used by the registered queries on the TPC-H-shaped test data:
# money there is ~100x the reference's, so the bands are scaled to keep every
# label populated.
# The calendar starts with the test data's first order date.
TEST_PARAMS = Params(as_of=dt.date(2001, 8, 1), value_bands=(900000, 400000), product_tiers=(600000, 350000),
                     start_date=dt.date(1995, 1, 1))

"""Data-quality checks as DataFrame jobs.

Each check returns its violating rows lazily; ``run_suite`` evaluates a list
of checks on one table in one aggregation pass (plus one grouped pass per
uniqueness check) and returns one summary row per check."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions.dates import now_utc
from larder.operators.joins import relationships  # noqa: F401  (re-exported)


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values occurring more than once (nulls ignored), with their count."""
    return (df.where(F.col(col).isNotNull()).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records"))
              .where(F.col("n_records") > 1))


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col).isNull())


def accepted_values(df: DataFrame, col: str, values) -> DataFrame:
    """Values outside the accepted set with their count (null passes)."""
    return (df.where(~F.col(col).isin(list(values))).groupBy(col)
              .agg(F.count(F.lit(1)).alias("n_records")))


def between(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Rows outside [lo, hi] (either bound optional; null passes)."""
    return df.where(~_between_cond(col, lo, hi))


def _between_cond(col, lo, hi):
    c = F.col(col)
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def matches(df: DataFrame, col: str, regex: str) -> DataFrame:
    """Rows whose value does not match ``regex`` (null passes)."""
    # A final `$` also matches before a closing line feed: not a full match.
    return df.where(~F.col(col).rlike(regex) | F.col(col).endswith("\n"))


def row_count_between(df: DataFrame, lo=None, hi=None) -> DataFrame:
    """One row: row_count and whether it lies within [lo, hi]."""
    n = F.count(F.lit(1))
    ok = F.lit(True)
    if lo is not None:
        ok = ok & (n >= lo)
    if hi is not None:
        ok = ok & (n <= hi)
    return df.agg(n.alias("row_count"), ok.alias("success"))


def freshness(df: DataFrame, ts_col: str, p, warn_hours=None, error_hours=None) -> DataFrame:
    """One row: newest load time, its age in hours at ``as_of_ts`` and the
    status pass / warn / error (an empty source, or one without load times,
    is an error)."""
    warn_hours = p.freshness_warn_hours if warn_hours is None else warn_hours
    error_hours = p.freshness_error_hours if error_hours is None else error_hours
    newest = F.max(F.col(ts_col).cast("timestamp"))
    age = (F.unix_timestamp(now_utc(p)) - F.unix_timestamp(newest)) / 3600.0
    return df.agg(newest.alias("max_loaded_at"), age.alias("age_hours")).withColumn(
        "status",
        F.when(F.col("age_hours").isNull() | (F.col("age_hours") > error_hours), "error")
         .when(F.col("age_hours") > warn_hours, "warn").otherwise("pass"))


def source_freshness(sources: dict, p, warn_hours=None, error_hours=None) -> DataFrame:
    """Freshness of several sources: {name: (DataFrame, load-time column)}
    -> table_name, max_loaded_at, age_hours, status (one row per source)."""
    rows = [freshness(df, col, p, warn_hours, error_hours).select(F.lit(name).alias("table_name"), "*")
            for name, (df, col) in sources.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


@dataclass(frozen=True)
class Check:
    """One expectation: kind in not_null | unique | in_set | between | regex | row_count."""
    kind: str
    column: str | None = None
    args: dict = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"{self.kind}({self.column})" if self.column else self.kind


def _sql_lit(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return repr(v)


def _failing_row_sql(chk: Check) -> str:
    c = f"`{chk.column}`"
    if chk.kind == "not_null":
        return f"{c} IS NULL"
    if chk.kind == "in_set":
        return f"NOT ({c} IN ({', '.join(_sql_lit(v) for v in chk.args['values'])}))"
    if chk.kind == "between":
        return f"NOT ({_range_sql(c, chk.args)})"
    if chk.kind == "regex":
        return f"NOT ({c} RLIKE {_sql_lit(chk.args['regex'])}) OR endswith({c}, '\\n')"
    raise ValueError(chk.kind)


def _range_sql(expr: str, args: dict) -> str:
    parts = ["true"]
    if args.get("lo") is not None:
        parts.append(f"{expr} >= {_sql_lit(args['lo'])}")
    if args.get("hi") is not None:
        parts.append(f"{expr} <= {_sql_lit(args['hi'])}")
    return " AND ".join(parts)


def suite_sql(view: str, table: str, checks: list) -> str:
    """The suite as one SQL statement over ``view``: row-level checks are
    ``count_if`` columns of a single aggregate (stacked into rows); each
    uniqueness check counts the rows of duplicated values in its own grouped
    aggregate (partial aggregation before the shuffle)."""
    row_checks = [c for c in checks if c.kind != "unique"]
    uniq = [c for c in checks if c.kind == "unique"]
    selects = []
    if row_checks:
        aggs, stack = ["count(*) AS _rows"], []
        for i, chk in enumerate(row_checks):
            if chk.kind == "row_count":
                failed = f"CASE WHEN {_range_sql('_rows', chk.args)} THEN 0 ELSE 1 END"
            else:
                aggs.append(f"count_if({_failing_row_sql(chk)}) AS _c{i}")
                failed = f"_c{i}"
            stack += [str(i), _sql_lit(chk.name), f"CAST({failed} AS BIGINT)"]
        selects.append(f"SELECT stack({len(row_checks)}, {', '.join(stack)}) AS (check_order, check, failed_rows) "
                       f"FROM (SELECT {', '.join(aggs)} FROM {view})")
    for j, chk in enumerate(uniq):
        selects.append(f"SELECT {len(row_checks) + j} AS check_order, {_sql_lit(chk.name)} AS check, "
                       f"CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS failed_rows "
                       f"FROM (SELECT count(*) AS n FROM {view} WHERE `{chk.column}` IS NOT NULL "
                       f"GROUP BY `{chk.column}`)")
    body = " UNION ALL ".join(selects)
    return (f"SELECT {_sql_lit(table)} AS table_name, CAST(check_order AS INT) AS check_order, check, "
            f"failed_rows, failed_rows = 0 AS success FROM ({body})")


def run_suite(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """table_name, check_order, check, failed_rows, success: one row per
    check, computed in place as one Spark SQL statement over the table."""
    view = f"larder_suite_{table}"
    df.createOrReplaceTempView(view)
    return df.sparkSession.sql(suite_sql(view, table, checks))


def suite_overall(results: DataFrame) -> DataFrame:
    """One row over all tables: checks passed, failed, and the overall flag."""
    return results.agg(
        F.count_distinct("table_name").alias("tables"),
        F.count(F.lit(1)).alias("total"),
        F.count_if("success").alias("passed"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"))


def suite_summary(results: DataFrame) -> DataFrame:
    """Per table: passed / total / failed check counts and overall success."""
    return results.groupBy("table_name").agg(
        F.count_if("success").alias("passed"),
        F.count(F.lit(1)).alias("total"),
        F.count_if(~F.col("success")).alias("failed"),
        F.bool_and("success").alias("success"))

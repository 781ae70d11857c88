"""Alert and run-log queries: stock-alert digest, run-result rollup, load summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.topk import alert_digest, alert_top_k_per_status, alert_top_n  # noqa: F401

# ---- fixed values: run-result statuses ----
OK_STATUSES = ["success", "pass"]
WARN_STATUSES = ["warn"]
ERROR_STATUSES = ["error", "fail"]
SKIP_STATUSES = ["skipped"]
# --------------------------------------------


def _node_name(col="unique_id"):
    """Text after the last dot of a node id."""
    return F.substring_index(F.col(col), ".", -1)


def run_log_rollup(log: DataFrame) -> DataFrame:
    """One row per run: counts by outcome, elapsed seconds (1 decimal) and
    the sorted names of failed and warned nodes. Input: run_id,
    elapsed_time, status, unique_id (one row per node result)."""
    s = F.col("status")
    return log.groupBy("run_id").agg(
        F.count("unique_id").alias("total"),
        F.count_if(s.isin(OK_STATUSES)).alias("success"),
        F.count_if(s.isin(WARN_STATUSES)).alias("warnings"),
        F.count_if(s.isin(ERROR_STATUSES)).alias("errors"),
        F.count_if(s.isin(SKIP_STATUSES)).alias("skipped"),
        F.round(F.max("elapsed_time"), 1).alias("elapsed"),
        F.array_sort(F.collect_list(F.when(s.isin(ERROR_STATUSES), _node_name()))).alias("error_nodes"),
        F.array_sort(F.collect_list(F.when(s.isin(WARN_STATUSES), _node_name()))).alias("warn_nodes"),
    )


def suite_run_log(results: DataFrame, run_id: str, elapsed_col=None) -> DataFrame:
    """Turn check results (table_name, check, success) into run-log rows."""
    uid = F.concat(F.lit("test.larder."), F.col("table_name"), F.lit("."),
                   F.regexp_replace(F.col("check"), r"[()]", "_"))
    return results.select(
        F.lit(run_id).alias("run_id"),
        (F.col(elapsed_col) if elapsed_col else F.lit(None).cast("double")).alias("elapsed_time"),
        F.when(F.col("success"), "pass").otherwise("fail").alias("status"),
        uid.alias("unique_id"))


def load_summary(tables: dict) -> DataFrame:
    """Rows per loaded table, plus a TOTAL row."""
    per = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count"))
           for name, df in tables.items()]
    counts = reduce(DataFrame.unionByName, per)
    total = counts.agg(F.lit("TOTAL").alias("table_name"), F.sum("row_count").cast("bigint").alias("row_count"))
    return counts.unionByName(total)

"""Ordered alert lists and top-k per group."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# ---- fixed values: alert severities, most severe first ----
SEVERITY = ["out_of_stock", "critical", "low_stock"]
# ------------------------------------------------------------

ALERT_COLUMNS = ["stock_status", "product_name", "category", "warehouse_id",
                 "units_available", "reorder_point"]


def severity_rank(col="stock_status"):
    c = F.col(col)
    expr = None
    for i, s in enumerate(SEVERITY, start=1):
        expr = F.when(c == s, i) if expr is None else expr.when(c == s, i)
    return expr


def _alert_order():
    # product_id and warehouse_id make the order total (ties are arbitrary in
    # the reference's severity, category, name ordering).
    return [severity_rank(), F.col("category"), F.col("product_name"),
            F.col("warehouse_id"), F.col("product_id")]


def alert_top_n(alerts: DataFrame, n: int = 20) -> DataFrame:
    """The n most severe alerts (severity, category, product name). Planned
    as TakeOrderedAndProject: each task keeps its own top n."""
    ranked = alerts.orderBy(*_alert_order()).limit(n)
    return ranked.select(*ALERT_COLUMNS)


def alert_top_k_per_status(alerts: DataFrame, k: int = 5) -> DataFrame:
    """First k alerts of every severity over the whole alert table.
    The rank filter becomes a WindowGroupLimit, applied before the shuffle,
    so a severity holding most rows still sends at most k rows per task."""
    w = Window.partitionBy("stock_status").orderBy(*_alert_order()[1:])
    return (alerts.withColumn("rank_in_status", F.row_number().over(w))
                  .where(F.col("rank_in_status") <= k)
                  .select(*ALERT_COLUMNS, "rank_in_status"))


def alert_digest(alerts: DataFrame, n: int = 20, k: int = 5, total_of_list: bool = False) -> DataFrame:
    """Rows of the stock-alert message: of the n most severe alerts, the
    first k of each severity, with the number of alerts and how many of them
    are beyond the 3*k a message shows. The number covers the whole alert
    table; ``total_of_list=True`` counts the top-n list only."""
    order = _alert_order()
    top = alerts.orderBy(*order).limit(n)
    w_status = Window.partitionBy("stock_status").orderBy(*order[1:])
    listed = top.withColumn("rank_in_status", F.row_number().over(w_status))
    total = (top if total_of_list else alerts).select(F.count(F.lit(1))).scalar()
    shown = len(SEVERITY) * k
    return (listed.where(F.col("rank_in_status") <= k)
                  .withColumn("alerts_listed", total)
                  .select(*ALERT_COLUMNS, "rank_in_status", "alerts_listed",
                          F.greatest(F.col("alerts_listed") - shown, F.lit(0)).alias("more_count")))

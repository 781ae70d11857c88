"""Ordered banding (first matching rule wins)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = {
    ">=": lambda c, b: c >= b,
    ">": lambda c, b: c > b,
    "<=": lambda c, b: c <= b,
    "<": lambda c, b: c < b,
    "=": lambda c, b: c == b,
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(value, cuts, default) -> Column:
    """``cuts`` is a list of (op, bound, label); a null value matches no cut."""
    value = _col(value)
    expr = None
    for op, bound, label in cuts:
        cond = _OPS[op](value, bound)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    if expr is None:
        return F.lit(default)
    return expr.otherwise(default)


def customer_segment(days, orders, p) -> Column:
    """Recency segment; a customer without orders has null days, fails the
    three recency tests and lands on never_ordered."""
    a, r, l = p.segment_days
    days, orders = _col(days), _col(orders)
    return (F.when(days <= a, "active").when(days <= r, "at_risk").when(days <= l, "lapsing")
            .when(orders.isNull(), "never_ordered").otherwise("churned"))


def value_band(v, p) -> Column:
    hi, mid = p.value_bands
    return band(v, [(">=", hi, "high"), (">=", mid, "mid"), (">", 0, "low")], "none")


def product_tier(v, p) -> Column:
    hero, core = p.product_tiers
    return band(v, [(">=", hero, "hero"), (">=", core, "core"), (">", 0, "tail")], "no_sales")


def stock_status(available, reorder_point, below) -> Column:
    available, reorder_point, below = _col(available), _col(reorder_point), _col(below)
    return (F.when(available == 0, "out_of_stock")
            .when(available <= reorder_point * F.lit(0.5), "critical")
            .when(below, "low_stock").otherwise("ok"))

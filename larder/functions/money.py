"""Money, ratio and aggregate helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

# Raw money is held as decimal(18,4): exact, and small enough that Spark's
# decimal multiply/divide keeps the scale (a (38,9) operand loses digits).
MONEY = DecimalType(18, 4)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_money(c) -> Column:
    return _col(c).cast(MONEY)


def to_int64(c) -> Column:
    """Cast to bigint rounding half away from zero (the warehouse's int cast
    rounds; Spark's truncates)."""
    return F.round(_col(c)).cast("bigint")


def cents_to_pounds(c) -> Column:
    """Whole pence -> pounds, rounded to 2 places."""
    return F.round(_col(c).cast(DecimalType(20, 2)) / F.lit(100), 2)


def safe_divide(num, den) -> Column:
    """num / den, null when den is 0 or null."""
    return F.try_divide(_col(num), _col(den))


def pct_change(cur, prev) -> Column:
    """Percentage change rounded to 2 places; null when prev is 0 or null."""
    cur, prev = _col(cur), _col(prev)
    return F.when(prev.isNull() | (prev == 0), F.lit(None)).otherwise(
        F.round((cur - prev) / prev * 100, 2))


AVG_MONEY = DecimalType(38, 6)


def money_avg(c) -> Column:
    """Mean of a decimal money column as an exact decimal(38,6): the exact
    sum divided by the count of non-null values, rounded half-up once (the
    warehouse averages NUMERIC as NUMERIC). Independent of row order.
    Inputs may have up to 6 decimal places."""
    c = _col(c)
    return F.try_divide(F.sum(c).cast(AVG_MONEY), F.count(c))


def exact_avg(c) -> Column:
    """Mean of an integer column as double = exact sum / count of non-null
    values (the warehouse averages INT64 as FLOAT64). The sum is exact, so
    the result does not depend on the order rows are combined in."""
    c = _col(c)
    return F.try_divide(F.sum(c).cast("double"), F.count(c))


def revenue_metrics(gross, discount) -> list[Column]:
    """Aggregate bundle: gross, discount, net, mean basket, discount rate."""
    g, d = _col(gross), _col(discount)
    return [
        F.sum(g).alias("gross_revenue_gbp"),
        F.sum(d).alias("total_discount_gbp"),
        (F.sum(g) - F.sum(d)).alias("net_revenue_gbp"),
        money_avg(g).alias("avg_basket_gbp"),
        safe_divide(F.sum(d).cast("double"), F.sum(g).cast("double")).alias("discount_rate"),
    ]

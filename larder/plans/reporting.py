"""Reporting models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from larder.functions import exact_avg, money_avg, now_utc, pct_change, stock_status
from larder.functions.money import AVG_MONEY
from larder.operators.filters import latest_snapshot
from larder.operators.windows import lag_days, lag_rows, rolling_days, rolling_rows


def daily_aggregate(fact_orders: DataFrame) -> DataFrame:
    """Delivered orders per day x channel.

    Orders and customers are distinct counts, as in the source project: an
    order that is there twice counts once (but its money twice). Rows are added
    up per order and customer, then per customer, then per day; an order counts
    at the first of its customers and a customer once, so neither count needs
    copies of the rows. Orders kept by ``order_id`` move only from the second
    step on."""
    day = ["order_date", "order_channel"]
    by_order = fact_orders.where(F.col("is_delivered")).groupBy("order_id", *day, "customer_id").agg(
        F.sum("basket_value_gbp").alias("gross"),
        F.count("basket_value_gbp").alias("baskets"),
        F.sum("total_discount_gbp").alias("discount"),
        F.sum("total_units").alias("units"),
        F.count_if("has_promo").alias("promo"),
        F.sum("substituted_line_count").alias("substituted"),
        F.count(F.lit(1)).alias("rows"),
    )
    added = {f.name: f.dataType for f in by_order.schema if f.name not in ("order_id", *day, "customer_id")}
    first = F.row_number().over(Window.partitionBy("order_id", *day).orderBy("customer_id")) == 1
    by_order = by_order.withColumn("orders", (first & F.col("order_id").isNotNull()).cast("long"))

    def total(c: str) -> Column:  # a sum of sums keeps the type of the first sum
        return F.sum(c).cast(added.get(c, "long")).alias(c)

    by_customer = by_order.groupBy(*day, "customer_id").agg(total("orders"), *map(total, added))
    d = by_customer.groupBy(*day).agg(total("orders"), F.count("customer_id").alias("customers"), *map(total, added))
    return d.select(
        *day,
        F.col("orders").alias("total_orders"),
        F.col("customers").alias("unique_customers"),
        F.col("gross").alias("gross_revenue_gbp"),
        F.col("discount").alias("total_discount_gbp"),
        (F.col("gross") - F.col("discount")).alias("net_revenue_gbp"),
        F.try_divide(F.col("gross").cast(AVG_MONEY), F.col("baskets")).alias("avg_basket_value_gbp"),
        F.col("units").alias("total_units_sold"),
        F.col("promo").alias("promo_orders"),
        (F.col("promo") / F.col("rows")).alias("promo_attach_rate"),
        F.col("substituted").alias("total_substitutions"),
    )


def daily_sales(fact_orders: DataFrame, calendar_frames: bool = False) -> DataFrame:
    """Daily sales by channel with week-over-week change and a 7-step
    rolling sum. As in the reference, the lag and the rolling frame count
    rows (days with sales); ``calendar_frames=True`` uses calendar days."""
    daily = daily_aggregate(fact_orders)
    part = ["order_channel"]
    if calendar_frames:
        daily = lag_days(daily, "gross_revenue_gbp", 7, part, "order_date", "revenue_7d_ago_gbp")
        daily = rolling_days(daily, "gross_revenue_gbp", 7, part, "order_date", "revenue_rolling_7d_gbp")
    else:
        daily = lag_rows(daily, "gross_revenue_gbp", 7, part, "order_date", "revenue_7d_ago_gbp")
        daily = rolling_rows(daily, "gross_revenue_gbp", 7, part, "order_date", "revenue_rolling_7d_gbp")
    return daily.withColumn("revenue_wow_pct_change",
                            pct_change("gross_revenue_gbp", "revenue_7d_ago_gbp"))


def inventory_alert_rows(inventory: DataFrame, dim_products: DataFrame, p) -> DataFrame:
    """Latest-snapshot stock rows at or below their reorder point (unordered;
    the alert list and top-k queries order what they need).

    Of the products only attributes are used: the published dimension gives
    them, and so do the staged products, without the sales behind the former."""
    inv = latest_snapshot(inventory, "snapshot_date").where(F.col("is_below_reorder_point")).alias("i")
    prod = dim_products.select("product_id", "product_name", "category", "brand", "sku").alias("p")
    return (inv.join(prod, F.col("i.product_id") == F.col("p.product_id"), "inner")
               .select("i.product_id", "p.product_name", "p.sku", "p.category", "p.brand",
                       "i.warehouse_id", "i.snapshot_date", "i.units_on_hand", "i.units_reserved",
                       "i.units_available", "i.reorder_point", "i.is_below_reorder_point",
                       stock_status("i.units_available", "i.reorder_point",
                                    "i.is_below_reorder_point").alias("stock_status"),
                       now_utc(p).alias("alert_generated_at")))


def inventory_alerts(inventory: DataFrame, dim_products: DataFrame, p) -> DataFrame:
    """The alert table, ordered by status, category and product name."""
    return inventory_alert_rows(inventory, dim_products, p).orderBy("stock_status", "category",
                                                                   "product_name")


def customer_ltv(dim_customers: DataFrame) -> DataFrame:
    """Cohort (registration month) x segment x value band x tier summary."""
    c = dim_customers.where(F.col("has_ordered"))
    agg = c.groupBy("customer_segment", "value_band", "loyalty_tier",
                    F.trunc("registration_date", "month").alias("cohort_month")).agg(
        F.count_distinct("customer_id").alias("customer_count"),
        F.sum("lifetime_value_gbp").alias("cohort_ltv_gbp"),
        money_avg("lifetime_value_gbp").alias("avg_ltv_gbp"),
        exact_avg("total_orders").alias("avg_orders_per_customer"),
        money_avg("avg_order_value_gbp").alias("avg_basket_gbp"),
        exact_avg("days_since_last_order").alias("avg_days_since_last_order"),
        F.count_if(F.col("days_since_last_order") <= 30).alias("active_last_30d"),
        F.count_if(F.col("days_since_last_order") <= 90).alias("active_last_90d"),
    )
    n = F.nullif(F.col("customer_count"), F.lit(0))
    return (agg.withColumn("pct_active_30d", F.round(F.col("active_last_30d") / n * 100, 2))
               .withColumn("pct_active_90d", F.round(F.col("active_last_90d") / n * 100, 2))
               .orderBy(F.col("cohort_month").desc(), F.col("cohort_ltv_gbp").desc()))

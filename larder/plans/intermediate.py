"""Intermediate models: basket, customer and product metrics.

These are lazy DataFrames; the full run publishes the basket metrics and reads
them back, since several models use them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import customer_segment, money_avg, safe_divide, today, week_sunday
from larder.operators.filters import since_lookback
from larder.operators.joins import lookup_join, materialize
from larder.operators.windows import keep_first


def basket_aggregate(items: DataFrame) -> DataFrame:
    """One row per order_id over its lines (partial+final hash aggregate)."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("item_line_count"),
        F.sum("quantity").alias("total_units"),
        F.sum("line_total_gbp").alias("basket_value_gbp"),
        F.sum("discount_amount_gbp").alias("total_discount_gbp"),
        F.count_if("is_substituted").alias("substituted_line_count"),
        (F.sum("line_total_gbp") + F.sum(F.coalesce("discount_amount_gbp", F.lit(0))))
        .alias("gross_basket_gbp"),
    )


def recent_orders(orders: DataFrame, p) -> DataFrame:
    """Staged orders inside the lookback window, written once for all that an
    hourly run builds on them: joins see their real size.

    The window is applied to the copy again. It is true for every row, but tells
    the planner that the order ids are selective: beyond the broadcast size, it
    then thins the lines by a runtime Bloom filter of those ids
    (``session.RUNTIME_FILTER_CONF``) in their scan, before any shuffle."""
    day = F.to_date("order_created_at")
    return since_lookback(materialize(since_lookback(orders, day, p), "recent-orders"), day, p)


def lines_of(items: DataFrame, orders: DataFrame) -> DataFrame:
    """The lines of some orders: ids broadcast if small, else as above."""
    return items.join(orders.select("order_id"), "order_id", "left_semi")


def basket_metrics(orders: DataFrame, items: DataFrame, promotions: DataFrame, p,
                   restrict: bool = False) -> DataFrame:
    """Orders left-joined to their basket aggregate and to promotions.

    ``restrict=True`` is for a small part of the orders (``recent_orders``): the
    lines are semi-joined to them before they are aggregated, so an hourly run
    only aggregates the lines of recent orders."""
    if restrict:
        items = lines_of(items, orders)
    agg = basket_aggregate(items)
    promos = promotions.select(F.col("promo_code").alias("_promo_code"), "promo_id", "promo_type",
                               F.col("discount_value").alias("promo_discount_value"))
    joined = lookup_join(orders.join(agg, "order_id", "left"), promos, "promo_code", "_promo_code",
                         salt_col="order_id")
    created = F.col("order_created_at")
    return joined.select(
        "order_id", "customer_id", "order_status", "order_channel", "order_created_at",
        "delivery_slot_start_at", "delivery_slot_end_at", "promo_code", "refreshed_at",
        "item_line_count", "total_units", "basket_value_gbp", "total_discount_gbp",
        "gross_basket_gbp", "substituted_line_count",
        "promo_type", "promo_discount_value",
        (F.col("order_status") == "delivered").alias("is_delivered"),
        (F.col("order_status") == "cancelled").alias("is_cancelled"),
        (F.col("order_status") == "returned").alias("is_returned"),
        F.col("promo_id").isNotNull().alias("has_promo"),
        F.to_date(created).alias("order_date"),
        F.year(created).alias("order_year"),
        F.month(created).alias("order_month"),
        week_sunday(created).alias("order_week"),
        F.hour(created).alias("order_hour"),
    )


def customer_metrics(baskets: DataFrame, customers: DataFrame, p) -> DataFrame:
    """Customer grain: lifetime value, frequency, recency over delivered orders."""
    delivered = baskets.where(F.col("is_delivered"))
    agg = delivered.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.count_if(F.col("order_year") == F.year(today(p))).alias("orders_this_year"),
        F.sum("basket_value_gbp").alias("lifetime_value_gbp"),
        money_avg("basket_value_gbp").alias("avg_order_value_gbp"),
        F.min("order_date").alias("first_order_date"),
        F.max("order_date").alias("last_order_date"),
        F.datediff(today(p), F.max("order_date")).alias("days_since_last_order"),
        F.count_if("has_promo").alias("promo_orders_count"),
        F.sum("total_discount_gbp").alias("lifetime_discount_gbp"),
    )
    c, a = customers.alias("c"), agg.alias("a")
    z = F.lit(0)
    return c.join(a, F.col("c.customer_id") == F.col("a.customer_id"), "left").select(
        "c.customer_id", "c.email", "c.first_name", "c.last_name", "c.loyalty_tier",
        "c.registered_at", "c.postcode", "c.is_active", "c.days_since_registration",
        "c.refreshed_at",
        "a.first_order_date", "a.last_order_date",
        F.coalesce("a.total_orders", z).alias("total_orders"),
        F.coalesce("a.orders_this_year", z).alias("orders_this_year"),
        F.coalesce("a.lifetime_value_gbp", z).alias("lifetime_value_gbp"),
        F.coalesce("a.avg_order_value_gbp", z).alias("avg_order_value_gbp"),
        F.coalesce("a.days_since_last_order", F.lit(9999)).alias("days_since_last_order"),
        F.coalesce("a.promo_orders_count", z).alias("promo_orders_count"),
        F.coalesce("a.lifetime_discount_gbp", z).alias("lifetime_discount_gbp"),
        customer_segment("a.days_since_last_order", "a.total_orders", p).alias("customer_segment"),
        F.col("a.total_orders").isNotNull().alias("has_ordered"),
    )


def latest_inventory(inventory: DataFrame) -> DataFrame:
    """Latest snapshot row per product. The reference orders by date only
    (ties across warehouses are arbitrary); warehouse and inventory id break
    ties here so the result is deterministic."""
    return keep_first(inventory, ["product_id"],
                      [F.col("snapshot_date").desc(), F.col("warehouse_id").asc(),
                       F.col("inventory_id").asc()])


def product_sales(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Per product over lines of delivered orders.

    An inner join, as in the source project: an order delivered twice counts
    its lines twice. AQE can split a skewed order's partition for it."""
    delivered = orders.where(F.col("order_status") == "delivered").select("order_id")
    lines = items.join(delivered, "order_id")
    return lines.groupBy("product_id").agg(
        F.count_distinct("order_id").alias("orders_containing_product"),
        F.sum("quantity").alias("total_units_sold"),
        F.sum("line_total_gbp").alias("total_revenue_gbp"),
        F.sum("discount_amount_gbp").alias("total_discount_gbp"),
        money_avg("unit_price_gbp").alias("avg_selling_price_gbp"),
        F.count_if("is_substituted").alias("times_substituted_away"),
    )


def product_metrics(items: DataFrame, orders: DataFrame, products: DataFrame,
                    inventory: DataFrame, p) -> DataFrame:
    """Product grain: revenue, margin, substitution and latest stock.

    ``orders`` is the staged orders table: the delivered flag is derived from
    it exactly as in the basket model, without rebuilding the baskets."""
    s = product_sales(items, orders).alias("s")
    inv = latest_inventory(inventory).select("product_id", "units_available",
                                             "is_below_reorder_point").alias("inv")
    pr = products.alias("p")
    z = F.lit(0)
    revenue = F.coalesce("s.total_revenue_gbp", z)
    margin = revenue - F.coalesce("s.total_units_sold", z) * F.col("p.cost_price_gbp")
    return (pr.join(s, F.col("p.product_id") == F.col("s.product_id"), "left")
              .join(inv, F.col("p.product_id") == F.col("inv.product_id"), "left")
              .select(
                  "p.product_id", "p.product_name", "p.sku", "p.category", "p.subcategory",
                  "p.brand", "p.cost_price_gbp", "p.rrp_gbp", "p.is_active",
                  "p.is_age_restricted", "p.refreshed_at",
                  "inv.units_available", "inv.is_below_reorder_point",
                  F.coalesce("s.orders_containing_product", z).alias("orders_containing_product"),
                  F.coalesce("s.total_units_sold", z).alias("total_units_sold"),
                  revenue.alias("total_revenue_gbp"),
                  F.coalesce("s.total_discount_gbp", z).alias("total_discount_gbp"),
                  F.coalesce("s.avg_selling_price_gbp", z).alias("avg_selling_price_gbp"),
                  F.coalesce("s.times_substituted_away", z).alias("times_substituted_away"),
                  margin.alias("gross_margin_gbp"),
                  F.when(revenue == 0, F.lit(None))
                   .otherwise(F.round(safe_divide(margin, F.col("s.total_revenue_gbp")) * 100, 2))
                   .alias("gross_margin_pct"),
              ))

"""Fact models at order and order-line grain (incrementally merged)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import now_utc, surrogate_key
from larder.operators.filters import since_lookback
from larder.operators.joins import in_range, key_ranges, lookup_join, materialize_in_turns, turns_of

FACT_ORDERS_CLUSTER = ["order_status", "order_channel"]
FACT_ORDER_ITEMS_CLUSTER = ["product_id", "category"]


def fact_orders(baskets: DataFrame, p, incremental: bool = False) -> DataFrame:
    """One row per order. ``incremental`` keeps the lookback window only
    (pass baskets of ``recent_orders`` to also bound the line aggregation)."""
    b = since_lookback(baskets, "order_date", p) if incremental else baskets
    return b.select(
        surrogate_key("order_id").alias("surrogate_key"),
        "order_id", "customer_id",
        "order_status", "order_channel", "promo_code", "promo_type",
        "order_date", "order_year", "order_month", "order_week", "order_hour",
        "order_created_at", "delivery_slot_start_at", "delivery_slot_end_at",
        "item_line_count", "total_units", "basket_value_gbp", "gross_basket_gbp",
        "total_discount_gbp", "substituted_line_count",
        "is_delivered", "is_cancelled", "is_returned", "has_promo",
        "refreshed_at", now_utc(p).alias("dbt_updated_at"),
    )


def order_context(orders: DataFrame, p, incremental: bool = False) -> DataFrame:
    """The order columns a line fact needs, derived from staged orders the
    same way the basket model derives them (no line aggregation needed)."""
    o = orders.select(
        "order_id", "customer_id",
        F.to_date("order_created_at").alias("order_date"),
        "order_status", "order_channel",
        (F.col("order_status") == "delivered").alias("is_delivered"))
    return since_lookback(o, "order_date", p) if incremental else o


def fact_order_items(items: DataFrame, orders: DataFrame, products: DataFrame, p,
                     incremental: bool = False) -> DataFrame:
    """One row per order line with order and product context.

    Incremental runs pass ``recent_orders``: broadcast if small, else their
    ids thin the scan of the lines; full runs shuffle both sides on order_id.

    Products too large to broadcast make every line move to its product. Many lines then do
    so in turns, those of a range of order ids at a time (landed files are sorted by it);
    the turns are written to the shared checkpoint folder."""
    o = order_context(orders, p, incremental)
    prod = products.select(F.col("product_id").alias("p_product_id"), "category", "subcategory", "brand")
    turns = 1 if incremental else turns_of(items, prod)

    def with_context(items: DataFrame, o: DataFrame) -> DataFrame:
        i, o = items.alias("i"), o.alias("o")
        lines = i.join(o, F.col("i.order_id") == F.col("o.order_id"), "inner")
        return lookup_join(lines, prod, "i.product_id", "p_product_id", salt_col="i.order_item_id").select(
            "i.order_item_id", "i.order_id", "o.customer_id", "i.product_id",
            "category", "subcategory", "brand",
            "o.order_date", "o.order_status", "o.order_channel", "o.is_delivered",
            "i.quantity", "i.unit_price_gbp", "i.discount_amount_gbp", "i.line_total_gbp",
            "i.is_substituted", "i.substituted_product_id", "i.refreshed_at")

    if turns == 1:
        lines = with_context(items, o)
    else:
        lines = materialize_in_turns([with_context(in_range(items, "order_id", *r), in_range(o, "order_id", *r))
                                      for r in key_ranges(orders, "order_id", turns)], "order-lines")
    return lines.select(surrogate_key("order_item_id").alias("surrogate_key"), *lines.columns,
                        now_utc(p).alias("dbt_updated_at"))

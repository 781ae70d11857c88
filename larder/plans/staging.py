"""Staging models: cast, rename and clean one raw table each. No joins.

Each is a narrow projection (no shuffle), so Catalyst prunes unused columns
and pushes downstream filters through it into the Parquet scan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.functions import clean_text, now_utc, title_case, to_int64, to_money, today


def stg_orders(raw: DataFrame, p) -> DataFrame:
    c = F.col
    return raw.select(
        c("order_id").cast("string").alias("order_id"),
        c("customer_id").cast("string").alias("customer_id"),
        c("delivery_address_id").cast("string").alias("delivery_address_id"),
        c("promo_code").cast("string").alias("promo_code"),
        c("created_at").cast("timestamp").alias("order_created_at"),
        c("delivery_slot_start").cast("timestamp").alias("delivery_slot_start_at"),
        c("delivery_slot_end").cast("timestamp").alias("delivery_slot_end_at"),
        c("_loaded_at").cast("timestamp").alias("refreshed_at"),
        F.lower(clean_text("status")).alias("order_status"),
        F.lower(clean_text("channel")).alias("order_channel"),
    )


def stg_order_items(raw: DataFrame, p) -> DataFrame:
    c = F.col
    # The line total reads the raw columns (not the aliases below), exactly
    # once per line: quantity x unit price - discount (missing = 0).
    line_total = (c("quantity").cast("decimal(20,0)") * to_money("unit_price_gbp")
                  - F.coalesce(to_money("discount_amount_gbp"), F.lit(0).cast("decimal(18,4)")))
    return raw.select(
        c("order_item_id").cast("string").alias("order_item_id"),
        c("order_id").cast("string").alias("order_id"),
        c("product_id").cast("string").alias("product_id"),
        c("substituted_product_id").cast("string").alias("substituted_product_id"),
        to_int64("quantity").alias("quantity"),
        to_money("unit_price_gbp").alias("unit_price_gbp"),
        to_money("discount_amount_gbp").alias("discount_amount_gbp"),
        line_total.cast("decimal(18,4)").alias("line_total_gbp"),
        c("substituted_product_id").isNotNull().alias("is_substituted"),
        now_utc(p).alias("refreshed_at"),
    )


def stg_products(raw: DataFrame, p) -> DataFrame:
    c = F.col
    return raw.select(
        c("product_id").cast("string").alias("product_id"),
        c("sku").cast("string").alias("sku"),
        to_money("cost_price_gbp").alias("cost_price_gbp"),
        to_money("rrp_gbp").alias("rrp_gbp"),
        to_money("weight_kg").alias("weight_kg"),
        c("is_alcohol").cast("boolean").alias("is_alcohol"),
        c("is_age_restricted").cast("boolean").alias("is_age_restricted"),
        c("is_active").cast("boolean").alias("is_active"),
        clean_text("product_name").alias("product_name"),
        F.lower(clean_text("category")).alias("category"),
        F.lower(clean_text("subcategory")).alias("subcategory"),
        F.lower(clean_text("brand")).alias("brand"),
        now_utc(p).alias("refreshed_at"),
    )


def stg_customers(raw: DataFrame, p) -> DataFrame:
    c = F.col
    registered = c("registered_at").cast("timestamp")
    return raw.select(
        c("customer_id").cast("string").alias("customer_id"),
        c("date_of_birth").cast("date").alias("date_of_birth"),
        c("is_active").cast("boolean").alias("is_active"),
        c("_loaded_at").cast("timestamp").alias("refreshed_at"),
        registered.alias("registered_at"),
        F.lower(clean_text("email")).alias("email"),
        title_case(clean_text("first_name")).alias("first_name"),
        title_case(clean_text("last_name")).alias("last_name"),
        F.upper(clean_text("postcode")).alias("postcode"),
        F.lower(clean_text("loyalty_tier")).alias("loyalty_tier"),
        F.datediff(today(p), F.to_date(registered)).alias("days_since_registration"),
    )


def stg_inventory(raw: DataFrame, p) -> DataFrame:
    c = F.col
    on_hand, reserved, reorder = to_int64("units_on_hand"), to_int64("units_reserved"), to_int64("reorder_point")
    return raw.select(
        c("inventory_id").cast("string").alias("inventory_id"),
        c("product_id").cast("string").alias("product_id"),
        c("warehouse_id").cast("string").alias("warehouse_id"),
        c("snapshot_date").cast("date").alias("snapshot_date"),
        on_hand.alias("units_on_hand"),
        reserved.alias("units_reserved"),
        to_int64("units_in_transit").alias("units_in_transit"),
        reorder.alias("reorder_point"),
        c("_loaded_at").cast("timestamp").alias("refreshed_at"),
        (on_hand - reserved).alias("units_available"),
        (on_hand <= reorder).alias("is_below_reorder_point"),
    )


def stg_promotions(raw: DataFrame, p) -> DataFrame:
    c = F.col
    valid = (c("valid_to").cast("date") >= today(p)) & (c("is_active").cast("boolean") == F.lit(True))
    if p.extra.get("promo_check_start"):
        valid = valid & (c("valid_from").cast("date") <= today(p))
    return raw.select(
        c("promo_id").cast("string").alias("promo_id"),
        to_money("discount_value").alias("discount_value"),
        to_money("min_basket_gbp").alias("min_basket_gbp"),
        c("valid_from").cast("date").alias("valid_from"),
        c("valid_to").cast("date").alias("valid_to"),
        c("is_active").cast("boolean").alias("is_active"),
        F.upper(clean_text("promo_code")).alias("promo_code"),
        F.lower(clean_text("promo_type")).alias("promo_type"),
        valid.alias("is_currently_valid"),
        now_utc(p).alias("refreshed_at"),
    )


STAGING = {
    "orders": stg_orders,
    "order_items": stg_order_items,
    "products": stg_products,
    "customers": stg_customers,
    "inventory": stg_inventory,
    "promotions": stg_promotions,
}


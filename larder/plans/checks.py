"""Expectation suites on the staging tables (the reference's validation run)."""

from __future__ import annotations

from larder.functions.text import EMAIL_PATTERN
from larder.operators.quality import Check

# ---- fixed values: accepted value sets ----
ORDER_STATUSES = ["pending", "confirmed", "picking", "dispatched", "delivered", "cancelled", "returned"]
ORDER_CHANNELS = ["web", "app", "partner"]
LOYALTY_TIERS = ["bronze", "silver", "gold", "platinum"]
PROMO_TYPES = ["pct_discount", "fixed_discount", "bogo", "free_delivery"]
CUSTOMER_SEGMENTS = ["active", "at_risk", "lapsing", "churned", "never_ordered"]
VALUE_BANDS = ["high", "mid", "low", "none"]
PRODUCT_TIERS = ["hero", "core", "tail", "no_sales"]
STOCK_STATUSES = ["out_of_stock", "critical", "low_stock"]
# --------------------------------------------

STAGING_SUITES = {
    "stg_orders": [
        Check("not_null", "order_id"),
        Check("unique", "order_id"),
        Check("not_null", "customer_id"),
        Check("in_set", "order_status", {"values": ORDER_STATUSES}),
        Check("in_set", "order_channel", {"values": ORDER_CHANNELS}),
        Check("row_count", None, {"lo": 100}),
    ],
    "stg_order_items": [
        Check("not_null", "order_item_id"),
        Check("unique", "order_item_id"),
        Check("not_null", "order_id"),
        Check("not_null", "product_id"),
        Check("between", "quantity", {"lo": 1, "hi": 99}),
        Check("between", "unit_price_gbp", {"lo": 0.01}),
        Check("between", "line_total_gbp", {"lo": 0.01}),
        Check("row_count", None, {"lo": 500}),
    ],
    "stg_customers": [
        Check("not_null", "customer_id"),
        Check("unique", "customer_id"),
        Check("not_null", "email"),
        Check("unique", "email"),
        Check("regex", "email", {"regex": EMAIL_PATTERN}),
        Check("in_set", "loyalty_tier", {"values": LOYALTY_TIERS}),
        Check("between", "days_since_registration", {"lo": -365, "hi": 3000}),
    ],
    "stg_products": [
        Check("not_null", "product_id"),
        Check("unique", "product_id"),
        Check("not_null", "sku"),
        Check("unique", "sku"),
        Check("between", "cost_price_gbp", {"lo": 0.01}),
        Check("between", "rrp_gbp", {"lo": 0.01}),
        Check("row_count", None, {"lo": 50, "hi": 500}),
    ],
}

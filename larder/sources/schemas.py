"""Explicit schemas of the six raw supermarket tables and of the run log.

Raw money arrives as decimal(18,2); staging widens it to decimal(18,4)."""

from pyspark.sql import types as T

_S, _L, _B, _D, _TS = T.StringType(), T.LongType(), T.BooleanType(), T.DateType(), T.TimestampType()
_M = T.DecimalType(18, 2)


def _schema(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


RAW_SCHEMAS = {
    "orders": _schema(("order_id", _S), ("customer_id", _S), ("status", _S), ("channel", _S),
                      ("created_at", _TS), ("delivery_slot_start", _TS), ("delivery_slot_end", _TS),
                      ("delivery_address_id", _S), ("promo_code", _S), ("_loaded_at", _TS)),
    "order_items": _schema(("order_item_id", _S), ("order_id", _S), ("product_id", _S),
                           ("quantity", _L), ("unit_price_gbp", _M), ("discount_amount_gbp", _M),
                           ("substituted_product_id", _S)),
    "products": _schema(("product_id", _S), ("sku", _S), ("product_name", _S), ("category", _S),
                        ("subcategory", _S), ("brand", _S), ("cost_price_gbp", _M), ("rrp_gbp", _M),
                        ("weight_kg", _M), ("is_alcohol", _B), ("is_age_restricted", _B),
                        ("is_active", _B)),
    "customers": _schema(("customer_id", _S), ("email", _S), ("first_name", _S), ("last_name", _S),
                         ("date_of_birth", _D), ("registered_at", _TS), ("postcode", _S),
                         ("city", _S), ("loyalty_tier", _S), ("is_active", _B), ("_loaded_at", _TS)),
    "promotions": _schema(("promo_id", _S), ("promo_code", _S), ("promo_type", _S),
                          ("discount_value", _M), ("min_basket_gbp", _M), ("valid_from", _D),
                          ("valid_to", _D), ("is_active", _B)),
    "inventory": _schema(("inventory_id", _S), ("product_id", _S), ("warehouse_id", _S),
                         ("snapshot_date", _D), ("units_on_hand", _L), ("units_reserved", _L),
                         ("units_in_transit", _L), ("reorder_point", _L), ("_loaded_at", _TS)),
}

RAW_TABLES = tuple(RAW_SCHEMAS)

RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", _S, True),
    T.StructField("elapsed_time", T.DoubleType(), True),
    T.StructField("results", T.ArrayType(T.StructType([
        T.StructField("status", _S, True),
        T.StructField("unique_id", _S, True),
    ])), True),
])

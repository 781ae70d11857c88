"""Dimension models (full refresh)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.functions import (date_spine, now_utc, product_tier, quarter_label, surrogate_key,
                              today, value_band, week_sunday)

DIM_CUSTOMERS_CLUSTER = ["loyalty_tier", "customer_segment"]
DIM_PRODUCTS_CLUSTER = ["category", "subcategory"]


def dim_customers(metrics: DataFrame, p) -> DataFrame:
    return metrics.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id", "email", "first_name", "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "loyalty_tier", "postcode", "registered_at",
        F.to_date("registered_at").alias("registration_date"),
        "is_active", "days_since_registration",
        "has_ordered", "total_orders", "orders_this_year", "lifetime_value_gbp",
        "avg_order_value_gbp", "first_order_date", "last_order_date", "days_since_last_order",
        "promo_orders_count", "lifetime_discount_gbp",
        "customer_segment",
        value_band("lifetime_value_gbp", p).alias("value_band"),
        "refreshed_at", now_utc(p).alias("dbt_updated_at"),
    )


def dim_products(metrics: DataFrame, p) -> DataFrame:
    return metrics.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id", "sku", "product_name", "category", "subcategory", "brand",
        "cost_price_gbp", "rrp_gbp", "is_active", "is_age_restricted",
        "orders_containing_product", "total_units_sold", "total_revenue_gbp",
        "total_discount_gbp", "avg_selling_price_gbp", "gross_margin_gbp", "gross_margin_pct",
        "times_substituted_away", "units_available", "is_below_reorder_point",
        product_tier("total_revenue_gbp", p).alias("product_tier"),
        "refreshed_at", now_utc(p).alias("dbt_updated_at"),
    )


def dim_date(spark: SparkSession, p, orders: DataFrame | None = None) -> DataFrame:
    """Calendar from ``start_date`` to ``as_of + 730 days``; with ``orders`` it
    starts with their first ``order_date``."""
    import datetime as dt
    end = p.as_of + dt.timedelta(days=p.date_spine_days_ahead)
    d = F.col("date_day")
    t = today(p)
    if orders is None:
        days = date_spine(spark, p.start_date, end, p.date_spine_include_end)
    else:
        last = end if p.date_spine_include_end else end - dt.timedelta(days=1)
        first = orders.agg(F.min("order_date").alias("first")).where(F.col("first") <= F.lit(last))
        days = first.select(F.explode(F.sequence("first", F.lit(last))).alias("date_day"))
    return days.select(
        d.alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        week_sunday(d).alias("week_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "yyyy-MM").alias("year_month"),
        quarter_label(d).alias("quarter_label"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
        (d == t).alias("is_today"),
        (d < t).alias("is_past"),
        # "on or before the first day of this month" (the reference's rule)
        (d <= F.trunc(t, "month")).alias("is_month_to_date"),
    )

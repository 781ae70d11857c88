"""Column-returning helpers used by the models."""

from larder.functions.bands import band, customer_segment, product_tier, stock_status, value_band
from larder.functions.dates import date_spine, now_utc, quarter_label, today, week_sunday
from larder.functions.keys import surrogate_key
from larder.functions.money import (MONEY, cents_to_pounds, exact_avg, money_avg, pct_change,
                                    revenue_metrics, safe_divide, to_int64, to_money)
from larder.functions.text import EMAIL_PATTERN, clean_text, is_valid_email, title_case

__all__ = [
    "band", "customer_segment", "product_tier", "stock_status", "value_band",
    "date_spine", "now_utc", "quarter_label", "today", "week_sunday",
    "surrogate_key",
    "MONEY", "cents_to_pounds", "exact_avg", "money_avg", "pct_change", "revenue_metrics", "safe_divide",
    "to_int64", "to_money",
    "EMAIL_PATTERN", "clean_text", "is_valid_email", "title_case",
]

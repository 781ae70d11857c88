"""Model invariants on the sf0.01 test data (counts as stated in SURVEY §5.3)."""

import pytest
from pyspark.sql import functions as F

from larder.params import TEST_PARAMS
from larder.plans.models import Models

from conftest import SF01


@pytest.fixture(scope="module")
def m(spark):
    return Models.from_testdata(spark, SF01, TEST_PARAMS)


def counts(df, col):
    return {r[0]: r[1] for r in df.groupBy(col).count().collect()}


def test_row_counts(m):
    assert m.stg["orders"].count() == 15000
    assert m.stg["order_items"].count() == 60000
    assert m.fact_orders.count() == 15000
    assert m.fact_order_items.count() == 60000


def test_orders_without_lines_keep_null_baskets(m):
    b = m.baskets
    assert b.where(F.col("item_line_count").isNull()).count() == 257
    assert b.where(F.col("item_line_count").isNull() & F.col("basket_value_gbp").isNotNull()).count() == 0


def test_line_totals_equal_basket_values(m):
    lines = m.stg["order_items"].agg(F.sum("line_total_gbp")).first()[0]
    baskets = m.baskets.agg(F.sum("basket_value_gbp")).first()[0]
    assert lines == baskets


def test_promo_matching(m):
    b = m.baskets
    assert b.where(F.col("promo_code").isNotNull()).count() == 4286
    assert b.where("has_promo").count() == 2429


def test_segments(m):
    assert counts(m.dim_customers, "customer_segment") == {
        "active": 60, "at_risk": 118, "lapsing": 173, "churned": 1078, "never_ordered": 71}


def test_value_bands(m):
    assert counts(m.dim_customers, "value_band") == {"high": 401, "mid": 649, "low": 375, "none": 75}


def test_product_tiers(m):
    assert counts(m.dim_products, "product_tier") == {"hero": 531, "core": 1045, "tail": 423, "no_sales": 1}


def test_cohort_months(m):
    assert m.customer_ltv.select("cohort_month").distinct().count() == 76


def test_alert_statuses_and_order(m):
    a = m.inventory_alerts
    assert set(counts(a, "stock_status")) <= {"out_of_stock", "critical", "low_stock"}
    statuses = [r[0] for r in a.select("stock_status").collect()]
    assert statuses == sorted(statuses)


def test_incremental_facts_are_recent_rows_of_full(m):
    inc = m.fact_orders_incremental
    full_recent = m.fact_orders.where(F.col("order_date") >= F.date_sub(F.lit(m.p.as_of), m.p.lookback_days))
    assert inc.exceptAll(full_recent).count() == 0 and full_recent.exceptAll(inc).count() == 0
    inc_i = m.fact_order_items_incremental
    full_i = m.fact_order_items.where(F.col("order_date") >= F.date_sub(F.lit(m.p.as_of), m.p.lookback_days))
    assert inc_i.exceptAll(full_i).count() == 0 and full_i.exceptAll(inc_i).count() == 0


def test_daily_sales_calendar_vs_rows_differ_only_on_gaps(m):
    rows = m.daily_sales
    assert rows.count() == 3342


def test_shuffle_paths_equal_broadcast_paths(spark):
    """With every size bound at zero the joins shuffle (null promo codes get
    stand-in keys); results must not change."""
    from conftest import SF001
    a = Models.from_testdata(spark, SF001, TEST_PARAMS)
    b = Models.from_testdata(spark, SF001, TEST_PARAMS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for attr in ("baskets", "fact_order_items", "fact_orders_incremental", "fact_order_items_incremental"):
            x, y = getattr(a, attr), getattr(b, attr)
            assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, attr
        plan = b.baskets._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

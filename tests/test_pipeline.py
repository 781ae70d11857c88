"""Full run publishes every model; an incremental replay of the lookback
window leaves the facts equal to a full rebuild (no older order changed)."""

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from larder.params import TEST_PARAMS
from larder.plans.models import Models
from larder.plans.pipeline import read_published, run_full, run_incremental, write_run_results

from conftest import SF001


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_full_then_incremental(spark, scratch):
    p = TEST_PARAMS
    m = Models.from_testdata(spark, SF001, p)
    # yesterday's state: the facts as of two days ago
    earlier = replace(p, as_of=p.as_of - dt.timedelta(days=2))
    old = Models.from_testdata(spark, SF001, earlier)
    root = f"{scratch}/wh"
    res = run_full(spark, old.raw, earlier, root)
    assert set(res["models"]) >= {"fact_orders", "dim_customers", "reporting_daily_sales"}
    fo = read_published(spark, root, "analytics", "fact_orders")
    assert fo.count() == m.fact_orders.count()
    # hourly run at as_of: only the lookback window is rewritten
    inc = run_incremental(spark, m.raw, p, root)
    assert inc["models"]["fact_orders"]["mode"] == "merge"
    fo = read_published(spark, root, "analytics", "fact_orders").drop("dbt_updated_at")
    assert same(fo.select(sorted(fo.columns)),
                m.fact_orders.drop("dbt_updated_at").select(sorted(fo.columns)))
    # line refreshed_at is the run's own timestamp (rows kept from the earlier
    # run carry the earlier one), so it is left out of the comparison
    audit = ["dbt_updated_at", "refreshed_at"]
    foi = read_published(spark, root, "analytics", "fact_order_items").drop(*audit)
    assert same(foi.select(sorted(foi.columns)),
                m.fact_order_items.drop(*audit).select(sorted(foi.columns)))
    ds = read_published(spark, root, "reporting", "daily_sales")
    assert ds.count() == old.daily_sales.count()
    assert read_published(spark, root, "reporting", "customer_ltv").where(F.col("cohort_month").isNull()).count() == 0


def test_dev_and_prod_runs_share_a_root(spark, scratch):
    p = TEST_PARAMS
    m = Models.from_testdata(spark, SF001, p)
    root = f"{scratch}/wh"
    run_full(spark, m.raw, p, root, with_tests=False)
    rows = read_published(spark, root, "analytics", "fact_orders").count()
    half = {**m.raw, "orders": m.raw["orders"].where(F.crc32(F.col("order_id").cast("string")) % 2 == 0)}
    run_full(spark, half, replace(p, target="dev"), root, with_tests=False)
    assert read_published(spark, root, "analytics", "fact_orders").count() == rows
    assert 0 < read_published(spark, root, "analytics", "fact_orders", "dev").count() < rows
    paths = {write_run_results(spark, root, "same", 1.0, [("pass", "x")], target) for target in ("dev", "prod")}
    assert len(paths) == 2


def test_run_results_documents(spark, scratch):
    from larder.plans.alerts import run_log_rollup
    from larder.sources.raw import read_run_log
    p = TEST_PARAMS
    m = Models.from_testdata(spark, SF001, p)
    root = f"{scratch}/wh"
    full = run_full(spark, m.raw, p, root, run_id="daily-1")
    inc = run_incremental(spark, m.raw, p, root, run_id="hourly-1")
    # every declared test and expectation runs; the raw channel and loyalty
    # tier values and the planted addresses fail on this data
    assert full["tests"] == 97 and full["tests_failed"] == 2 and inc["tests_failed"] == 0
    assert full["expectations"] == 28 and not full["expectations_passed"]
    assert full["freshness"] == inc["freshness"] == {"orders": "pass", "customers": "pass", "inventory": "pass"}
    assert len(full["stock_alerts"]) <= 15 and full["stock_alerts"][0]["alerts_listed"] > 20
    roll = {r.run_id: r for r in run_log_rollup(read_run_log(spark, f"{root}/_runs/*")).collect()}
    assert set(roll) == {"daily-1", "hourly-1"}
    assert roll["hourly-1"].errors == 0 and roll["hourly-1"].total == 3 + 2 + 12
    assert roll["daily-1"].errors == 2 + 1 and roll["daily-1"].total == 3 + 8 + 97 + 28


def test_a_dropped_declared_test_is_an_error(spark):
    import pytest
    from larder.plans.pipeline import run_published_tests
    with pytest.raises(ValueError, match="raw_orders"):
        run_published_tests(spark, {})

"""Clock, freshness gate, and the documents of failed runs."""

import datetime as dt
from dataclasses import replace

import pytest

from larder.functions import now_utc
from larder.operators import quality as Q
from larder.params import TEST_PARAMS, Params
from larder.plans import dimensions, facts
from larder.plans.models import Models
from larder.plans.pipeline import RunFailed, StaleSourceError, read_published, run_full, run_incremental
from larder.sources.raw import read_run_log

from conftest import SF001


def documents(spark, root):
    return {(r.run_id, r.unique_id): r.status for r in read_run_log(spark, f"{root}/_runs/*").collect()}


def test_the_clock_runs_unless_the_run_is_for_another_day():
    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    p = Params()
    assert before <= p.now_ts <= before + dt.timedelta(seconds=30) and p.now_ts is p.now_ts
    later = p.starting_now()
    assert later.now_ts >= p.now_ts and later == p and repr(later) == repr(p)
    assert Params(as_of=dt.date(2001, 8, 1)).now_ts == dt.datetime(2001, 8, 1)
    pinned = dt.datetime(2001, 8, 1, 5, 30)
    assert Params(as_of=dt.date(2001, 8, 1), as_of_ts=pinned).starting_now().now_ts == pinned


@pytest.mark.parametrize("age,status", [(24, "pass"), (30, "warn"), (70, "error")])
def test_freshness_at_eleven_at_night(spark, age, status):
    eleven = dt.datetime(2024, 5, 6, 23, 0)
    p = Params(as_of=eleven.date(), started_at=eleven)
    loads = spark.createDataFrame([(eleven - dt.timedelta(hours=age),)], "t timestamp")
    row = Q.freshness(loads, "t", p).first()
    assert row.status == status and row.age_hours == age
    assert loads.select(now_utc(p).alias("n")).first().n == eleven


def test_a_stale_source_stops_the_run(spark, scratch):
    m = Models.from_testdata(spark, SF001, TEST_PARAMS)
    root = f"{scratch}/wh"
    late = replace(TEST_PARAMS, as_of=TEST_PARAMS.as_of + dt.timedelta(days=9))
    for run, n in ((run_full, 8), (run_incremental, 2)):
        with pytest.raises(StaleSourceError, match="orders"):
            run(spark, m.raw, late, root, run_id=run.__name__)
        nodes = {u: st for (r, u), st in documents(spark, root).items() if r == run.__name__}
        assert nodes["source.larder.orders"] == "error"
        assert [st for u, st in nodes.items() if u.startswith("model.")] == ["skipped"] * n
    with pytest.raises(FileNotFoundError):
        read_published(spark, root, "analytics", "fact_orders")


def test_a_failed_model_leaves_a_document(spark, scratch, monkeypatch):
    m = Models.from_testdata(spark, SF001, TEST_PARAMS)
    root = f"{scratch}/wh"

    def broken(*_):
        raise ValueError("no such column")
    monkeypatch.setattr(dimensions, "dim_customers", broken)
    with pytest.raises(RunFailed, match="dim_customers") as e:
        run_full(spark, m.raw, TEST_PARAMS, root, run_id="daily")
    assert isinstance(e.value.__cause__, ValueError)
    nodes = {u: st for (_, u), st in documents(spark, root).items()}
    assert nodes["model.larder.dim_customers"] == "error"
    assert nodes["model.larder.reporting_customer_ltv"] == "skipped"
    # models that do not need it are published
    assert nodes["model.larder.fact_orders"] == nodes["model.larder.reporting_daily_sales"] == "success"
    assert read_published(spark, root, "reporting", "daily_sales").count() > 0
    assert len(nodes) == 3 + 8 + 97 and nodes["test.larder.unique_dim_customers_customer_id"] == "skipped"

    monkeypatch.setattr(facts, "fact_order_items", broken)
    with pytest.raises(RunFailed, match="fact_order_items"):
        run_incremental(spark, m.raw, TEST_PARAMS, root, with_tests=False, run_id="hourly")
    hourly = {u: st for (r, u), st in documents(spark, root).items() if r == "hourly"}
    assert hourly["model.larder.fact_order_items"] == "error" and hourly["model.larder.fact_orders"] == "success"


def test_a_run_without_tests_leaves_a_document(spark, scratch):
    m = Models.from_testdata(spark, SF001, TEST_PARAMS)
    res = run_full(spark, m.raw, TEST_PARAMS, f"{scratch}/wh", with_tests=False, run_id="plain")
    nodes = documents(spark, f"{scratch}/wh")
    assert res["run_results"].endswith("prod-plain") and len(nodes) == 3 + 8
    assert set(nodes.values()) == {"pass", "success"}

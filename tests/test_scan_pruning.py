"""What the hourly run and the stock queries read."""

import re

import pytest

from larder.params import TEST_PARAMS
from larder.plans.models import Models
from larder.sources.raw import RAW_BUCKET_KEYS, land_raw_tables, read_raw
from larder.operators.filters import latest_snapshot

from conftest import SF001


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def beyond_broadcast(spark):
    """No side is small enough to broadcast, every scan large enough for a
    runtime filter."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k in conf:
        spark.conf.unset(k)


@pytest.mark.parametrize("attr", ["fact_orders_incremental", "fact_order_items_incremental"])
def test_recent_orders_thin_the_lines_before_their_shuffle(beyond_broadcast, attr):
    m = Models.from_testdata(beyond_broadcast, SF001, TEST_PARAMS)
    text = plan(getattr(m, attr))
    lines = text.splitlines()
    tested = [i for i, line in enumerate(lines) if "might_contain" in line]
    assert tested and "bloom_filter_agg" in text
    # The filter's own child (beside the subquery that builds it) is the scan of
    # the lines, and the exchange of the lines comes above.
    def depth(line):
        return len(line) - len(line.lstrip(" :+-*"))
    at = tested[0]
    child = next(x for x in lines[at + 1:] if depth(x) == depth(lines[at]) + 3 and "Subquery" not in x)
    assert "FileScan" in child and "l_orderkey" in child
    above = [x for x in lines[:at] if re.search(r"\bExchange hashpartitioning\(order_id", x)]
    assert any(depth(x) < depth(lines[at]) for x in above)


def test_both_facts_share_the_recent_orders(spark):
    m = Models.from_testdata(spark, SF001, TEST_PARAMS)
    folders = [set(re.findall(r"recent-orders-[0-9a-f]+", m_plan)) for m_plan in
               (x._jdf.queryExecution().optimizedPlan().toString() + " ".join(x.inputFiles())
                for x in (m.fact_orders_incremental, m.fact_order_items_incremental))]
    assert folders[0] == folders[1] and len(folders[0]) == 1


def test_runtime_filter_changes_no_row(beyond_broadcast):
    m = Models.from_testdata(beyond_broadcast, SF001, TEST_PARAMS)
    assert m.fact_order_items_incremental.count() > 0
    full = m.fact_order_items.join(m.recent_orders.select("order_id"), "order_id", "left_semi")
    got = m.fact_order_items_incremental.select(full.columns)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0


def test_stock_queries_open_the_last_day_only(spark):
    plain = Models.from_testdata(spark, SF001, TEST_PARAMS)
    land_raw_tables(spark, {t: plain.raw[t] for t in RAW_BUCKET_KEYS}, "larder_test_days", 4)
    raw = {t: read_raw(spark, "table:larder_test_days", t) for t in RAW_BUCKET_KEYS}
    m = Models(spark, raw, TEST_PARAMS)
    for df, want in ((latest_snapshot(m.stg["inventory"], "snapshot_date"),
                      latest_snapshot(plain.stg["inventory"], "snapshot_date")),
                     (m.inventory_alert_rows, plain.inventory_alert_rows)):
        rows = df.select(want.columns)
        assert rows.exceptAll(want).count() == 0 and want.exceptAll(rows).count() == 0
        text = plan(df)
        pruned = re.findall(r"PartitionFilters: \[(.*?)\]", text)
        assert any("snapshot_date" in x and "ubquery" in x for x in pruned), text
    # The alert query reads stock and products, no sales.
    assert "quantity" not in plan(m.inventory_alert_rows)

import datetime as dt
from dataclasses import replace
from decimal import Decimal

from pyspark.sql import functions as F

from larder.operators.filters import latest_snapshot, limit_data_in_dev, since_lookback
from larder.operators.joins import lookup_join, materialize
from larder.operators.windows import keep_first, lag_days, lag_rows, rolling_days, rolling_rows
from larder.params import Params
from larder.plans.intermediate import latest_inventory
from larder.session import scale_conf
from larder.sources.raw import table_name

P = Params(as_of=dt.date(2024, 1, 10))
D = lambda d: dt.date(2024, 1, d)


def test_row_and_calendar_frames_differ_on_gaps(spark):
    # days 1, 2, 9 with revenue 1, 2, 4 (one channel)
    df = spark.createDataFrame([(D(1), "web", 1), (D(2), "web", 2), (D(9), "web", 4)], "d date, c string, v int")
    rows = {r.d: r for r in rolling_rows(lag_rows(df, "v", 1, ["c"], "d", "lag"), "v", 2, ["c"], "d", "roll")
            .collect()}
    cal = {r.d: r for r in rolling_days(lag_days(df, "v", 1, ["c"], "d", "lag"), "v", 2, ["c"], "d", "roll")
           .collect()}
    assert rows[D(9)].lag == 2 and cal[D(9)].lag is None      # previous row vs previous day
    assert rows[D(9)].roll == 6 and cal[D(9)].roll == 4       # 2 rows vs 2 calendar days
    assert cal[D(2)].lag == 1 and cal[D(2)].roll == 3


def test_lookback_and_dev_limit(spark):
    df = spark.createDataFrame([(D(6),), (D(7),), (D(10),)], "d date")
    assert sorted(r.d for r in since_lookback(df, "d", P).collect()) == [D(7), D(10)]
    assert limit_data_in_dev(df, "d", P).count() == 3
    dev = replace(P, target="dev")
    assert sorted(r.d for r in limit_data_in_dev(df, "d", dev, days=3).collect()) == [D(7), D(10)]


def test_latest_snapshot_and_inventory_ties(spark):
    rows = [(f"i{w}{d}", "p1", f"WH{w}", D(d), 10 * w + d, True) for w in range(4) for d in (1, 2)]
    inv = spark.createDataFrame(rows, "inventory_id string, product_id string, warehouse_id string, "
                                      "snapshot_date date, units_available int, is_below_reorder_point boolean")
    assert {r.snapshot_date for r in latest_snapshot(inv, "snapshot_date").collect()} == {D(2)}
    first = latest_inventory(inv).collect()
    assert len(first) == 1 and first[0].warehouse_id == "WH0" and first[0].snapshot_date == D(2)
    k = keep_first(inv, ["product_id"], [F.col("units_available").desc()]).first()
    assert k.units_available == 32


def test_lookup_join_paths_agree(spark):
    left = spark.createDataFrame([(1, "A"), (2, None), (3, "Z")], "id int, code string")
    right = spark.createDataFrame([("A", 10)], "code2 string, v int")
    as_set = lambda: sorted((r.id, r.v) for r in lookup_join(
        left, materialize(right, "right"), "code", "code2", salt_col="id").collect())
    small = as_set()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert as_set() == small == [(1, 10), (2, None), (3, None)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scale_conf_and_names():
    c = scale_conf(100 << 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)
    assert int(scale_conf(1 << 20, 8)["spark.sql.shuffle.partitions"]) == 16
    assert table_name("analytics", "prod", "fact_orders") == "larder_prod_analytics.fact_orders"


def test_money_types_in_staging(spark):
    from larder.plans.staging import stg_order_items
    raw = spark.createDataFrame([("l1", "o1", "p1", 3, Decimal("1.25"), None, None),
                                 ("l2", "o1", "p2", 2, Decimal("2.00"), Decimal("0.50"), "p9")],
                                "order_item_id string, order_id string, product_id string, quantity bigint, "
                                "unit_price_gbp decimal(18,2), discount_amount_gbp decimal(18,2), "
                                "substituted_product_id string")
    out = {r.order_item_id: r for r in stg_order_items(raw, P).collect()}
    assert out["l1"].line_total_gbp == Decimal("3.7500") and out["l2"].line_total_gbp == Decimal("3.5000")
    assert out["l2"].is_substituted and not out["l1"].is_substituted

"""Raw tables landed bucketed on their keys give the same models, and the
order-grain aggregate and the line-to-order join run without a shuffle."""

from larder.params import TEST_PARAMS
from larder.plans.models import Models
from larder.sources.raw import RAW_BUCKET_KEYS, land_raw_tables, read_raw

from conftest import SF001


def test_bucketed_raw_removes_order_shuffles(spark):
    plain = Models.from_testdata(spark, SF001, TEST_PARAMS)
    counts = land_raw_tables(spark, {t: plain.raw[t] for t in RAW_BUCKET_KEYS}, "larder_test_bucketed", 4)
    assert counts["order_items"] == plain.raw["order_items"].count()
    raw = {t: read_raw(spark, "table:larder_test_bucketed", t) for t in RAW_BUCKET_KEYS}
    b = Models(spark, raw, TEST_PARAMS)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for attr in ("baskets", "fact_order_items"):
            plan = getattr(b, attr)._jdf.queryExecution().executedPlan().toString()
            # only the lookups may shuffle (no broadcast here), never by order
            assert "Exchange hashpartitioning(order_id" not in plan, attr
        for attr in ("baskets", "fact_order_items", "dim_customers", "daily_sales"):
            x, y = getattr(plain, attr), getattr(b, attr)
            assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0, attr
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

"""Raw tables are landed side by side, with the rows they have one after another."""

import threading

import pytest
from pyspark.sql import functions as F

from larder.sources import raw as R


def _tables(spark):
    """Two tables with a null key and a key that most rows share."""
    keys = [None if k % 11 == 0 else "hot" if k % 2 else f"k{k}" for k in range(200)]
    return {"customers": spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "customer_id string, n int"),
            "products": spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "product_id string, n int"),
            "promotions": spark.createDataFrame([("a", 1), (None, 2)], "promo_id string, n int")}


def test_tables_are_landed_side_by_side(spark, scratch, monkeypatch):
    tables, meet = _tables(spark), threading.Barrier(2, timeout=60)
    sketch = R.hot_keys

    def sketch_together(*args):  # waits until the other keyed table is being landed too
        meet.wait()
        return sketch(*args)

    monkeypatch.setattr(R, "hot_keys", sketch_together)
    counts = R.land_raw_tables(spark, tables, "larder_test_beside", 4, location=scratch)
    assert counts == {"customers": 200, "products": 200, "promotions": 2} and list(counts) == list(tables)
    for name, df in tables.items():
        assert sorted(map(repr, spark.table(f"larder_test_beside.{name}").collect())) == sorted(map(repr, df.collect()))


def test_a_table_that_fails_to_land_is_an_error(spark, scratch):
    broken = _tables(spark)["customers"].withColumn("n", F.raise_error(F.lit("broken source")).cast("int"))
    with pytest.raises(Exception, match="broken source"):
        R.land_raw_tables(spark, dict(_tables(spark), customers=broken), "larder_test_broken", 4, location=scratch)

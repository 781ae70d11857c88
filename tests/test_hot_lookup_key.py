"""A lookup key that many rows share (one promotion code on a seventh of the
orders) is joined by several tasks long before Spark's own 256 MB."""

import pytest
from pyspark.sql import functions as F

from larder.operators.joins import lookup_join
from larder.session import apply_core_conf

ROWS = 400_000


@pytest.fixture()
def shuffled(spark):
    """Lookups shuffle, pieces of 4 MB; the library's own settings stand."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4m"}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    apply_core_conf(spark)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_lookup_key_is_split(shuffled):
    n = F.col("id")
    code = (F.when(n % 10 < 7, F.lit("HOT")).when(n % 10 == 7, F.lit(None).cast("string"))
            .otherwise(F.concat(F.lit("C"), (n % 1000).cast("string"))))
    left = shuffled.range(0, ROWS, 1, 8).select(
        n, code.alias("code"), F.concat(F.md5(n.cast("string")), F.md5((-n).cast("string"))).alias("text"))
    # The hot key is there twice, most others once, C8 not at all.
    right = shuffled.range(9, 1000, 1, 4).select(
        F.concat(F.lit("C"), n.cast("string")).alias("r"), n.alias("v")).unionByName(
        shuffled.createDataFrame([("HOT", 1), ("HOT", 2), (None, 3)], "r string, v bigint"))
    out = lookup_join(left, right, "code", "r", salt_col="id").agg(
        F.count(F.lit(1)), F.count("v"), F.sum("v"), F.sum(F.length("text")))
    got = tuple(out.collect()[0])
    # 256 MB before: one task read the 20 MB of the key.
    assert "skew=true" in out._jdf.queryExecution().executedPlan().toString()
    hot = ROWS * 7 // 10
    coded = [k for k in range(1000) if k % 10 > 7]
    found = [k for k in coded if k >= 9]
    each = ROWS // 1000
    rows = 2 * hot + ROWS // 10 + len(coded) * each
    assert got == (rows, 2 * hot + len(found) * each, 3 * hot + sum(found) * each, 64 * rows)

"""Landed tables have buckets of one size however large the input is, and the
models over many buckets are those over few."""

import datetime as dt
import hashlib

from larder.plans import registry
from larder.sources.testdata import TEST_SCHEMAS

MB = 1 << 20
DAY = dt.datetime(1997, 3, 1)


def _tables(spark, folder):
    orders = [(k, k % 5, "F" if k % 3 else "O", DAY + dt.timedelta(days=k % 20)) for k in range(1, 61)]
    orders += [(None, 1, "F", DAY), (7, 2, "F", DAY)]  # a null key, a key that is there twice
    lines = [(k, p, p % 4, n, 2.0, 30.0 + k, 0.05 * (n % 2), "R" if k % 2 else "N", DAY)
             for k in range(1, 61) for n, p in enumerate((k % 9, 3))] + [(None, 3, 1, 1, 1.0, 5.0, 0.0, "N", DAY)]
    rows = {"orders": orders, "lineitem": lines,
            "customer": [(k, f"Customer#{k}", 1000.0 * k, "BUILDING") for k in range(5)],
            "part": [(k, f"part {k}", "Brand#1", "PROMO", k, 10.0 + k) for k in range(9)]}
    for name, schema in TEST_SCHEMAS.items():
        spark.createDataFrame(rows[name], schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_bucket_input_does_not_grow_with_the_tables():
    for total in (50 * MB, 500 * MB, 3_000 * MB, 30_000 * MB):
        assert total / registry.landed_buckets(total) <= 8 * MB


def test_more_input_lands_in_more_buckets_with_the_same_models(spark, scratch, monkeypatch):
    queries = ("fact_order_items", "dim_products")
    few = _tables(spark, f"{scratch}/few")
    want = {q: _rows(registry.QUERIES[q](spark, few)) for q in queries}
    many = _tables(spark, f"{scratch}/many")
    monkeypatch.setattr(registry, "input_bytes", lambda *_: 150 * MB)
    raw = registry.landed_raw(spark, many)
    assert registry._m(spark, many).raw is raw
    # 8 buckets before.
    detail = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {_table(spark, 'products')}").collect()}
    assert int(detail["Num Buckets"]) >= 19
    assert {q: _rows(registry.QUERIES[q](spark, many)) for q in queries} == want


def _table(spark, name):
    """The landed table of the folder landed last."""
    key = list(registry._LANDED)[-1]
    return f"larder_landed_{hashlib.sha1(repr(key).encode()).hexdigest()[:10]}.{name}"

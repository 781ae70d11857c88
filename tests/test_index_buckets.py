"""An index bucket stays of one size however many keys there are."""

import datetime as dt

from larder.operators import key_index as K

DAY = dt.date(2024, 3, 1)


def test_index_bucket_does_not_grow_with_the_rows():
    for rows in (900_000, 9_000_000, 54_000_000, 1_000_000_000):
        assert rows / K.index_buckets(rows) <= 1_000_000  # 8 million before


def test_many_index_buckets_find_what_few_find(spark, scratch, monkeypatch):
    rows = [(None if k % 13 == 0 else f"o{k % 40}", DAY + dt.timedelta(days=k % 7)) for k in range(120)]
    table = spark.createDataFrame(rows, "surrogate_key string, order_date date")
    news = spark.createDataFrame([("o3", DAY), ("new", DAY), (None, DAY)], table.schema)

    def found(at):
        index = K.KeyIndex.build(table, at, "surrogate_key", "order_date")
        days = sorted(set(index.record(K.pairs(news, "surrogate_key", "order_date"))))
        return index.buckets, days, sorted(map(repr, spark.table(index.table).collect()))

    few = found(f"{scratch}/few")
    monkeypatch.setattr(K, "BUCKET_ROWS", 6)
    many = found(f"{scratch}/many")
    assert (few[0], many[0]) == (8, 20)
    assert few[1:] == many[1:] and few[1]

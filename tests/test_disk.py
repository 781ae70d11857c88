"""Disk that landing and the line fact take: shuffles are deleted once written out, narrow
rows are moved, many lines meet their products in turns, with the same rows."""

import datetime as dt
import os
import threading
import time

import pytest

from larder.operators import joins
from larder.params import TEST_PARAMS
from larder.plans import facts
from larder.plans.models import Models
from larder.session import FREE_SHUFFLES, shuffles_freed
from larder.sources.raw import RAW_BUCKET_KEYS, land_raw_tables, read_raw
from larder.sources.schemas import RAW_SCHEMAS
from larder.sources.testdata import TEST_SCHEMAS, derived_tables, raw_tables

DAY = dt.datetime(1997, 3, 1)


def rows(df):
    return sorted(map(repr, df.select(sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Null keys, keys that are there twice, an order and a product with many rows."""
    folder = tmp_path_factory.mktemp("tables")
    orders = [(k, k % 5, "F" if k % 3 else "O", DAY + dt.timedelta(days=k % 20)) for k in range(1, 301)]
    orders += [(None, 1, "F", DAY), (7, 2, "F", DAY), (9, None, None, None)]
    lines = [(k, p, p % 4, n, 2.0, 30.0 + k, 0.05 * (n % 2), "R" if k % 2 else "N", DAY)
             for k in range(1, 301) for n, p in enumerate((k % 29, 3))]
    lines += [(11, k % 29, 1, k, 1.0, 5.0, 0.0, "R", DAY) for k in range(400)]
    lines += [(None, 3, 1, 1, 1.0, 5.0, 0.0, "N", DAY), (5, None, 1, 9, 1.0, 5.0, 0.0, "N", None),
              (999, 4, 1, 1, 1.0, 5.0, 0.0, "N", DAY)] * 2
    parts = [(k, f"part {k}", "Brand#1", "PROMO", k, 10.0 + k) for k in range(27)]
    parts += [(3, "part 3 again", "Brand#2", "LARGE", 1, 1.0), (None, "no key", "Brand#3", "PROMO", 2, 2.0)]
    data = {"orders": orders, "lineitem": lines, "part": parts,
            "customer": [(k, f"Customer#{k}", 1000.0 * k, "BUILDING") for k in range(5)]}
    for name, schema in TEST_SCHEMAS.items():
        spark.createDataFrame(data[name], schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for _, _, names in os.walk(d.getPath()) for f in names if f.startswith("shuffle_")}


def gone(spark, before):
    """Whether no shuffle file is left beside those of before; deletion is asynchronous."""
    end = time.time() + 20
    while shuffle_files(spark) - before and time.time() < end:
        time.sleep(0.1)
    return not shuffle_files(spark) - before


def test_landed_tables_hold_the_derived_rows_and_no_shuffle_stays(spark, tables, scratch):
    plain, before = raw_tables(spark, tables), shuffle_files(spark)
    db = "larder_test_disk"
    counts = land_raw_tables(spark, derived_tables(spark, tables), db, 4, location=scratch)
    assert gone(spark, before)
    assert spark.conf.get(FREE_SHUFFLES) == "false"
    for name, df in plain.items():
        landed = read_raw(spark, f"table:{db}", name)
        assert counts[name] == df.count() and rows(landed) == rows(df), name
        assert [(f.name, f.dataType) for f in RAW_SCHEMAS[name]] == [(f.name, f.dataType) for f in df.schema]
        files = [f for _, _, names in os.walk(f"{scratch}/{name}") for f in names if f.endswith(".parquet")]
        assert files and all(f.endswith(".zstd.parquet") for f in files), name


def test_landing_moves_the_narrow_rows(spark, tables, scratch):
    """Each table is derived after its shuffle: no text made of a key is in it."""
    for name, raw in derived_tables(spark, tables).items():
        key = RAW_BUCKET_KEYS[name]
        if key:
            plan = raw.table(raw.rows.repartition(4, raw.columns[key]))._jdf.queryExecution().optimizedPlan().toString()
            above = plan[:plan.index("RepartitionByExpression")]
            assert "concat(" in above or "concat_ws(" in above, name
            assert plan.index("RepartitionByExpression") < plan.index("Relation"), name


def test_a_materialized_table_leaves_no_shuffle(spark, scratch):
    before = shuffle_files(spark)
    df = spark.range(50_000).selectExpr("id % 7777 AS k", "id AS v").groupBy("k").sum("v")
    out = joins.materialize(df, "test-disk")
    assert gone(spark, before) and rows(out) == rows(df)


def test_lines_meet_their_products_in_turns(spark, tables, monkeypatch):
    raw = {t: df.localCheckpoint() for t, df in raw_tables(spark, tables).items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain = Models(spark, raw, TEST_PARAMS).fact_order_items
        want = rows(plain)
        assert "Exchange" in plain._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(joins, "TURN_BYTES", 1)
        parts, write = [], joins.materialize_in_turns
        monkeypatch.setattr(facts, "materialize_in_turns", lambda p, name: parts.append(p) or write(p, name))
        before = shuffle_files(spark)
        turned = Models(spark, raw, TEST_PARAMS).fact_order_items
        assert gone(spark, before)
        assert len(parts[0]) == joins.MOST_TURNS
        assert "Exchange" not in turned._jdf.queryExecution().executedPlan().toString()
        assert turned.columns == plain.columns and rows(turned) == want
        # Every line of an order that exists is in one turn, none holds them all.
        sizes = [p.count() for p in parts[0]]
        assert sum(sizes) == len(want) and max(sizes) < len(want)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Products that are broadcast leave the lines where they are.
    assert joins.turns_of(raw["order_items"], raw["products"].limit(1)) == 1


def test_key_ranges_hold_every_key_once(spark):
    for keys in ([], [None], ["a"], ["a"] * 50 + [None], [f"K{k:04d}" for k in range(999)] + ["é", "z\U0001f600", ""]):
        df = spark.createDataFrame([(k,) for k in keys], "k string")
        ranges = joins.key_ranges(df, "k", 5)
        found = [k for r in ranges for (k,) in joins.in_range(df.where("k IS NOT NULL"), "k", *r).collect()]
        assert sorted(found) == sorted(k for k in keys if k is not None)
        assert len(ranges) <= 5


def test_overlapping_threads_restore_the_setting(spark):
    assert spark.conf.get(FREE_SHUFFLES) == "false"
    inside, leave = threading.Event(), threading.Event()

    def other():
        with shuffles_freed(spark):
            inside.set()
            leave.wait(30)

    thread = threading.Thread(target=other)
    with shuffles_freed(spark):
        thread.start()
        assert inside.wait(30)
    assert spark.conf.get(FREE_SHUFFLES) == "true"  # the other thread is still inside
    leave.set()
    thread.join(30)
    assert spark.conf.get(FREE_SHUFFLES) == "false"
    with pytest.raises(RuntimeError), shuffles_freed(spark):
        raise RuntimeError("broken write")
    assert spark.conf.get(FREE_SHUFFLES) == "false"

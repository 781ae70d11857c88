"""The key-to-day index behind upserts."""

import datetime as dt
import re

import pytest

from larder.operators import merge as M
from larder.operators.key_index import KeyIndex, index_entry, pairs
from larder.operators.merge import write_incremental
from larder.operators.sinks import current_folder, delete_paths, read_table

SCHEMA = "surrogate_key string, order_date date, v int, category string"


def day(n):
    return dt.date(2024, 1, 1) + dt.timedelta(days=n)


def frame(spark, rows):
    return spark.createDataFrame([(k, None if d is None else day(d), v, "x") for k, d, v in rows], SCHEMA)


def table(spark, path):
    return sorted(((r.surrogate_key, r.order_date, r.v) for r in read_table(spark, path).collect()), key=str)


def index_of(spark, path):
    folder = current_folder(spark, path)
    return KeyIndex(spark, folder, index_entry(spark, folder), "date")


def day_files(spark, path):
    """The files of each day."""
    found = read_table(spark, path).select("order_date", "_metadata.file_path").distinct().collect()
    return {r[0]: {f for d, f in found if d == r[0]} for r in found}


@pytest.fixture()
def published(spark, scratch):
    path = f"{scratch}/fact"
    write_incremental(spark, frame(spark, [(f"k{i}", i % 20, i) for i in range(200)] + [(None, 3, -1)]), path)
    return path


def test_lookup_reads_the_index_alone_and_never_shuffles_it(spark, published):
    index = index_of(spark, published)
    updates = pairs(frame(spark, [("k1", 5, 0), ("k2", 5, 0)]), "surrogate_key", "order_date")
    def scanned_files(df):
        # one field a line: the short node text ends before long paths
        return re.findall(r"Location: .*", df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))
    for threshold in ("-1", "10m"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            looked = index.places(updates)
            plan = looked._jdf.queryExecution().executedPlan().toString()
            files = scanned_files(looked)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        assert files and all("keys=" in f and "order_date=" not in f for f in files)
        index_side = plan[plan.index("FileScan parquet"):] if threshold == "-1" else plan
        assert f"Bucketed: true" in plan or threshold != "-1"
        if threshold == "-1":  # the updates alone are shuffled
            above = plan[:plan.index("FileScan parquet")].splitlines()
            assert not any("Exchange" in line for line in above) and index_side
        else:
            assert "BroadcastHashJoin" in plan
    assert {(r.day) for r in index.places(updates).collect()} == {day(1), day(2)}


def test_other_days_are_left_alone(spark, published):
    before = day_files(spark, published)
    stats = write_incremental(spark, frame(spark, [("k7", 9, 70), ("new", 11, 1)]), published)
    after = day_files(spark, published)
    changed = {name for name in after if after[name] != before.get(name)}
    assert changed == {day(d) for d in (7, 9, 11)} and stats["touched_partitions"] == 3
    got = {r[0]: r for r in table(spark, published)}
    assert got["k7"] == ("k7", day(9), 70) and got["new"] == ("new", day(11), 1) and len(got) == 202


def test_the_index_covers_every_row_after_any_upserts(spark, published):
    for step in range(4):
        rows = [(f"k{i}", (i + 7 * step) % 23, 1000 * step + i) for i in range(step, 200, 13)]
        rows += [(f"n{step}", None if step % 2 else 30, step), ("n0", step, step)][:2 if step else 1]
        write_incremental(spark, frame(spark, rows), published)
        keys = [r[0] for r in table(spark, published) if r[0] is not None]
        assert len(keys) == len(set(keys))
    known = {(r.h, r.day) for r in spark.table(index_of(spark, published).table).collect()}
    rows = {(r.h, r.day) for r in pairs(read_table(spark, published), "surrogate_key", "order_date").collect()}
    assert rows <= known


def test_a_crash_between_index_and_switch_loses_nothing(spark, published, monkeypatch):
    before = table(spark, published)
    with monkeypatch.context() as m:
        m.setattr(M, "stage_pending", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            write_incremental(spark, frame(spark, [("k1", 15, 9)]), published)
    assert table(spark, published) == before
    # The index names both places of k1 now; another move still takes it from the first.
    write_incremental(spark, frame(spark, [("k1", 16, 10)]), published)
    assert [r for r in table(spark, published) if r[0] == "k1"] == [("k1", day(16), 10)]


def test_a_table_without_an_index_gets_one(spark, published):
    folder = current_folder(spark, published)
    delete_paths(spark, [f"{folder}/{index_entry(spark, folder)}"])
    write_incremental(spark, frame(spark, [("k3", 19, 5)]), published)
    assert index_entry(spark, folder)
    assert [r for r in table(spark, published) if r[0] == "k3"] == [("k3", day(19), 5)]


def test_updates_without_keys_or_of_new_days_only(spark, published):
    n = len(table(spark, published))
    write_incremental(spark, frame(spark, [(None, 40, 1), (None, 40, 1)]), published)
    assert len(table(spark, published)) == n + 2

import datetime as dt

import pytest

from larder.operators import merge as M
from larder.operators.merge import DuplicateKeyError, merge_upsert, write_incremental
from larder.operators.sinks import current_folder, new_folder, path_exists, read_table, write_rows, write_table

SCHEMA = "surrogate_key string, order_date date, v int, category string"
D1, D2, D3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)


def rows(df):
    return sorted(((r.surrogate_key, r.order_date, r.v) for r in df.collect()), key=str)


def table(spark, path):
    return rows(read_table(spark, path))


def test_merge_upsert_lazy(spark):
    t = spark.createDataFrame([("a", D1, 1, "x"), ("b", D1, 2, "x")], SCHEMA)
    u = spark.createDataFrame([("b", D2, 20, "x"), ("c", D2, 3, "x"), (None, D2, 9, "x")], SCHEMA)
    out = sorted(((r.surrogate_key, r.order_date, r.v) for r in merge_upsert(t, u).collect()), key=str)
    assert ("b", D1, 2) not in out and ("b", D2, 20) in out and len(out) == 4


def test_write_incremental_create_update_insert_move(spark, scratch):
    path = f"{scratch}/fact"
    first = spark.createDataFrame([("a", D1, 1, "x"), ("b", D1, 2, "x"), ("c", D2, 3, "y")], SCHEMA)
    assert write_incremental(spark, first, path, cluster_by=["category"])["mode"] == "create"
    # b moves from D1 to D3 (update + partition move), d inserted, c updated in place
    upd = spark.createDataFrame([("b", D3, 22, "x"), ("c", D2, 33, "y"), ("d", D3, 4, "y")], SCHEMA)
    stats = write_incremental(spark, upd, path, cluster_by=["category"])
    assert stats["touched_partitions"] == 3
    assert table(spark, path) == [("a", D1, 1), ("b", D3, 22), ("c", D2, 33), ("d", D3, 4)]
    # applying the same updates again changes nothing
    write_incremental(spark, upd, path)
    assert table(spark, path) == [("a", D1, 1), ("b", D3, 22), ("c", D2, 33), ("d", D3, 4)]


def test_partition_emptied_by_move_is_removed(spark, scratch):
    path = f"{scratch}/fact"
    write_incremental(spark, spark.createDataFrame([("a", D1, 1, "x"), ("b", D2, 2, "x")], SCHEMA), path)
    stats = write_incremental(spark, spark.createDataFrame([("a", D2, 10, "x")], SCHEMA), path)
    assert stats["emptied_partitions"] == 1
    assert table(spark, path) == [("a", D2, 10), ("b", D2, 2)]


def test_duplicate_key_in_updates_raises(spark, scratch):
    path = f"{scratch}/fact"
    write_incremental(spark, spark.createDataFrame([("z", D1, 1, "x")], SCHEMA), path)
    dup = spark.createDataFrame([("a", D1, 1, "x"), ("a", D2, 2, "x")], SCHEMA)
    with pytest.raises(DuplicateKeyError):
        write_incremental(spark, dup, path)


def test_empty_updates_and_null_key(spark, scratch):
    path = f"{scratch}/fact"
    write_incremental(spark, spark.createDataFrame([("a", D1, 1, "x")], SCHEMA), path)
    stats = write_incremental(spark, spark.createDataFrame([], SCHEMA), path)
    assert stats["touched_partitions"] == 0
    write_incremental(spark, spark.createDataFrame([(None, D1, 5, "x")], SCHEMA), path)
    assert sorted(table(spark, path), key=str) == sorted([("a", D1, 1), (None, D1, 5)], key=str)


def test_null_days_stay_and_move(spark, scratch):
    path = f"{scratch}/fact"
    write = lambda rs: write_incremental(spark, spark.createDataFrame(rs, SCHEMA), path)
    write([("a", D1, 1, "x"), ("n1", None, 2, "x"), ("n2", None, 3, "x"), ("m", None, 4, "x")])
    write([("n3", None, 5, "x")])  # null to null: the others stay
    assert len(table(spark, path)) == 5
    write([("m", D1, 40, "x")])  # null to day
    write([("a", None, 10, "x")])  # day to null
    assert table(spark, path) == sorted([("a", None, 10), ("m", D1, 40), ("n1", None, 2), ("n2", None, 3),
                                         ("n3", None, 5)], key=str)


def test_crash_before_the_switch_changes_nothing(spark, scratch, monkeypatch):
    path = f"{scratch}/fact"
    write_incremental(spark, spark.createDataFrame([("a", D1, 1, "x"), ("b", D2, 2, "x")], SCHEMA), path)
    before = table(spark, path)

    def crash(*_):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(M, "stage_pending", crash)
        with pytest.raises(RuntimeError):
            write_incremental(spark, spark.createDataFrame([("a", D2, 9, "x")], SCHEMA), path)
    assert table(spark, path) == before
    write_incremental(spark, spark.createDataFrame([("a", D2, 9, "x")], SCHEMA), path)
    assert table(spark, path) == [("a", D2, 9), ("b", D2, 2)]


@pytest.mark.parametrize("step", ["replace_partitions", "drop_partitions", "delete_paths"])
def test_a_crash_while_days_are_put_in_place_is_repaired(spark, scratch, monkeypatch, step):
    path = f"{scratch}/fact"
    write_incremental(spark, spark.createDataFrame([("a", D1, 1, "x"), ("b", D2, 2, "x"), ("c", D3, 3, "x")], SCHEMA), path)
    real = getattr(M, step)

    def crash(*args):
        if step == "delete_paths" and "/pending" not in args[1][0]:
            return real(*args)
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(M, step, crash)
        with pytest.raises(RuntimeError):
            write_incremental(spark, spark.createDataFrame([("a", D2, 9, "x")], SCHEMA), path)
    # The next write, of another day, first completes the one that was cut off.
    write_incremental(spark, spark.createDataFrame([("c", D3, 30, "x")], SCHEMA), path)
    assert table(spark, path) == [("a", D2, 9), ("b", D2, 2), ("c", D3, 30)]
    assert not path_exists(spark, f"{current_folder(spark, path)}/pending")


def test_refresh_keeps_open_readers_and_clears_crashed_ones(spark, scratch):
    path = f"{scratch}/t"
    frame = lambda n: spark.range(n).toDF("v2")
    write_table(frame(1), path)
    first, reader = current_folder(spark, path), read_table(spark, path)
    crashed = new_folder(path)
    write_rows(frame(7), crashed, None)  # a refresh that never came to its switch
    assert read_table(spark, path).count() == 1
    write_table(frame(2), path)
    assert reader.count() == 1 and read_table(spark, path).count() == 2
    assert not path_exists(spark, crashed)
    write_table(frame(3), path)
    assert not path_exists(spark, first) and read_table(spark, path).count() == 3


def test_updates_replace_whole_days_by_spark_and_leave_the_others(spark, scratch):
    path = f"{scratch}/fact"
    write_incremental(spark, spark.createDataFrame([("a", D1, 1, "x"), ("b", D2, 2, "x")], SCHEMA), path)
    files = lambda: {r[0]: r[1] for r in read_table(spark, path).select("order_date", "_metadata.file_path").distinct().collect()}
    before = files()
    write_incremental(spark, spark.createDataFrame([("b", D2, 20, "x")], SCHEMA), path)
    after = files()
    assert after[D1] == before[D1] and after[D2] != before[D2]

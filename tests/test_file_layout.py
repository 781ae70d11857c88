"""Landing under hot keys, and interleaved clustering of files."""

import statistics
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from larder.operators.sinks import cluster_by_z_order, file_ranges, z_order_key
from larder.oracle import CTES, FINALS
from larder.params import TEST_PARAMS
from larder.plans.declared_tests import DECLARED, run_declared_tests, test_relations as relations_of
from larder.plans.models import Models
from larder.sources.raw import RAW_BUCKET_KEYS, hot_keys, land_raw_tables, read_raw
from larder.sources.testdata import raw_tables

from conftest import SF001
from test_skew import QUERIES, bag

BUCKETS = 16


@pytest.fixture(scope="module")
def hot_landed(spark, tmp_path_factory):
    """One order holds a third of all lines, another third has no order."""
    raw = raw_tables(spark, SF001)
    third = F.pmod(F.xxhash64("order_item_id"), F.lit(3))
    raw["order_items"] = raw["order_items"].withColumn(
        "order_id", F.when(third == 0, F.lit("ORD-00000001")).when(third == 1, F.lit(None)).otherwise(F.col("order_id")))
    plain = {}
    folder = tmp_path_factory.mktemp("plain")
    for name in RAW_BUCKET_KEYS:
        raw[name].write.parquet(f"{folder}/{name}")
        plain[name] = read_raw(spark, str(folder), name)
    counts = land_raw_tables(spark, plain, "larder_test_hot", BUCKETS, location=str(tmp_path_factory.mktemp("landed")))
    return plain, counts, str(folder)


def test_hot_and_null_keys_get_files_of_their_own(spark, hot_landed):
    plain, counts, _ = hot_landed
    total = plain["order_items"].count()
    assert counts["order_items"] == total
    assert {k for k, _ in hot_keys(plain["order_items"], "order_id", BUCKETS)} == {"ORD-00000001", None}
    assert hot_keys(plain["products"], "product_id", BUCKETS) == []
    landed = read_raw(spark, "table:larder_test_hot", "order_items")
    sizes = [r["count"] for r in landed.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > BUCKETS and max(sizes) <= 2 * statistics.median(sizes)
    # Read by even splits, not a bucket a task; other tables keep their buckets.
    assert "Bucketed: true" not in landed._jdf.queryExecution().executedPlan().toString()
    orders = read_raw(spark, "table:larder_test_hot", "orders")
    assert "SelectedBucketsCount" in orders.groupBy("order_id").count()._jdf.queryExecution().executedPlan().toString()
    # The files still hold each key in its own bucket.
    bucketed = spark.table("larder_test_hot.order_items").withColumn(
        "file", F.regexp_extract(F.input_file_name(), r"_(\d+)\.c", 1).cast("int"))
    assert bucketed.where(F.pmod(F.hash("order_id"), F.lit(BUCKETS)) != F.col("file")).count() == 0
    got = landed.select(plain["order_items"].columns)
    assert got.exceptAll(plain["order_items"]).count() == 0 and got.count() == total


def test_models_on_hot_buckets_match_sql(spark, hot_landed):
    _, _, folder = hot_landed
    m = Models(spark, {t: read_raw(spark, "table:larder_test_hot", t) for t in RAW_BUCKET_KEYS}, TEST_PARAMS)
    con = duckdb.connect()
    ctes = [(n, f"SELECT * FROM read_parquet('{folder}/{n[4:]}/*.parquet')") if n.startswith("raw_") else (n, q)
            for n, q in CTES]
    head = "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n"
    for key, attr in QUERIES.items():
        df, res = getattr(m, attr), con.execute(head + FINALS[key])
        cols = [d[0] for d in res.description]
        assert bag(df.columns, df.collect()) == bag(cols, res.fetchall()), key


def test_z_order_keeps_files_narrow_in_both_columns(spark, scratch):
    rows = spark.range(20_000).select(
        F.concat(F.lit("P-"), F.lpad((F.hash("id") % 1000 + 1000).cast("string"), 6, "0")).alias("product"),
        (F.xxhash64("id") % 500).cast("int").alias("day"), "id").withColumn(
        "day", F.when(F.col("id") % 50 == 0, F.lit(None)).otherwise(F.col("day")))
    matched = {}
    for kind in ("plain", "z"):
        path = f"{scratch}/{kind}"
        laid = rows.repartitionByRange(64, "product") if kind == "plain" else cluster_by_z_order(rows, ["product", "day"], 64, ["id"])
        laid.write.parquet(path)
        back = spark.read.schema(rows.schema).parquet(path)
        assert back.exceptAll(rows).count() == 0 and back.count() == 20_000
        ranges = file_ranges(back, ["product", "day"])
        matched[kind] = [ranges.where((F.col("max_day") >= low) & (F.col("min_day") <= low + 20)).count() for low in (-300, 0, 300)]
        if kind == "z":
            both = ranges.where((F.col("max_day") >= 100) & (F.col("min_day") <= 120)
                                & (F.col("max_product") >= "P-000500") & (F.col("min_product") <= "P-000520")).count()
            assert 0 < both <= 8
    assert max(matched["z"]) * 2 < min(matched["plain"])


def test_z_order_key_of_constant_and_null_columns(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, None)], "a string, b int")
    assert {r[0] for r in df.select(z_order_key(df, ["a", "b"])).collect()} <= {0, 1, 2, 3, 0b101010101010}
    empty = df.where("b > 5")
    assert cluster_by_z_order(empty, ["a", "b"]).count() == 0


def test_declared_tests_count_what_they_name(spark):
    rel = {"child": spark.createDataFrame(
        [(1, "a", "x"), (1, "a", None), (2, None, "y"), (None, "b", "x"), (None, "zz", "q"), (3, "zz", "q")],
        "k long, p string, s string"), "parent": spark.createDataFrame([("a",), (None,)], "id string")}
    declared = {"child": {"k": ["unique", "not_null"], "p": ["not_null", ("relationships", ("parent", "id"))],
                          "s": [("accepted_values", ("x",)), "unique"]}, "parent": {"id": ["unique", "not_null"]}}
    got = {r.test: (r.failures, r.status) for r in run_declared_tests(rel, declared).collect()}
    assert got == {"unique_child_k": (1, "fail"), "not_null_child_k": (2, "fail"), "not_null_child_p": (1, "fail"),
                   "relationships_child_p": (3, "fail"), "accepted_values_child_s": (2, "fail"),
                   "unique_child_s": (2, "fail"), "unique_parent_id": (0, "pass"), "not_null_parent_id": (1, "fail")}


def test_declared_tests_plan(spark):
    """Over plain tables: one exchange for all unique tests, none by Expand."""
    rel = {name: df.limit(0) if name == "dim_date" else df for name, df in
           relations_of(Models.from_testdata(spark, SF001, TEST_PARAMS)).items()}
    raw_only = {k: v for k, v in DECLARED.items() if k.startswith(("raw_", "stg_"))}
    plan = run_declared_tests(rel, raw_only)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert plan.count("Exchange hashpartitioning") <= 2 + 4  # by value, by test; two anti joins
    assert Counter(t for cols in raw_only.values() for ts in cols.values() for t in map(str, ts))["unique"] >= 16

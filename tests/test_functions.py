import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from larder.functions import (band, cents_to_pounds, clean_text, customer_segment, exact_avg,
                              is_valid_email, pct_change, product_tier, quarter_label, safe_divide,
                              stock_status, surrogate_key, title_case, value_band, week_sunday)
from larder.params import Params

P = Params()


def one(spark, col, rows, schema):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(col).collect()]


def test_clean_text_trims_all_whitespace(spark):
    out = one(spark, clean_text("s"), [("\t a b \n",), ("  x",), (None,)], "s string")
    assert out == ["a b", "x", None]


def test_title_case_punctuation(spark):
    out = one(spark, title_case("s"), [("anne-marie o'brien",), ("ST. JOHN_smith",), ("",), (None,)],
              "s string")
    assert out == ["Anne-Marie O'brien", "St. John_Smith", "", None]


def test_email_validity(spark):
    rows = [("a.b@example.com",), ("a@example",), ("a@example.c",), ("a b@example.com",), (None,)]
    assert one(spark, is_valid_email("s"), rows, "s string") == [True, False, False, False, None]


def test_surrogate_key_null_vs_empty(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "b")], "x string, y string")
    keys = [r[0] for r in df.select(surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 3
    import hashlib
    assert keys[2] == hashlib.md5(b"a-b").hexdigest()


def test_week_sunday_matches_strftime_U(spark):
    days = [dt.date(2000, 12, 31) + dt.timedelta(days=i) for i in range(0, 800, 3)]
    days += [dt.date(2024, 2, 29), dt.date(2023, 1, 1), dt.date(2022, 1, 1)]
    out = one(spark, week_sunday("d"), [(d,) for d in days], "d date")
    assert out == [int(d.strftime("%U")) for d in days]


def test_quarter_label(spark):
    out = one(spark, quarter_label("d"), [(dt.date(2024, 1, 1),), (dt.date(2024, 12, 31),)], "d date")
    assert out == ["Q1-2024", "Q4-2024"]


def test_safe_divide_and_pct_change(spark):
    df = spark.createDataFrame([(10.0, 0.0), (10.0, None), (10.0, 4.0)], "n double, d double")
    assert [r[0] for r in df.select(safe_divide("n", "d")).collect()] == [None, None, 2.5]
    assert [r[0] for r in df.select(pct_change("n", "d")).collect()] == [None, None, 150.0]


def test_cents_to_pounds(spark):
    out = one(spark, cents_to_pounds("p"), [(12345,), (5,), (None,)], "p bigint")
    assert out == [Decimal("123.45"), Decimal("0.05"), None]


def test_averages_ignore_nulls_and_round_half_up(spark):
    from larder.functions import money_avg
    df = spark.createDataFrame([(Decimal("1.10"),), (Decimal("2.20"),), (None,)], "x decimal(18,4)")
    assert df.agg(money_avg("x")).first()[0] == Decimal("1.650000")
    thirds = spark.createDataFrame([(Decimal("1"),), (Decimal("0"),), (Decimal("1"),)], "x decimal(18,4)")
    assert thirds.agg(money_avg("x")).first()[0] == Decimal("0.666667")
    ints = spark.createDataFrame([(1,), (2,), (None,)], "x bigint")
    assert ints.agg(exact_avg("x")).first()[0] == 1.5


def test_customer_segment_edges(spark):
    rows = [(30, 1), (31, 1), (90, 1), (91, 1), (180, 1), (181, 1), (None, None)]
    out = one(spark, customer_segment("d", "n", P), rows, "d int, n bigint")
    assert out == ["active", "at_risk", "at_risk", "lapsing", "lapsing", "churned", "never_ordered"]


def test_value_band_and_tier_edges(spark):
    rows = [(2000,), (1999,), (500,), (499,), (0,), (-5,)]
    assert one(spark, value_band("v", P), rows, "v int") == ["high", "mid", "mid", "low", "none", "none"]
    rows = [(10000,), (9999,), (1000,), (1,), (0,)]
    assert one(spark, product_tier("v", P), rows, "v int") == ["hero", "core", "core", "tail", "no_sales"]


def test_band_generic(spark):
    c = band("v", [("<", 0, "neg"), ("=", 0, "zero")], "pos")
    assert one(spark, c, [(-1,), (0,), (3,), (None,)], "v int") == ["neg", "zero", "pos", "pos"]


def test_stock_status_edges(spark):
    rows = [(0, 40, True), (-1, 40, True), (20, 40, True), (21, 40, True), (40, 40, True), (50, 40, False)]
    out = one(spark, stock_status("a", "r", "b"), rows, "a bigint, r bigint, b boolean")
    assert out == ["out_of_stock", "critical", "critical", "low_stock", "low_stock", "ok"]

"""Hot keys: one order holds a third of all lines, one product another
third, one customer a third of the orders, most orders have no promotion
code. The models must still equal the SQL oracle evaluated on the same
skewed tables (with AQE skew handling on and broadcasts disabled, so the
shuffle paths run)."""

import datetime as dt
import decimal
from collections import Counter

import duckdb
from pyspark.sql import functions as F

from larder.oracle import CTES, FINALS
from larder.params import TEST_PARAMS
from larder.plans.models import Models
from larder.sources.schemas import RAW_SCHEMAS
from larder.sources.testdata import raw_tables

from conftest import SF001

QUERIES = {"int_orders_basket": "baskets", "int_customers_orders": "customer_metrics",
           "int_products_performance": "product_metrics", "fact_order_items": "fact_order_items",
           "daily_sales": "daily_sales"}


def norm(v):
    if isinstance(v, decimal.Decimal):
        return str(v)
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def test_models_under_hot_keys(spark, scratch):
    raw = raw_tables(spark, SF001)
    third = F.abs(F.hash("order_item_id")) % 3
    items = (raw["order_items"]
             .withColumn("order_id", F.when(third == 0, F.lit("ORD-00000001")).otherwise(F.col("order_id")))
             .withColumn("product_id", F.when(third == 1, F.lit("PRD-0000001")).otherwise(F.col("product_id"))))
    orders = raw["orders"].withColumn(
        "customer_id", F.when(F.abs(F.hash("order_id")) % 3 == 0, F.lit("CUST-0000001")).otherwise(F.col("customer_id")))
    skewed = dict(raw, order_items=items, orders=orders)
    paths = {}
    for name, df in skewed.items():
        paths[name] = f"{scratch}/{name}"
        df.write.parquet(paths[name])
    landed = {name: spark.read.schema(RAW_SCHEMAS[name]).parquet(p) for name, p in paths.items()}
    m = Models(spark, landed, TEST_PARAMS)

    con = duckdb.connect()
    ctes = [(n, f"SELECT * FROM read_parquet('{paths[n[4:]]}/*.parquet')") if n.startswith("raw_") else (n, q)
            for n, q in CTES]
    with_ctes = "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes) + "\n"

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        hot_lines = m.stg["order_items"].where(F.col("order_id") == "ORD-00000001").count()
        assert hot_lines * 3 >= m.stg["order_items"].count() * 0.9
        for key, attr in QUERIES.items():
            df = getattr(m, attr)
            res = con.execute(with_ctes + FINALS[key])
            ocols = [d[0] for d in res.description]
            assert sorted(df.columns) == sorted(ocols), key
            assert bag(df.columns, df.collect()) == bag(ocols, res.fetchall()), key
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

"""Adapter from the TPC-H-shaped test tables to the six raw supermarket tables.

Every expression is plain SQL that Spark and DuckDB evaluate identically, so
the same text defines the Spark projection (``selectExpr``) and the oracle's
CTEs. Money is built through whole pence as decimal(18,2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.sources.raw import Derived
from larder.sources.schemas import RAW_SCHEMAS

_PENCE = "cast(cast(cast(floor({x}) as bigint) as decimal(18,0)) * cast(0.01 as decimal(3,2)) as decimal(18,2))"
_ORDER_ID = "concat('ORD-', lpad(cast({k} as string), 8, '0'))"
_PRODUCT_ID = "concat('PRD-', lpad(cast({k} as string), 7, '0'))"
_CUSTOMER_ID = "concat('CUST-', lpad(cast({k} as string), 7, '0'))"
_HOURS = "interval '1' hour * cast({n} as int)"

ADAPTER = {
    "orders": ("orders", None, [
        ("order_id", _ORDER_ID.format(k="o_orderkey")),
        ("customer_id", _CUSTOMER_ID.format(k="o_custkey")),
        ("status", "case when o_orderstatus = 'F' then 'delivered' when o_orderkey % 10 = 0 then 'cancelled' "
                   "when o_orderkey % 10 = 1 then 'returned' when o_orderstatus = 'O' then 'confirmed' "
                   "else 'pending' end"),
        ("channel", "case when o_orderkey % 10 < 5 then 'web' when o_orderkey % 10 < 9 then ' App ' "
                    "else 'PARTNER' end"),
        ("created_at", "o_orderdate + " + _HOURS.format(n="o_orderkey % 24")),
        ("delivery_slot_start", "o_orderdate + " + _HOURS.format(n="o_orderkey % 24 + 2 + o_orderkey % 47")),
        ("delivery_slot_end", "o_orderdate + " + _HOURS.format(n="o_orderkey % 24 + 4 + o_orderkey % 47")),
        ("delivery_address_id", "concat('ADDR-', lpad(cast(o_orderkey % 9999 + 1 as string), 5, '0'))"),
        ("promo_code", "case when o_orderkey % 7 = 0 then 'SAVE0000001' when o_orderkey % 7 = 1 then concat('SAVE', "
                       "lpad(cast(o_orderkey % 100003 + 1 as string), 7, '0')) end"),
        ("_loaded_at", "timestamp '2001-08-01 06:00:00' - " + _HOURS.format(n="o_orderkey % 30")),
    ]),
    "order_items": ("lineitem", None, [
        ("order_item_id", "concat_ws('-', 'ITEM', cast(l_orderkey as string), cast(l_linenumber as string), "
                          "cast(l_partkey as string), cast(l_suppkey as string), "
                          "cast(cast(l_shipdate as date) as string))"),
        ("order_id", _ORDER_ID.format(k="l_orderkey")),
        ("product_id", _PRODUCT_ID.format(k="l_partkey")),
        ("quantity", "cast(l_quantity as bigint)"),
        ("unit_price_gbp", _PENCE.format(x="l_extendedprice * 100 / l_quantity")),
        ("discount_amount_gbp", "case when l_discount = 0 then null else "
                                + _PENCE.format(x="l_extendedprice * l_discount * 100") + " end"),
        ("substituted_product_id", "case when l_returnflag = 'R' and (l_orderkey + l_linenumber) % 7 = 0 "
                                   "then " + _PRODUCT_ID.format(k="l_suppkey") + " end"),
    ]),
    "products": ("part", None, [
        ("product_id", _PRODUCT_ID.format(k="p_partkey")),
        ("sku", "concat('SKU-', lpad(cast(p_partkey as string), 9, '0'))"),
        ("product_name", "concat(' ', p_name, ' ')"),
        ("category", "p_type"),
        ("subcategory", "concat(p_type, ' ', cast(p_size % 5 as string))"),
        ("brand", "p_brand"),
        ("cost_price_gbp", _PENCE.format(x="p_retailprice * 60")),
        ("rrp_gbp", _PENCE.format(x="p_retailprice * 100")),
        ("weight_kg", "cast(cast(p_size as decimal(18,0)) * cast(0.1 as decimal(2,1)) as decimal(18,2))"),
        ("is_alcohol", "p_type = 'PROMO'"),
        ("is_age_restricted", "p_type = 'PROMO'"),
        ("is_active", "p_partkey % 20 <> 0"),
    ]),
    "customers": ("customer", None, [
        ("customer_id", _CUSTOMER_ID.format(k="c_custkey")),
        ("email", "case when c_custkey % 50 = 0 then concat('bad.address.', cast(c_custkey as string)) "
                  "else concat(' User', cast(c_custkey as string), '@Example.com ') end"),
        ("first_name", "concat(' ', lower(c_mktsegment))"),
        ("last_name", "replace(c_name, '#', ' ')"),
        ("date_of_birth", "date '1940-01-01' + cast(c_custkey % 14000 as int)"),
        ("registered_at", "timestamp '1994-01-01 00:00:00' + " + _HOURS.format(n="c_custkey * 37 % 60000")),
        ("postcode", "concat(' m', cast(c_custkey % 20 + 1 as string), ' 1ab')"),
        ("city", "'Manchester'"),
        ("loyalty_tier", "case when c_acctbal < 2500 then 'bronze' when c_acctbal < 5000 then 'silver' "
                         "when c_acctbal < 8000 then 'gold' else 'Platinum ' end"),
        ("is_active", "c_custkey % 12 <> 0"),
        ("_loaded_at", "timestamp '2001-08-01 06:00:00'"),
    ]),
    "promotions": ("part", None, [
        ("promo_id", "concat('PROMO-', lpad(cast(p_partkey + 1 as string), 7, '0'))"),
        ("promo_code", "concat(' save', lpad(cast(p_partkey + 1 as string), 7, '0'), ' ')"),
        ("promo_type", "case when p_partkey % 4 = 0 then 'pct_discount' when p_partkey % 4 = 1 "
                       "then 'fixed_discount' when p_partkey % 4 = 2 then 'bogo' else 'free_delivery' end"),
        ("discount_value", "cast(p_partkey % 26 as decimal(18,2))"),
        ("min_basket_gbp", "cast(p_partkey % 50 + 10 as decimal(18,2))"),
        ("valid_from", "date '2001-06-01' + cast(p_partkey % 40 * 3 as int)"),
        ("valid_to", "date '2001-06-15' + cast(p_partkey % 40 * 3 as int)"),
        ("is_active", "p_partkey % 3 <> 0"),
    ]),
    # part x 4 warehouses (wh, wn) x 2 snapshot days (dn)
    "inventory": ("part", None, [
        ("inventory_id", "concat_ws('-', 'INV', cast(p_partkey as string), cast(wn as string), cast(dn as string))"),
        ("product_id", _PRODUCT_ID.format(k="p_partkey")),
        ("warehouse_id", "wh"),
        ("snapshot_date", "date '2001-07-31' + dn"),
        ("units_on_hand", "(p_partkey * 7 + wn * 13 + dn * 5) % 200"),
        ("units_reserved", "(p_partkey * 7 + wn * 13 + dn * 5) % 200 % 10"),
        ("units_in_transit", "(p_partkey + wn) % 30"),
        ("reorder_point", "20 + p_partkey % 61"),
        ("_loaded_at", "timestamp '2001-08-01 06:00:00'"),
    ]),
}

# ---- fixed values: the warehouses and snapshot days of the test inventory ----
WAREHOUSES = [("WH-LONDON-01", 0), ("WH-MANC-01", 1), ("WH-BHAM-01", 2), ("WH-LEEDS-01", 3)]
SNAPSHOT_DAYS = [0, 1]
# -------------------------------------------------------------------------------

# The test-table columns the adapter reads, with their types. Declaring the
# schema skips the footer-inference job on every read and prunes the scan.
TEST_SCHEMAS = {
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_returnflag STRING, "
                "l_shipdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, "
            "p_retailprice DOUBLE",
}
_NEEDS = {t: [c.strip().split(" ")[0] for c in s.split(",")] for t, s in TEST_SCHEMAS.items()}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    df = spark.read.schema(TEST_SCHEMAS[table]).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
    return df


def derived_table(spark: SparkSession, sf_dir: str, name: str) -> Derived:
    """One raw supermarket table as expressions over a test table."""
    source, where, cols = ADAPTER[name]
    df = _read(spark, sf_dir, source)
    if where:
        df = df.where(where)
    # Conform to the declared raw schema (types and column order).
    exprs = dict(cols)
    columns = {f.name: F.expr(exprs[f.name]).cast(f.dataType) for f in RAW_SCHEMAS[name].fields}
    return Derived(df, columns, _stock_rows if name == "inventory" else None)


def _stock_rows(parts: DataFrame) -> DataFrame:
    """Fixed fan-out of every part row (x4 warehouses x2 days) with a generator; no
    join involved."""
    wh = F.array(*[F.struct(F.lit(w).alias("wh"), F.lit(n).alias("wn")) for w, n in WAREHOUSES])
    days = F.array(*[F.lit(d) for d in SNAPSHOT_DAYS])
    return (parts.select(*_NEEDS["part"], F.explode(wh).alias("w"))
            .select(*_NEEDS["part"], "w.wh", "w.wn", F.explode(days).alias("dn")))


def derived_tables(spark: SparkSession, sf_dir: str) -> dict[str, Derived]:
    return {name: derived_table(spark, sf_dir, name) for name in ADAPTER}


def raw_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One raw supermarket table derived from the test tables."""
    made = derived_table(spark, sf_dir, name)
    return made.table(made.rows)


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: raw_table(spark, sf_dir, name) for name in ADAPTER}


def adapter_ctes(sf_dir: str) -> list[tuple[str, str]]:
    """The same adapter as DuckDB CTEs named raw_<table> over the
    pre-registered test views (``sf_dir`` unused: views are registered)."""
    ctes = []
    for name, (source, where, cols) in ADAPTER.items():
        select = ", ".join(f"{expr} AS {col}" for col, expr in cols)
        if name == "inventory":
            values_w = ", ".join(f"('{w}', {n})" for w, n in WAREHOUSES)
            values_d = ", ".join(f"({d})" for d in SNAPSHOT_DAYS)
            frm = (f"part CROSS JOIN (VALUES {values_w}) w(wh, wn) "
                   f"CROSS JOIN (VALUES {values_d}) d(dn)")
        else:
            frm = source
        body = f"SELECT {select} FROM {frm}" + (f" WHERE {where}" if where else "")
        ctes.append((f"raw_{name}", body))
    return ctes

"""The reference's declared data tests on sources and models, run as Spark
jobs: unique, not_null, accepted_values and relationships.

``failures`` follows the usual test semantics: rows returned by the test
query — duplicated values (unique), null rows (not_null), distinct values
outside the set (accepted_values), orphan child rows (relationships)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from larder.operators.joins import materialize, relationships, source_bytes
from larder.plans.checks import (CUSTOMER_SEGMENTS, LOYALTY_TIERS, ORDER_CHANNELS, ORDER_STATUSES,
                                 PRODUCT_TIERS, PROMO_TYPES, STOCK_STATUSES, VALUE_BANDS)

U, NN = "unique", "not_null"


def AV(values):
    return ("accepted_values", tuple(values))


def REL(to, field):
    return ("relationships", (to, field))


# ---- fixed values: declared tests per relation and column ----
DECLARED = {
    "raw_orders": {"order_id": [U, NN], "customer_id": [NN], "status": [AV(ORDER_STATUSES)],
                   "created_at": [NN], "channel": [AV(ORDER_CHANNELS)]},
    "raw_order_items": {"order_item_id": [U, NN], "order_id": [NN], "product_id": [NN],
                        "quantity": [NN]},
    "raw_products": {"product_id": [U, NN], "sku": [U, NN]},
    "raw_customers": {"customer_id": [U, NN], "email": [U, NN], "loyalty_tier": [AV(LOYALTY_TIERS)]},
    "raw_inventory": {"inventory_id": [U, NN], "product_id": [NN]},
    "raw_promotions": {"promo_id": [U, NN], "promo_code": [U, NN], "promo_type": [AV(PROMO_TYPES)]},
    "stg_orders": {"order_id": [U, NN], "customer_id": [NN], "order_status": [AV(ORDER_STATUSES)],
                   "order_channel": [AV(ORDER_CHANNELS)], "refreshed_at": [NN]},
    "stg_order_items": {"order_item_id": [U, NN],
                        "order_id": [NN, REL("stg_orders", "order_id")],
                        "product_id": [NN, REL("stg_products", "product_id")],
                        "quantity": [NN]},
    "stg_products": {"product_id": [U, NN], "sku": [U, NN]},
    "stg_customers": {"customer_id": [U, NN], "email": [U, NN], "loyalty_tier": [AV(LOYALTY_TIERS)]},
    "stg_inventory": {"inventory_id": [U, NN], "product_id": [NN]},
    "stg_promotions": {"promo_id": [U, NN], "promo_code": [U, NN], "promo_type": [AV(PROMO_TYPES)]},
    "int_orders_basket": {"order_id": [NN, U], "customer_id": [NN], "order_date": [NN]},
    "int_customers_orders": {"customer_id": [NN, U], "customer_segment": [AV(CUSTOMER_SEGMENTS)]},
    "int_products_performance": {"product_id": [NN, U]},
    "fact_orders": {"surrogate_key": [U, NN], "order_id": [U, NN], "customer_id": [NN],
                    "order_date": [NN]},
    "fact_order_items": {"surrogate_key": [U, NN], "order_item_id": [U, NN], "order_id": [NN],
                         "product_id": [NN]},
    "dim_customers": {"customer_key": [U, NN], "customer_id": [U, NN],
                      "customer_segment": [AV(CUSTOMER_SEGMENTS)], "value_band": [AV(VALUE_BANDS)]},
    "dim_products": {"product_key": [U, NN], "product_id": [U, NN], "product_tier": [AV(PRODUCT_TIERS)]},
    "dim_date": {"date_id": [U, NN], "full_date": [U, NN]},
    "daily_sales": {"order_date": [NN]},
    "inventory_alerts": {"stock_status": [AV(STOCK_STATUSES)]},
    "customer_ltv": {"cohort_month": [NN]},
}
# ----------------------------------------------------------------


def declared_list(declared=None):
    """Flat list of (relation, column, test, arg) in declaration order."""
    out = []
    for rel, cols in (declared or DECLARED).items():
        for col, tests in cols.items():
            for t in tests:
                name, arg = (t, None) if isinstance(t, str) else t
                out.append((rel, col, name, arg))
    return out


def test_name(rel, col, name):
    return f"{name}_{rel}_{col}"


def _lit(v) -> str:
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def findings(df: DataFrame, tests: list) -> DataFrame:
    """(test_order, h1, h2) of one relation in one pass: a null row's mark
    (not_null), a value outside the set (accepted_values), every value of a
    column that must be unique. Rows without a finding give none. Values travel
    as two hashes of 64 bits; values are taken for one if all 128 bits agree."""
    cells = []
    for i, (_, col, name, arg) in tests:
        value = "''" if name == "not_null" else f"cast(`{col}` as string)"
        hit = (f"`{col}` IS NULL" if name == "not_null" else f"`{col}` IS NOT NULL" if name == "unique"
               else f"`{col}` NOT IN ({', '.join(_lit(v) for v in arg)})")
        cells.append(f"CASE WHEN {hit} THEN named_struct('test_order', {i}, 'h1', xxhash64({value}), "
                     f"'h2', xxhash64({i}, {value})) END")
    return df.selectExpr(f"inline(array_compact(array({', '.join(cells)}))) AS (test_order, h1, h2)")


#: Bytes of files behind the tests that are counted together.
GROUP_BYTES = 256 << 20


def groups(relations: dict, tests: list) -> list[list[DataFrame]]:
    """Findings of all tests, by what is counted together: the tests of relations
    of ``GROUP_BYTES`` of files in all; of a larger relation each unique test and
    each relationship alone (every row has a value), all others in one scan."""
    by_rel: dict[str, list] = {}
    for i, t in enumerate(tests):
        by_rel.setdefault(t[0], []).append((i, t))
    out, small, held = [], [], 0
    for rel, items in by_rel.items():
        size = source_bytes(relations[rel])
        alone = [[x] for x in items if x[1][2] in ("unique", "relationships")]
        rest = [x for x in items if x[1][2] not in ("unique", "relationships")]
        if size > GROUP_BYTES:
            out += [_findings(relations, g) for g in (*alone, rest) if g]
            continue
        if held + size > GROUP_BYTES:
            out, small, held = [*out, small], [], 0
        small, held = small + _findings(relations, items), held + size
    return [*out, small] if small else out


def _findings(relations: dict, items: list) -> list[DataFrame]:
    """Findings of some tests of one relation."""
    scanned = [x for x in items if x[1][2] != "relationships"]
    parts = [findings(relations[scanned[0][1][0]], scanned)] if scanned else []
    zero = F.lit(0).cast("long")
    for i, (rel, col, name, arg) in items:
        if name == "relationships":
            orphans = relationships(relations[rel], col, relations[arg[0]], arg[1])
            parts.append(orphans.select(F.lit(i).alias("test_order"), zero.alias("h1"), zero.alias("h2")))
    return parts


def _counts(found: DataFrame) -> DataFrame:
    """Per test with findings: rows, distinct values and repeated values."""
    counted = found.groupBy("test_order", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("test_order").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("values"), F.count_if(F.col("n") > 1).alias("repeated"))


def run_declared_tests(relations: dict, declared=None) -> DataFrame:
    """test_order, relation, column, test, failures, status: one row per
    declared test.

    The findings of a group of tests meet in one grouped count by (test, value), counted
    map-side first, so a hot value or a column of nulls is one row a task. Small
    relations are one group, scanned once, and once more for each relationship
    they take part in. Where there are more groups (``groups``), they are
    counted one after another and their counts (a row a test) written, so that the disk
    holds the values of one group at a time."""
    tests = declared_list(declared or DECLARED)
    spark = next(iter(relations.values())).sparkSession
    counts = [_counts(reduce(DataFrame.union, parts)) for parts in groups(relations, tests)]
    if len(counts) > 1:
        counts = [materialize(c, "tested-counts") for c in counts]
    per_test = reduce(DataFrame.union, counts)
    names = spark.createDataFrame(
        [(i, rel, col, test_name(rel, col, name), name) for i, (rel, col, name, _) in enumerate(tests)],
        "test_order int, relation string, column string, test string, kind string")
    failures = F.coalesce(F.when(F.col("kind") == "unique", F.col("repeated"))
                          .when(F.col("kind") == "accepted_values", F.col("values"))
                          .otherwise(F.col("rows")), F.lit(0).cast("long"))
    # One row for each declared test on both sides.
    return (names.join(F.broadcast(per_test), "test_order", "left").withColumn("failures", failures)
            .select("test_order", "relation", "column", "test", "failures",
                    F.when(F.col("failures") == 0, "pass").otherwise("fail").alias("status")))


def test_relations(m) -> dict:
    """Every relation named in the declarations, from a Models graph."""
    rel = {f"raw_{k}": m.raw[k] for k in m.raw.keys()}
    rel.update({f"stg_{k}": m.stg[k] for k in m.stg.keys()})
    rel.update({
        "int_orders_basket": m.baskets, "int_customers_orders": m.customer_metrics,
        "int_products_performance": m.product_metrics, "fact_orders": m.fact_orders,
        "fact_order_items": m.fact_order_items, "dim_customers": m.dim_customers,
        "dim_products": m.dim_products, "dim_date": m.dim_date, "daily_sales": m.daily_sales,
        "inventory_alerts": m.inventory_alert_rows, "customer_ltv": m.customer_ltv,
    })
    return rel

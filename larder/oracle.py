"""Independent SQL (DuckDB dialect) definition of every registered query.

Used as the correctness oracle: the driver runs these strings on the same
test tables and compares with the Spark DataFrames. Written directly from
the model definitions, sharing only the test-data adapter text (the input
definition) with the Spark side.

Parity notes (DuckDB vs Spark): DuckDB divides decimals in DOUBLE, so
percentages that Spark computes in exact decimals are emulated with integer
arithmetic (half-up rounding at 6 places, then at 2); sums are cast to the
Spark result types; day of week is shifted to 1 = Sunday.
"""

from __future__ import annotations

from larder.functions.keys import KEY_SEPARATOR, NULL_SENTINEL
from larder.functions.text import EMAIL_PATTERN, TITLE_DELIMITERS
from larder.params import TEST_PARAMS as P
from larder.plans.checks import STAGING_SUITES
from larder.sources.testdata import adapter_ctes

AS_OF = f"DATE '{P.as_of.isoformat()}'"
NOW = f"TIMESTAMP '{P.now_ts.strftime('%Y-%m-%d %H:%M:%S')}'"
VB_HI, VB_MID = P.value_bands
PT_HERO, PT_CORE = P.product_tiers


def trim(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


_DELIM_RE = "[\\s" + "".join("\\" + ch for ch in TITLE_DELIMITERS if ch != " ") + "]"
_DELIM_RE_SQL = _DELIM_RE.replace("'", "''")


def initcap(x: str) -> str:
    """Character-wise: upper after a delimiter or at the start, else lower."""
    return (f"array_to_string(list_transform(range(1, length({x}) + 1), lambda i: "
            f"CASE WHEN i = 1 OR regexp_matches(substr({x}, i - 1, 1), '{_DELIM_RE_SQL}') "
            f"THEN upper(substr({x}, i, 1)) ELSE lower(substr({x}, i, 1)) END), '')")


def week(d: str) -> str:
    return f"cast(strftime({d}, '%U') AS INTEGER)"


def skey(*cols: str) -> str:
    parts = ", ".join(f"coalesce(cast({c} AS VARCHAR), '{NULL_SENTINEL}')" for c in cols)
    return f"md5(concat_ws('{KEY_SEPARATOR}', {parts}))"


def _rhu(a: str, b: str) -> str:
    """round-half-up(a / b) for integers a, b."""
    return f"(sign({a}) * sign({b}) * ((abs({a}) * 2 + abs({b})) // (2 * abs({b}))))"


def exact_pct(num: str, den: str) -> str:
    """Spark's round(num / den * 100, 2) on scale-4 decimals: quotient
    rounded half-up to 6 places, times 100, rounded half-up to 2 places."""
    n = f"cast(({num}) * 10000 AS HUGEINT)"
    d = f"cast(({den}) * 10000 AS HUGEINT)"
    q6 = _rhu(f"({n} * 1000000)", d)
    p2 = _rhu(f"({q6} * 100)", "10000")
    return f"cast(cast({p2} AS DECIMAL(35,0)) * cast(0.01 AS DECIMAL(3,2)) AS DECIMAL(35,2))"


def avg(x: str) -> str:
    """Integer column: exact sum / count as DOUBLE."""
    return f"cast(sum({x}) AS DOUBLE) / count({x})"


def mavg(x: str) -> str:
    """Decimal money column: exact sum / count, half-up at 6 places."""
    q = _rhu(f"cast(sum({x}) * 1000000 AS HUGEINT)", f"count({x})")
    return f"cast(cast({q} AS DECIMAL(38,0)) * cast(0.000001 AS DECIMAL(7,6)) AS DECIMAL(38,6))"


M4 = "DECIMAL(18,4)"

CTES: list[tuple[str, str]] = adapter_ctes("")

CTES += [
    ("stg_orders", f"""
SELECT cast(order_id AS VARCHAR) AS order_id, cast(customer_id AS VARCHAR) AS customer_id,
  cast(delivery_address_id AS VARCHAR) AS delivery_address_id, cast(promo_code AS VARCHAR) AS promo_code,
  cast(created_at AS TIMESTAMP) AS order_created_at,
  cast(delivery_slot_start AS TIMESTAMP) AS delivery_slot_start_at,
  cast(delivery_slot_end AS TIMESTAMP) AS delivery_slot_end_at,
  cast(_loaded_at AS TIMESTAMP) AS refreshed_at,
  lower({trim('status')}) AS order_status, lower({trim('channel')}) AS order_channel
FROM raw_orders"""),
    ("stg_order_items", f"""
SELECT order_item_id, order_id, product_id, substituted_product_id,
  cast(round(quantity) AS BIGINT) AS quantity,
  cast(unit_price_gbp AS {M4}) AS unit_price_gbp,
  cast(discount_amount_gbp AS {M4}) AS discount_amount_gbp,
  cast(cast(quantity AS DECIMAL(20,0)) * cast(unit_price_gbp AS {M4})
       - coalesce(cast(discount_amount_gbp AS {M4}), 0) AS {M4}) AS line_total_gbp,
  substituted_product_id IS NOT NULL AS is_substituted,
  {NOW} AS refreshed_at
FROM raw_order_items"""),
    ("stg_products", f"""
SELECT product_id, sku, cast(cost_price_gbp AS {M4}) AS cost_price_gbp, cast(rrp_gbp AS {M4}) AS rrp_gbp,
  cast(weight_kg AS {M4}) AS weight_kg, is_alcohol, is_age_restricted, is_active,
  {trim('product_name')} AS product_name, lower({trim('category')}) AS category,
  lower({trim('subcategory')}) AS subcategory, lower({trim('brand')}) AS brand,
  {NOW} AS refreshed_at
FROM raw_products"""),
    ("stg_customers", f"""
SELECT customer_id, cast(date_of_birth AS DATE) AS date_of_birth, is_active,
  cast(_loaded_at AS TIMESTAMP) AS refreshed_at, cast(registered_at AS TIMESTAMP) AS registered_at,
  lower({trim('email')}) AS email, {initcap(trim('first_name'))} AS first_name,
  {initcap(trim('last_name'))} AS last_name, upper({trim('postcode')}) AS postcode,
  lower({trim('loyalty_tier')}) AS loyalty_tier,
  cast(date_diff('day', cast(registered_at AS DATE), {AS_OF}) AS INTEGER) AS days_since_registration
FROM raw_customers"""),
    ("stg_inventory", f"""
SELECT inventory_id, product_id, warehouse_id, cast(snapshot_date AS DATE) AS snapshot_date,
  cast(round(units_on_hand) AS BIGINT) AS units_on_hand, cast(round(units_reserved) AS BIGINT) AS units_reserved,
  cast(round(units_in_transit) AS BIGINT) AS units_in_transit, cast(round(reorder_point) AS BIGINT) AS reorder_point,
  cast(_loaded_at AS TIMESTAMP) AS refreshed_at,
  cast(round(units_on_hand) AS BIGINT) - cast(round(units_reserved) AS BIGINT) AS units_available,
  cast(round(units_on_hand) AS BIGINT) <= cast(round(reorder_point) AS BIGINT) AS is_below_reorder_point
FROM raw_inventory"""),
    ("stg_promotions", f"""
SELECT promo_id, cast(discount_value AS {M4}) AS discount_value, cast(min_basket_gbp AS {M4}) AS min_basket_gbp,
  cast(valid_from AS DATE) AS valid_from, cast(valid_to AS DATE) AS valid_to, is_active,
  upper({trim('promo_code')}) AS promo_code, lower({trim('promo_type')}) AS promo_type,
  cast(valid_to AS DATE) >= {AS_OF} AND is_active = true AS is_currently_valid,
  {NOW} AS refreshed_at
FROM raw_promotions"""),
    ("basket_agg", """
SELECT order_id, count(*) AS item_line_count, cast(sum(quantity) AS BIGINT) AS total_units,
  cast(sum(line_total_gbp) AS DECIMAL(28,4)) AS basket_value_gbp,
  cast(sum(discount_amount_gbp) AS DECIMAL(28,4)) AS total_discount_gbp,
  count(*) FILTER (WHERE is_substituted) AS substituted_line_count,
  cast(sum(line_total_gbp) + sum(coalesce(discount_amount_gbp, 0)) AS DECIMAL(29,4)) AS gross_basket_gbp
FROM stg_order_items GROUP BY order_id"""),
    ("int_orders_basket", f"""
SELECT o.order_id, o.customer_id, o.order_status, o.order_channel, o.order_created_at,
  o.delivery_slot_start_at, o.delivery_slot_end_at, o.promo_code, o.refreshed_at,
  b.item_line_count, b.total_units, b.basket_value_gbp, b.total_discount_gbp, b.gross_basket_gbp,
  b.substituted_line_count, p.promo_type, p.discount_value AS promo_discount_value,
  o.order_status = 'delivered' AS is_delivered, o.order_status = 'cancelled' AS is_cancelled,
  o.order_status = 'returned' AS is_returned, p.promo_id IS NOT NULL AS has_promo,
  cast(o.order_created_at AS DATE) AS order_date,
  cast(year(o.order_created_at) AS INTEGER) AS order_year,
  cast(month(o.order_created_at) AS INTEGER) AS order_month,
  {week('o.order_created_at')} AS order_week,
  cast(hour(o.order_created_at) AS INTEGER) AS order_hour
FROM stg_orders o LEFT JOIN basket_agg b ON o.order_id = b.order_id
LEFT JOIN stg_promotions p ON o.promo_code = p.promo_code"""),
    ("customer_order_agg", f"""
SELECT customer_id, count(*) AS total_orders,
  count(*) FILTER (WHERE order_year = year({AS_OF})) AS orders_this_year,
  cast(sum(basket_value_gbp) AS DECIMAL(38,4)) AS lifetime_value_gbp,
  {mavg('basket_value_gbp')} AS avg_order_value_gbp,
  min(order_date) AS first_order_date, max(order_date) AS last_order_date,
  cast(date_diff('day', max(order_date), {AS_OF}) AS INTEGER) AS days_since_last_order,
  count(*) FILTER (WHERE has_promo) AS promo_orders_count,
  cast(sum(total_discount_gbp) AS DECIMAL(38,4)) AS lifetime_discount_gbp
FROM int_orders_basket WHERE is_delivered GROUP BY customer_id"""),
    ("int_customers_orders", f"""
SELECT c.customer_id, c.email, c.first_name, c.last_name, c.loyalty_tier, c.registered_at, c.postcode,
  c.is_active, c.days_since_registration, c.refreshed_at, a.first_order_date, a.last_order_date,
  coalesce(a.total_orders, 0) AS total_orders, coalesce(a.orders_this_year, 0) AS orders_this_year,
  coalesce(a.lifetime_value_gbp, 0) AS lifetime_value_gbp,
  cast(coalesce(a.avg_order_value_gbp, 0) AS DECIMAL(38,6)) AS avg_order_value_gbp,
  coalesce(a.days_since_last_order, 9999) AS days_since_last_order,
  coalesce(a.promo_orders_count, 0) AS promo_orders_count,
  coalesce(a.lifetime_discount_gbp, 0) AS lifetime_discount_gbp,
  CASE WHEN a.days_since_last_order <= 30 THEN 'active'
       WHEN a.days_since_last_order <= 90 THEN 'at_risk'
       WHEN a.days_since_last_order <= 180 THEN 'lapsing'
       WHEN a.total_orders IS NULL THEN 'never_ordered'
       ELSE 'churned' END AS customer_segment,
  a.total_orders IS NOT NULL AS has_ordered
FROM stg_customers c LEFT JOIN customer_order_agg a ON c.customer_id = a.customer_id"""),
    ("latest_inventory", """
SELECT * FROM stg_inventory
QUALIFY row_number() OVER (PARTITION BY product_id
                           ORDER BY snapshot_date DESC, warehouse_id ASC, inventory_id ASC) = 1"""),
    ("product_sales", f"""
SELECT i.product_id, count(DISTINCT o.order_id) AS orders_containing_product,
  cast(sum(i.quantity) AS BIGINT) AS total_units_sold,
  cast(sum(i.line_total_gbp) AS DECIMAL(28,4)) AS total_revenue_gbp,
  cast(sum(i.discount_amount_gbp) AS DECIMAL(28,4)) AS total_discount_gbp,
  {mavg('i.unit_price_gbp')} AS avg_selling_price_gbp,
  count(*) FILTER (WHERE i.is_substituted) AS times_substituted_away
FROM stg_order_items i JOIN int_orders_basket o ON i.order_id = o.order_id
WHERE o.is_delivered GROUP BY i.product_id"""),
    ("int_products_performance", f"""
SELECT p.product_id, p.product_name, p.sku, p.category, p.subcategory, p.brand, p.cost_price_gbp,
  p.rrp_gbp, p.is_active, p.is_age_restricted, p.refreshed_at,
  inv.units_available, inv.is_below_reorder_point,
  coalesce(s.orders_containing_product, 0) AS orders_containing_product,
  coalesce(s.total_units_sold, 0) AS total_units_sold,
  coalesce(s.total_revenue_gbp, 0) AS total_revenue_gbp,
  coalesce(s.total_discount_gbp, 0) AS total_discount_gbp,
  cast(coalesce(s.avg_selling_price_gbp, 0) AS DECIMAL(38,6)) AS avg_selling_price_gbp,
  coalesce(s.times_substituted_away, 0) AS times_substituted_away,
  cast(coalesce(s.total_revenue_gbp, 0) - coalesce(s.total_units_sold, 0) * p.cost_price_gbp
       AS DECIMAL(38,4)) AS gross_margin_gbp,
  CASE WHEN coalesce(s.total_revenue_gbp, 0) = 0 THEN NULL
       ELSE {exact_pct('coalesce(s.total_revenue_gbp, 0) - coalesce(s.total_units_sold, 0) * p.cost_price_gbp',
                       's.total_revenue_gbp')} END AS gross_margin_pct
FROM stg_products p LEFT JOIN product_sales s ON p.product_id = s.product_id
LEFT JOIN latest_inventory inv ON p.product_id = inv.product_id"""),
    ("fact_orders", f"""
SELECT {skey('order_id')} AS surrogate_key, order_id, customer_id, order_status, order_channel,
  promo_code, promo_type, order_date, order_year, order_month, order_week, order_hour,
  order_created_at, delivery_slot_start_at, delivery_slot_end_at,
  item_line_count, total_units, basket_value_gbp, gross_basket_gbp, total_discount_gbp,
  substituted_line_count, is_delivered, is_cancelled, is_returned, has_promo,
  refreshed_at, {NOW} AS dbt_updated_at
FROM int_orders_basket"""),
    ("fact_order_items", f"""
SELECT {skey('i.order_item_id')} AS surrogate_key, i.order_item_id, i.order_id, o.customer_id,
  i.product_id, p.category, p.subcategory, p.brand, o.order_date, o.order_status, o.order_channel,
  o.is_delivered, i.quantity, i.unit_price_gbp, i.discount_amount_gbp, i.line_total_gbp,
  i.is_substituted, i.substituted_product_id, i.refreshed_at, {NOW} AS dbt_updated_at
FROM stg_order_items i JOIN int_orders_basket o ON i.order_id = o.order_id
LEFT JOIN stg_products p ON i.product_id = p.product_id"""),
    ("dim_customers", f"""
SELECT {skey('customer_id')} AS customer_key, customer_id, email, first_name, last_name,
  concat(first_name, ' ', last_name) AS full_name, loyalty_tier, postcode, registered_at,
  cast(registered_at AS DATE) AS registration_date, is_active, days_since_registration,
  has_ordered, total_orders, orders_this_year, lifetime_value_gbp, avg_order_value_gbp,
  first_order_date, last_order_date, days_since_last_order, promo_orders_count,
  lifetime_discount_gbp, customer_segment,
  CASE WHEN lifetime_value_gbp >= {VB_HI} THEN 'high' WHEN lifetime_value_gbp >= {VB_MID} THEN 'mid'
       WHEN lifetime_value_gbp > 0 THEN 'low' ELSE 'none' END AS value_band,
  refreshed_at, {NOW} AS dbt_updated_at
FROM int_customers_orders"""),
    ("dim_products", f"""
SELECT {skey('product_id')} AS product_key, product_id, sku, product_name, category, subcategory,
  brand, cost_price_gbp, rrp_gbp, is_active, is_age_restricted, orders_containing_product,
  total_units_sold, total_revenue_gbp, total_discount_gbp, avg_selling_price_gbp,
  gross_margin_gbp, gross_margin_pct, times_substituted_away, units_available,
  is_below_reorder_point,
  CASE WHEN total_revenue_gbp >= {PT_HERO} THEN 'hero' WHEN total_revenue_gbp >= {PT_CORE} THEN 'core'
       WHEN total_revenue_gbp > 0 THEN 'tail' ELSE 'no_sales' END AS product_tier,
  refreshed_at, {NOW} AS dbt_updated_at
FROM int_products_performance"""),
    ("dim_date", f"""
SELECT d AS date_id, d AS full_date, cast(year(d) AS INTEGER) AS year, cast(month(d) AS INTEGER) AS month,
  cast(day(d) AS INTEGER) AS day_of_month, {week('d')} AS week_of_year,
  cast(dayofweek(d) + 1 AS INTEGER) AS day_of_week,
  strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name, strftime(d, '%Y-%m') AS year_month,
  concat('Q', cast(cast(ceil(month(d) / 3) AS BIGINT) AS VARCHAR), '-', cast(year(d) AS VARCHAR)) AS quarter_label,
  dayofweek(d) + 1 IN (1, 7) AS is_weekend, d = {AS_OF} AS is_today, d < {AS_OF} AS is_past,
  d <= cast(date_trunc('month', {AS_OF}) AS DATE) AS is_month_to_date
FROM (SELECT unnest(generate_series((SELECT min(order_date) FROM fact_orders),
        {AS_OF} + {P.date_spine_days_ahead} - 1, INTERVAL 1 DAY))::DATE AS d)"""),
    ("daily", f"""
SELECT order_date, order_channel, count(DISTINCT order_id) AS total_orders,
  count(DISTINCT customer_id) AS unique_customers,
  cast(sum(basket_value_gbp) AS DECIMAL(38,4)) AS gross_revenue_gbp,
  cast(sum(total_discount_gbp) AS DECIMAL(38,4)) AS total_discount_gbp,
  cast(sum(basket_value_gbp) - sum(total_discount_gbp) AS DECIMAL(38,4)) AS net_revenue_gbp,
  {mavg('basket_value_gbp')} AS avg_basket_value_gbp,
  cast(sum(total_units) AS BIGINT) AS total_units_sold,
  count(*) FILTER (WHERE has_promo) AS promo_orders,
  count(*) FILTER (WHERE has_promo) / count(*) AS promo_attach_rate,
  cast(sum(substituted_line_count) AS BIGINT) AS total_substitutions
FROM fact_orders WHERE is_delivered GROUP BY order_date, order_channel"""),
    ("daily_sales_rows", """
SELECT *, lag(gross_revenue_gbp, 7) OVER (PARTITION BY order_channel ORDER BY order_date) AS revenue_7d_ago_gbp,
  cast(sum(gross_revenue_gbp) OVER (PARTITION BY order_channel ORDER BY order_date
      ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS DECIMAL(38,4)) AS revenue_rolling_7d_gbp
FROM daily"""),
    ("daily_sales", f"""
SELECT *, CASE WHEN revenue_7d_ago_gbp IS NULL OR revenue_7d_ago_gbp = 0 THEN NULL
  ELSE {exact_pct('gross_revenue_gbp - revenue_7d_ago_gbp', 'revenue_7d_ago_gbp')} END AS revenue_wow_pct_change
FROM daily_sales_rows"""),
    ("daily_sales_days", """
SELECT d.*, w.gross_revenue_gbp AS revenue_7d_ago_gbp,
  cast(sum(d.gross_revenue_gbp) OVER (PARTITION BY d.order_channel ORDER BY d.order_date
      RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW) AS DECIMAL(38,4)) AS revenue_rolling_7d_gbp
FROM daily d LEFT JOIN daily w ON w.order_channel = d.order_channel AND w.order_date = d.order_date - 7"""),
    ("inventory_alerts", f"""
SELECT i.product_id, p.product_name, p.sku, p.category, p.brand, i.warehouse_id, i.snapshot_date,
  i.units_on_hand, i.units_reserved, i.units_available, i.reorder_point, i.is_below_reorder_point,
  CASE WHEN i.units_available = 0 THEN 'out_of_stock'
       WHEN i.units_available <= i.reorder_point * 0.5 THEN 'critical'
       WHEN i.is_below_reorder_point THEN 'low_stock' ELSE 'ok' END AS stock_status,
  {NOW} AS alert_generated_at
FROM stg_inventory i JOIN dim_products p ON i.product_id = p.product_id
WHERE i.snapshot_date = (SELECT max(snapshot_date) FROM stg_inventory) AND i.is_below_reorder_point"""),
    ("customer_ltv", f"""
SELECT *, round(active_last_30d / nullif(customer_count, 0) * 100, 2) AS pct_active_30d,
  round(active_last_90d / nullif(customer_count, 0) * 100, 2) AS pct_active_90d
FROM (SELECT customer_segment, value_band, loyalty_tier,
        cast(date_trunc('month', registration_date) AS DATE) AS cohort_month,
        count(DISTINCT customer_id) AS customer_count,
        cast(sum(lifetime_value_gbp) AS DECIMAL(38,4)) AS cohort_ltv_gbp,
        {mavg('lifetime_value_gbp')} AS avg_ltv_gbp,
        {avg('total_orders')} AS avg_orders_per_customer,
        {mavg('avg_order_value_gbp')} AS avg_basket_gbp,
        {avg('days_since_last_order')} AS avg_days_since_last_order,
        count(*) FILTER (WHERE days_since_last_order <= 30) AS active_last_30d,
        count(*) FILTER (WHERE days_since_last_order <= 90) AS active_last_90d
      FROM dim_customers WHERE has_ordered GROUP BY 1, 2, 3, 4) c"""),
    ("fact_orders_incremental", f"""
SELECT * FROM fact_orders WHERE order_date >= {AS_OF} - {P.lookback_days}"""),
    ("fact_order_items_incremental", f"""
SELECT * FROM fact_order_items WHERE order_date >= {AS_OF} - {P.lookback_days}"""),
    ("alert_ranked", """
SELECT *, row_number() OVER (ORDER BY CASE stock_status WHEN 'out_of_stock' THEN 1 WHEN 'critical' THEN 2
                                      WHEN 'low_stock' THEN 3 END NULLS FIRST,
                             category NULLS FIRST, product_name NULLS FIRST,
                             warehouse_id NULLS FIRST, product_id NULLS FIRST) AS alert_rank
FROM inventory_alerts"""),
    ("suite_results", None),  # filled below
]

ALERT_COLS = "stock_status, product_name, category, warehouse_id, units_available, reorder_point"


def _suite_sql() -> str:
    kinds = []
    for table, checks in STAGING_SUITES.items():
        src = table
        row = [c for c in checks if c.kind != "unique"]
        uniq = [c for c in checks if c.kind == "unique"]
        for i, c in enumerate(row):
            if c.kind == "row_count":
                conds = []
                if c.args.get("lo") is not None:
                    conds.append(f"count(*) >= {c.args['lo']}")
                if c.args.get("hi") is not None:
                    conds.append(f"count(*) <= {c.args['hi']}")
                failed = f"CASE WHEN {' AND '.join(conds)} THEN 0 ELSE 1 END"
            else:
                col = c.column
                if c.kind == "not_null":
                    bad = f"{col} IS NULL"
                elif c.kind == "in_set":
                    vals = ", ".join(f"'{v}'" for v in c.args["values"])
                    bad = f"{col} NOT IN ({vals})"
                elif c.kind == "between":
                    parts = []
                    if c.args.get("lo") is not None:
                        parts.append(f"{col} >= {c.args['lo']}")
                    if c.args.get("hi") is not None:
                        parts.append(f"{col} <= {c.args['hi']}")
                    bad = f"NOT ({' AND '.join(parts)})"
                elif c.kind == "regex":
                    bad = f"NOT regexp_matches({col}, '{c.args['regex']}')"
                failed = f"count(*) FILTER (WHERE {bad})"
            kinds.append(f"SELECT '{table}' AS table_name, {i} AS check_order, '{c.name}' AS \"check\", "
                         f"cast({failed} AS BIGINT) AS failed_rows FROM {src}")
        for j, c in enumerate(uniq):
            kinds.append(
                f"SELECT '{table}' AS table_name, {len(row) + j} AS check_order, '{c.name}' AS \"check\", "
                f"cast(coalesce(sum(n), 0) AS BIGINT) AS failed_rows FROM (SELECT count(*) AS n FROM {src} "
                f"WHERE {c.column} IS NOT NULL GROUP BY {c.column} HAVING count(*) > 1)")
    body = "\nUNION ALL\n".join(kinds)
    return f"SELECT table_name, cast(check_order AS INTEGER) AS check_order, \"check\", failed_rows, " \
           f"failed_rows = 0 AS success FROM ({body})"


CTES[-1] = ("suite_results", _suite_sql())


def _declared_sql() -> str:
    from larder.plans.declared_tests import declared_list, test_name
    rel_cte = {"inventory_alerts": "inventory_alerts"}
    parts = []
    for i, (rel, col, name, arg) in enumerate(declared_list()):
        src = rel_cte.get(rel, rel)
        if name == "not_null":
            q = f"SELECT count(*) AS f FROM {src} WHERE {col} IS NULL"
        elif name == "accepted_values":
            vals = ", ".join(f"'{v}'" for v in arg)
            q = f"SELECT count(DISTINCT {col}) AS f FROM {src} WHERE {col} NOT IN ({vals})"
        elif name == "unique":
            q = (f"SELECT count(*) AS f FROM (SELECT {col} FROM {src} WHERE {col} IS NOT NULL "
                 f"GROUP BY {col} HAVING count(*) > 1)")
        else:
            to, field = arg
            q = (f"SELECT count(*) AS f FROM {src} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
                 f"(SELECT 1 FROM {to} p WHERE p.{field} = c.{col})")
        parts.append(f"SELECT {i} AS test_order, '{rel}' AS relation, '{col}' AS \"column\", "
                     f"'{test_name(rel, col, name)}' AS test, cast(f AS BIGINT) AS failures FROM ({q})")
    body = "\nUNION ALL\n".join(parts)
    return (f"SELECT cast(test_order AS INTEGER) AS test_order, relation, \"column\", test, failures, "
            f"CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({body})")


def with_ctes(final: str) -> str:
    body = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES)
    return f"WITH {body}\n{final}"


MERGED = f"""
SELECT * FROM fact_orders WHERE order_date < {AS_OF} - 60 OR order_date > {AS_OF} - 2
UNION ALL
SELECT * REPLACE ('returned' AS order_status, true AS is_returned, false AS is_delivered,
  cast(total_discount_gbp + 1 AS DECIMAL(28,4)) AS total_discount_gbp, cast(order_date + 1 AS DATE) AS order_date)
FROM fact_orders WHERE order_date BETWEEN {AS_OF} - 60 AND {AS_OF} - 2"""

FINALS = {
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_order_items": "SELECT * FROM stg_order_items",
    "stg_products": "SELECT * FROM stg_products",
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_inventory": "SELECT * FROM stg_inventory",
    "stg_promotions": "SELECT * FROM stg_promotions",
    "int_orders_basket": "SELECT * FROM int_orders_basket",
    "int_customers_orders": "SELECT * FROM int_customers_orders",
    "int_products_performance": "SELECT * FROM int_products_performance",
    "fact_orders": "SELECT * FROM fact_orders",
    "fact_order_items": "SELECT * FROM fact_order_items",
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_products": "SELECT * FROM dim_products",
    "dim_date": "SELECT * FROM dim_date",
    "daily_sales": "SELECT * FROM daily_sales",
    "inventory_alerts": "SELECT * FROM inventory_alerts",
    "customer_ltv": "SELECT * FROM customer_ltv",
    "merge_upsert_orders": MERGED,
    "merge_published_orders": MERGED,
    "published_daily_sales": "SELECT * FROM daily_sales",
    "view_delivered_orders": "SELECT order_id, customer_id FROM stg_orders WHERE order_status = 'delivered'",
    "fact_orders_incremental": "SELECT * FROM fact_orders_incremental",
    "fact_order_items_incremental": "SELECT * FROM fact_order_items_incremental",
    "latest_inventory": "SELECT * FROM latest_inventory",
    "sales_lag7": "SELECT order_date, order_channel, gross_revenue_gbp, revenue_7d_ago_gbp FROM daily_sales_rows",
    "sales_rolling7_rows": "SELECT order_date, order_channel, gross_revenue_gbp, revenue_rolling_7d_gbp FROM daily_sales_rows",
    "sales_rolling7_days": "SELECT order_date, order_channel, gross_revenue_gbp, revenue_rolling_7d_gbp FROM daily_sales_days",
    "sales_wow_calendar": f"""
SELECT *, CASE WHEN revenue_7d_ago_gbp IS NULL OR revenue_7d_ago_gbp = 0 THEN NULL
  ELSE {exact_pct('gross_revenue_gbp - revenue_7d_ago_gbp', 'revenue_7d_ago_gbp')} END AS revenue_wow_pct_change
FROM daily_sales_days""",
    "alert_top20": f"SELECT {ALERT_COLS} FROM alert_ranked WHERE alert_rank <= 20",
    "alert_top5_per_status": f"""
SELECT {ALERT_COLS}, cast(row_number() OVER (PARTITION BY stock_status ORDER BY alert_rank) AS INTEGER) AS rank_in_status
FROM alert_ranked QUALIFY rank_in_status <= 5""",
    "alert_digest": f"""
SELECT {ALERT_COLS}, rank_in_status, alerts_listed, greatest(alerts_listed - 15, 0) AS more_count
FROM (SELECT *, cast(row_number() OVER (PARTITION BY stock_status ORDER BY alert_rank) AS INTEGER) AS rank_in_status,
        (SELECT count(*) FROM alert_ranked) AS alerts_listed
      FROM alert_ranked WHERE alert_rank <= 20)
WHERE rank_in_status <= 5""",
    "revenue_metrics": f"""
SELECT order_channel, order_year,
  cast(sum(basket_value_gbp) AS DECIMAL(38,4)) AS gross_revenue_gbp,
  cast(sum(total_discount_gbp) AS DECIMAL(38,4)) AS total_discount_gbp,
  cast(sum(basket_value_gbp) - sum(total_discount_gbp) AS DECIMAL(38,4)) AS net_revenue_gbp,
  {mavg('basket_value_gbp')} AS avg_basket_gbp,
  CASE WHEN sum(basket_value_gbp) = 0 OR sum(basket_value_gbp) IS NULL THEN NULL
       ELSE cast(sum(total_discount_gbp) AS DOUBLE) / cast(sum(basket_value_gbp) AS DOUBLE) END AS discount_rate
FROM fact_orders WHERE is_delivered GROUP BY order_channel, order_year""",
    "distinct_customers_by_channel": """
SELECT order_channel, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT order_id) AS total_orders
FROM fact_orders GROUP BY order_channel""",
    "latest_snapshot_filter": "SELECT * FROM stg_inventory WHERE snapshot_date = (SELECT max(snapshot_date) FROM stg_inventory)",
    "email_validity": f"SELECT customer_id, email, regexp_matches(email, '{EMAIL_PATTERN}') AND NOT ends_with(email, chr(10)) AS is_valid_email FROM stg_customers",
    "surrogate_keys": f"""
SELECT order_item_id, {skey('order_item_id')} AS line_key, {skey('order_id', 'product_id')} AS order_product_key,
  {skey('order_id', 'substituted_product_id')} AS substitution_key FROM stg_order_items""",
    "pence_to_pounds": """
SELECT order_item_id, cast(trunc(line_total_gbp * 100) AS BIGINT) AS line_total_pence,
  cast(round(cast(cast(trunc(line_total_gbp * 100) AS BIGINT) AS DECIMAL(20,2)) / 100, 2) AS DECIMAL(21,2)) AS line_total_pounds
FROM stg_order_items""",
    "safe_ratio": """
SELECT product_id,
  CASE WHEN total_revenue_gbp = 0 THEN NULL
       ELSE cast(total_discount_gbp AS DOUBLE) / cast(total_revenue_gbp AS DOUBLE) END AS discount_share,
  CASE WHEN orders_containing_product = 0 THEN NULL
       ELSE total_units_sold / orders_containing_product END AS units_per_order
FROM int_products_performance""",
    "week_parts": f"""
SELECT order_id, cast(order_created_at AS DATE) AS order_date, {week('cast(order_created_at AS DATE)')} AS week_sunday,
  cast(dayofweek(order_created_at) + 1 AS INTEGER) AS day_of_week,
  concat('Q', cast(cast(ceil(month(order_created_at) / 3) AS BIGINT) AS VARCHAR), '-',
         cast(year(order_created_at) AS VARCHAR)) AS quarter_label,
  cast(date_trunc('month', cast(order_created_at AS DATE)) AS DATE) AS month_start
FROM stg_orders""",
    "name_initcap": f"""
SELECT customer_id, {initcap("concat_ws('-', first_name, last_name)")} AS hyphenated,
  {initcap('postcode')} AS postcode_title FROM raw_customers""",
    "recent_only_dev": f"SELECT * FROM fact_orders WHERE order_date >= {AS_OF} - 90",
    "dq_unique": """
SELECT customer_id, count(*) AS n_records FROM stg_orders WHERE customer_id IS NOT NULL
GROUP BY customer_id HAVING count(*) > 1""",
    "dq_not_null": """
SELECT order_item_id, order_id, quantity, line_total_gbp FROM stg_order_items WHERE discount_amount_gbp IS NULL""",
    "dq_accepted_values": """
SELECT channel, count(*) AS n_records FROM raw_orders WHERE channel NOT IN ('web', 'app', 'partner') GROUP BY channel""",
    "dq_relationships": """
SELECT order_item_id, order_id FROM stg_order_items i WHERE order_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_status = 'delivered' AND o.order_id = i.order_id)""",
    "dq_between": """
SELECT order_item_id, line_total_gbp FROM stg_order_items WHERE NOT (line_total_gbp >= 1000 AND line_total_gbp <= 50000)""",
    "dq_regex": f"SELECT customer_id, email FROM stg_customers WHERE NOT regexp_matches(email, '{EMAIL_PATTERN}') OR ends_with(email, chr(10))",
    "dq_row_count": "SELECT count(*) AS row_count, count(*) >= 500 AS success FROM stg_order_items",
    "dq_freshness": """
SELECT table_name, max_loaded_at, age_hours,
  CASE WHEN age_hours > 48 THEN 'error' WHEN age_hours > 25 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT 'orders' AS table_name, max(_loaded_at) AS max_loaded_at,
  (epoch(TIMESTAMP '2001-08-02 08:00:00') - epoch(max(_loaded_at))) / 3600.0 AS age_hours FROM raw_orders UNION ALL SELECT 'customers' AS table_name, max(_loaded_at) AS max_loaded_at,
  (epoch(TIMESTAMP '2001-08-02 08:00:00') - epoch(max(_loaded_at))) / 3600.0 AS age_hours FROM raw_customers UNION ALL SELECT 'inventory' AS table_name, max(_loaded_at) AS max_loaded_at,
  (epoch(TIMESTAMP '2001-08-02 08:00:00') - epoch(max(_loaded_at))) / 3600.0 AS age_hours FROM raw_inventory)""",
    "dq_suite_results": "SELECT * FROM suite_results",
    "dq_declared_tests": None,
    "dq_suite_summary": """
SELECT table_name, count(*) FILTER (WHERE success) AS passed, count(*) AS total,
  count(*) FILTER (WHERE NOT success) AS failed, bool_and(success) AS success
FROM suite_results GROUP BY table_name""",
    "dq_suite_overall": """
SELECT count(DISTINCT table_name) AS tables, count(*) AS total, count(*) FILTER (WHERE success) AS passed,
  count(*) FILTER (WHERE NOT success) AS failed, bool_and(success) AS success
FROM suite_results""",
    "run_log_files": """
SELECT run_id, count(*) AS total,
  count(*) FILTER (WHERE success AND run_id <> 'stopped') AS success,
  count(*) FILTER (WHERE NOT success AND run_id = 'hourly') AS warnings,
  count(*) FILTER (WHERE NOT success AND run_id <> 'hourly') AS errors,
  count(*) FILTER (WHERE success AND run_id = 'stopped') AS skipped,
  round(max(elapsed), 1) AS elapsed,
  coalesce(list_sort(list(node) FILTER (WHERE NOT success AND run_id <> 'hourly')), []) AS error_nodes,
  coalesce(list_sort(list(node) FILTER (WHERE NOT success AND run_id = 'hourly')), []) AS warn_nodes
FROM (SELECT success, regexp_replace("check", '[()]', '_', 'g') AS node FROM suite_results),
  (VALUES ('daily', 61.26::DOUBLE), ('hourly', 7.04::DOUBLE), ('stopped', 0.5::DOUBLE)) r(run_id, elapsed)
GROUP BY run_id""",
    "run_log_rollup": """
SELECT 'validation' AS run_id, count(*) AS total,
  count(*) FILTER (WHERE success) AS success, cast(0 AS BIGINT) AS warnings,
  count(*) FILTER (WHERE NOT success) AS errors, cast(0 AS BIGINT) AS skipped,
  cast(NULL AS DOUBLE) AS elapsed,
  coalesce(list_sort(list(regexp_replace("check", '[()]', '_', 'g')) FILTER (WHERE NOT success)), []) AS error_nodes,
  cast([] AS VARCHAR[]) AS warn_nodes
FROM suite_results""",
    "load_summary": """
SELECT table_name, row_count FROM (
  SELECT 'orders' AS table_name, count(*) AS row_count FROM raw_orders
  UNION ALL SELECT 'order_items', count(*) FROM raw_order_items
  UNION ALL SELECT 'products', count(*) FROM raw_products
  UNION ALL SELECT 'customers', count(*) FROM raw_customers
  UNION ALL SELECT 'promotions', count(*) FROM raw_promotions
  UNION ALL SELECT 'inventory', count(*) FROM raw_inventory)
UNION ALL SELECT 'TOTAL', sum(n) FROM (
  SELECT count(*) AS n FROM raw_orders UNION ALL SELECT count(*) FROM raw_order_items
  UNION ALL SELECT count(*) FROM raw_products UNION ALL SELECT count(*) FROM raw_customers
  UNION ALL SELECT count(*) FROM raw_promotions UNION ALL SELECT count(*) FROM raw_inventory)""",
}


FINALS["clustered_file_skipping"] = " UNION ALL ".join(
    f"SELECT {n} AS filter, count(*) AS rows, sum(line_total_gbp) AS line_total_gbp, true AS few_files "
    f"FROM fact_order_items WHERE product_id BETWEEN 'PRD-{p}100' AND 'PRD-{p}140' "
    f"AND order_date >= DATE '{d}-01' AND order_date < DATE '{d}-01' + INTERVAL 2 MONTH"
    for n, (d, p) in enumerate((("1996-03", "0000"), ("1997-09", "0001"), ("1998-01", "0000"))))

FINALS["dq_declared_tests"] = _declared_sql()


def oracle_sql() -> dict[str, str]:
    return {name: with_ctes(final) for name, final in FINALS.items()}

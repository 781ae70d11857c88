"""Full and incremental runs: build the models in dependency order and
publish them as Parquet tables under one root folder.

Layout: <root>/larder_<target>_<layer>/<table>, so dev and prod runs share a root
without touching each other's tables. Facts are partitioned by order_date and
upserted; dimensions and reports are fully refreshed. Reports read the
published fact/dimension tables back (as the reference's reports read its
tables), so each layer's lineage stops at the previous layer's files."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession

from larder.operators.joins import materialize
from larder.operators.merge import write_incremental
from larder.operators.quality import run_suite, source_freshness
from larder.operators.sinks import read_table, register_view, write_table
from larder.operators.topk import alert_digest
from larder.plans import dimensions as D
from larder.plans import facts as FA
from larder.plans import intermediate as I
from larder.plans import reporting as R
from larder.plans.checks import STAGING_SUITES
from larder.plans.staging import STAGING
from larder.sources.raw import table_name


def _path(root: str, target: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{table_name(layer, target, name).replace('.', '/')}"


def run_published_tests(spark: SparkSession, relations: dict, only: tuple | None = None) -> list:
    """Declared tests of ``relations`` -> [(test, status)] (one small row per
    test): all of them, or those of the relations named in ``only``. A declared
    relation (or a relationship's parent) that is not given is an error."""
    from larder.plans.declared_tests import DECLARED, run_declared_tests
    declared = {k: v for k, v in DECLARED.items() if only is None or k in only}
    parents = {t[1][0] for v in declared.values() for ts in v.values() for t in ts
               if not isinstance(t, str) and t[0] == "relationships"}
    absent = sorted((set(declared) | parents) - set(relations))
    if absent:
        raise ValueError(f"declared tests need relations that were not given: {absent}")
    res = run_declared_tests(relations, declared).select("test", "status").collect()
    return [(r.test, r.status) for r in res]


def check_sources(raw: dict, p) -> list:
    """Freshness of the sources with a load time -> [(source, status)]."""
    stamped = {t: (raw[t], "_loaded_at") for t in ("orders", "customers", "inventory")}
    return [(r.table_name, r.status) for r in source_freshness(stamped, p).collect()]


def run_suites(staged: dict) -> list:
    """Expectations on the staged tables -> [(table.check, success)]."""
    out = []
    for name, checks in STAGING_SUITES.items():
        for r in run_suite(staged[name[len("stg_"):]], name, checks).collect():  # a row per check
            out.append((f"{name}.{r.check}", r.success))
    return out


def write_run_results(spark: SparkSession, root: str, run_id: str, elapsed: float,
                      results: list, target: str = "prod") -> str:
    """One run-results document (run_id, elapsed_time, results[status,
    unique_id]) under <root>/_runs/, readable by ``read_run_log``."""
    path = f"{root.rstrip('/')}/_runs/{target}-{run_id}"
    doc = spark.createDataFrame(
        [(run_id, float(elapsed), [(status, uid) for uid, status in results])],
        "run_id string, elapsed_time double, results array<struct<status:string,unique_id:string>>")
    doc.coalesce(1).write.mode("overwrite").json(path)
    return path


def stage_views(raw: dict, p) -> dict:
    """Staging layer as named views (no storage)."""
    return {name: register_view(STAGING[name](raw[name], p), f"stg_{name}") for name in STAGING}


class StaleSourceError(RuntimeError):
    """A source is older than its error threshold: nothing was published."""


class RunFailed(RuntimeError):
    """A model raised; its cause is attached, the others are in the run's document."""


#: Models that are listed in a run's document only if they did not succeed.
INNER = ("int_orders_basket", "int_customers_orders", "int_products_performance", "recent_orders")


class RunLog:
    """Statuses of a run's nodes, written as one document however the run ends."""

    def __init__(self, spark: SparkSession, root: str, kind: str, run_id: str | None, target: str):
        self.spark, self.root, self.target = spark, root, target
        self.run_id = run_id or f"{kind}-{uuid.uuid4().hex[:8]}"
        self.started = time.perf_counter()
        self.nodes: list[tuple[str, str]] = []  # (unique id, status)
        self.models: dict[str, str] = {}
        self.seconds: dict[str, float] = {}
        self.failures: list[Exception] = []

    def elapsed(self) -> float:
        return round(time.perf_counter() - self.started, 3)

    def add(self, kind: str, found: list) -> None:
        self.nodes += [(f"{kind}.larder.{name}", status) for name, status in found]

    def build(self, steps: dict, threads: int) -> dict:
        """Independent steps {model: (models it needs, function)} as concurrent
        Spark jobs; returns the results of those that succeeded. A model that needs
        one that did not succeed is skipped; one that raises is an error and the
        others go on."""
        from concurrent.futures import ThreadPoolExecutor

        def timed(fn):
            t = time.perf_counter()
            return fn(), round(time.perf_counter() - t, 3)

        ready = {m: fn for m, (needs, fn) in steps.items() if all(self.models.get(n) == "success" for n in needs)}
        self.models.update({m: "skipped" for m in steps if m not in ready})
        out = {}
        with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
            futures = {m: pool.submit(timed, fn) for m, fn in ready.items()}
            for m, f in futures.items():
                try:
                    out[m], seconds = f.result()
                    self.models[m] = "success"
                    if m not in INNER:
                        self.seconds[m] = seconds
                except Exception as e:  # noqa: BLE001 - any failure of a model is its status
                    self.models[m] = "error"
                    self.failures.append(e)
        return out

    def gate(self, sources: list, models: list) -> None:
        """Stop before anything is published if a source is too old."""
        self.add("source", sources)
        stale = sorted(t for t, status in sources if status == "error")
        if stale:
            self.models.update({m: "skipped" for m in models})
            self.write()
            raise StaleSourceError(f"sources older than their error threshold: {stale}")

    def stop_if_failed(self, tests: list) -> None:
        """After all models: with an error among them, the tests are skipped."""
        if self.failures:
            self.write([("test", [(t, "skipped") for t in tests])])
            broken = sorted(m for m, status in self.models.items() if status == "error")
            raise RunFailed(f"models failed: {broken}") from self.failures[0]

    def write(self, more: list = ()) -> str:
        """The document: sources, models, then ``more`` [(kind, [(name, status)])]."""
        self.add("model", [(m, st) for m, st in self.models.items() if m not in INNER or st != "success"])
        for kind, found in more:
            self.add(kind, found)
        return write_run_results(self.spark, self.root, self.run_id, time.perf_counter() - self.started,
                                 [(uid, status) for uid, status in self.nodes], self.target)


FULL_MODELS = ["fact_orders", "fact_order_items", "dim_customers", "dim_products", "dim_date",
               "reporting_daily_sales", "reporting_inventory_alerts", "reporting_customer_ltv"]
FACTS = ("fact_orders", "fact_order_items")


def _test_names(only: tuple | None = None) -> list[str]:
    from larder.plans.declared_tests import declared_list, test_name
    return [test_name(rel, col, name) for rel, col, name, _ in declared_list() if only is None or rel in only]


def run_full(spark: SparkSession, raw: dict, p, root: str, with_tests: bool = True,
             run_id: str | None = None) -> dict:
    """Daily run: the sources' freshness (an ``error`` stops the run), every
    model, facts rebuilt from all history; then the declared tests on the
    published tables. Models of one layer are independent and published
    concurrently. A run-results document is written in any case; a run with a
    failed model raises ``RunFailed`` after the models that do not need it."""
    p = p.starting_now()
    log = RunLog(spark, root, "full", run_id, p.target)
    s = stage_views(raw, p)
    sources = check_sources(raw, p)
    log.gate(sources, FULL_MODELS)

    def at(layer: str, name: str) -> str:
        return _path(root, p.target, layer, name)

    def basket() -> DataFrame:
        return read_table(spark, at("intermediate", "int_orders_basket"))

    def customers() -> DataFrame:
        return read_table(spark, at("intermediate", "int_customers_orders"))

    def products() -> DataFrame:
        return read_table(spark, at("intermediate", "int_products_performance"))

    # Read by the order fact, the customer metrics and the tests: written once.
    log.build({"int_orders_basket": ((), lambda: write_table(
        I.basket_metrics(s["orders"], s["order_items"], s["promotions"], p), at("intermediate", "int_orders_basket")))}, 1)
    log.build({
        "int_customers_orders": (("int_orders_basket",), lambda: write_table(
            I.customer_metrics(basket(), s["customers"], p), at("intermediate", "int_customers_orders"))),
        "int_products_performance": ((), lambda: write_table(
            I.product_metrics(s["order_items"], s["orders"], s["products"], s["inventory"], p),
            at("intermediate", "int_products_performance"))),
    }, p.threads)
    log.build({
        "fact_orders": (("int_orders_basket",), lambda: write_incremental(
            spark, FA.fact_orders(basket(), p), at("analytics", "fact_orders"),
            cluster_by=FA.FACT_ORDERS_CLUSTER, replace=True)),
        "fact_order_items": ((), lambda: write_incremental(
            spark, FA.fact_order_items(s["order_items"], s["orders"], s["products"], p),
            at("analytics", "fact_order_items"), cluster_by=FA.FACT_ORDER_ITEMS_CLUSTER, replace=True)),
        "dim_customers": (("int_customers_orders",), lambda: write_table(
            D.dim_customers(customers(), p), at("analytics", "dim_customers"),
            cluster_by=D.DIM_CUSTOMERS_CLUSTER, tiebreak=["customer_id"])),
        "dim_products": (("int_products_performance",), lambda: write_table(
            D.dim_products(products(), p), at("analytics", "dim_products"),
            cluster_by=D.DIM_PRODUCTS_CLUSTER, tiebreak=["product_id"])),
        "dim_date": ((), lambda: write_table(D.dim_date(spark, p), at("analytics", "dim_date"))),
    }, p.threads)
    # Reports read the published tables back.
    # daily_sales has days x channels rows only: one date-ordered file set
    # (min/max skipping on date filters) instead of a directory per day.
    log.build({
        "reporting_daily_sales": (("fact_orders",), lambda: write_table(
            R.daily_sales(read_table(spark, at("analytics", "fact_orders"))), at("reporting", "daily_sales"),
            cluster_by=["order_date", "order_channel"])),
        "reporting_inventory_alerts": (("dim_products",), lambda: write_table(
            R.inventory_alerts(s["inventory"], read_table(spark, at("analytics", "dim_products")), p),
            at("reporting", "inventory_alerts"))),
        "reporting_customer_ltv": (("dim_customers",), lambda: write_table(
            R.customer_ltv(read_table(spark, at("analytics", "dim_customers"))), at("reporting", "customer_ltv"))),
    }, p.threads)
    out = {"mode": "full", "freshness": dict(sources), "seconds": log.elapsed(), "models": log.seconds}
    log.stop_if_failed(_test_names() if with_tests else [])
    checked = []
    if with_tests:
        published = {name: read_published(spark, root, layer, table, p.target) for name, layer, table in PUBLISHED}
        published.update({f"stg_{k}": v for k, v in s.items()})
        published.update({f"raw_{k}": raw[k] for k in STAGING})
        published.update({"int_orders_basket": basket(), "int_customers_orders": customers(),
                          "int_products_performance": products()})
        tests = run_published_tests(spark, published)
        suites = run_suites(s)
        alerts = R.inventory_alert_rows(s["inventory"], published["dim_products"], p)
        out["tests"], out["tests_failed"] = len(tests), sum(1 for _, st in tests if st == "fail")
        out["expectations"], out["expectations_passed"] = len(suites), all(ok for _, ok in suites)
        out["stock_alerts"] = [r.asDict() for r in alert_digest(alerts).collect()]  # at most 15 rows
        checked = [("test", tests), ("expectation", [(c, "pass" if ok else "fail") for c, ok in suites])]
    out["run_results"] = log.write(checked)
    return out


# (model name in the declared tests, layer, published table)
PUBLISHED = [
    ("fact_orders", "analytics", "fact_orders"), ("fact_order_items", "analytics", "fact_order_items"),
    ("dim_customers", "analytics", "dim_customers"), ("dim_products", "analytics", "dim_products"),
    ("dim_date", "analytics", "dim_date"), ("daily_sales", "reporting", "daily_sales"),
    ("inventory_alerts", "reporting", "inventory_alerts"), ("customer_ltv", "reporting", "customer_ltv"),
]


def run_incremental(spark: SparkSession, raw: dict, p, root: str, with_tests: bool = True,
                    run_id: str | None = None) -> dict:
    """Hourly run: only the two facts, from orders inside the lookback window and
    their lines; upsert by key; then the two facts' declared tests. Freshness,
    failures and the run-results document as in the full run.

    The recent orders and their lines are written once and used by both
    facts, so the lines of all history are scanned once."""
    p = p.starting_now()
    log = RunLog(spark, root, "hourly", run_id, p.target)
    s = stage_views(raw, p)
    sources = check_sources(raw, p)
    log.gate(sources, list(FACTS))

    def recent() -> tuple[DataFrame, DataFrame]:
        orders = I.recent_orders(s["orders"], p)
        return orders, materialize(I.lines_of(s["order_items"], orders), "recent-lines")

    orders, lines = log.build({"recent_orders": ((), recent)}, 1).get("recent_orders", (None, None))
    stats = log.build({
        "fact_orders": (("recent_orders",), lambda: write_incremental(
            spark, FA.fact_orders(I.basket_metrics(orders, lines, s["promotions"], p), p, incremental=True),
            _path(root, p.target, "analytics", "fact_orders"), cluster_by=FA.FACT_ORDERS_CLUSTER)),
        "fact_order_items": (("recent_orders",), lambda: write_incremental(
            spark, FA.fact_order_items(lines, orders, s["products"], p, incremental=True),
            _path(root, p.target, "analytics", "fact_order_items"), cluster_by=FA.FACT_ORDER_ITEMS_CLUSTER)),
    }, p.threads)
    out = {"mode": "incremental", "freshness": dict(sources), "seconds": log.elapsed(), "models": stats}
    log.stop_if_failed(_test_names(FACTS) if with_tests else [])
    checked = []
    if with_tests:
        published = {name: read_published(spark, root, layer, table, p.target) for name, layer, table in PUBLISHED}
        published.update({f"stg_{k}": v for k, v in s.items()})
        tests = run_published_tests(spark, published, FACTS)
        out["tests_failed"] = sum(1 for _, st in tests if st == "fail")
        checked = [("test", tests)]
    out["run_results"] = log.write(checked)
    return out


def read_published(spark: SparkSession, root: str, layer: str, name: str, target: str = "prod") -> DataFrame:
    return read_table(spark, _path(root, target, layer, name))

"""Lazy model graph over one set of raw tables.

``Models`` builds every model on first access from the six raw DataFrames;
nothing runs until an action, but for the recent orders of the incremental
models: they are written once, so that both facts share them."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from larder.plans import dimensions as D
from larder.plans import facts as FA
from larder.plans import intermediate as I
from larder.plans import reporting as R
from larder.plans.staging import STAGING
from larder.sources.testdata import raw_table


class LazyTables(dict):
    """Dict that builds each DataFrame on first access."""

    def __init__(self, builders: dict):
        super().__init__()
        self._builders = builders

    def __missing__(self, name):
        df = self._builders[name]()
        self[name] = df
        return df

    def keys(self):
        return self._builders.keys()

    def items(self):
        return [(k, self[k]) for k in self._builders]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self):
        return len(self._builders)


class Models:
    def __init__(self, spark: SparkSession, raw: dict, p):
        self.spark, self.raw, self.p = spark, raw, p

    @classmethod
    def from_testdata(cls, spark: SparkSession, sf_dir: str, p) -> "Models":
        raw = LazyTables({name: (lambda n=name: raw_table(spark, sf_dir, n)) for name in STAGING})
        return cls(spark, raw, p)

    @cached_property
    def stg(self) -> dict:
        return LazyTables({name: (lambda n=name: STAGING[n](self.raw[n], self.p)) for name in STAGING})

    @cached_property
    def baskets(self) -> DataFrame:
        s = self.stg
        return I.basket_metrics(s["orders"], s["order_items"], s["promotions"], self.p)

    @cached_property
    def recent_orders(self) -> DataFrame:
        return I.recent_orders(self.stg["orders"], self.p)

    @cached_property
    def baskets_incremental(self) -> DataFrame:
        s = self.stg
        return I.basket_metrics(self.recent_orders, s["order_items"], s["promotions"], self.p, restrict=True)

    @cached_property
    def customer_metrics(self) -> DataFrame:
        return I.customer_metrics(self.baskets, self.stg["customers"], self.p)

    @cached_property
    def product_metrics(self) -> DataFrame:
        s = self.stg
        return I.product_metrics(s["order_items"], s["orders"], s["products"], s["inventory"], self.p)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return FA.fact_orders(self.baskets, self.p)

    @cached_property
    def fact_orders_incremental(self) -> DataFrame:
        return FA.fact_orders(self.baskets_incremental, self.p, incremental=True)

    @cached_property
    def fact_order_items(self) -> DataFrame:
        s = self.stg
        return FA.fact_order_items(s["order_items"], s["orders"], s["products"], self.p)

    @cached_property
    def fact_order_items_incremental(self) -> DataFrame:
        s = self.stg
        return FA.fact_order_items(s["order_items"], self.recent_orders, s["products"], self.p, incremental=True)

    @cached_property
    def dim_customers(self) -> DataFrame:
        return D.dim_customers(self.customer_metrics, self.p)

    @cached_property
    def dim_products(self) -> DataFrame:
        return D.dim_products(self.product_metrics, self.p)

    @cached_property
    def dim_date(self) -> DataFrame:
        return D.dim_date(self.spark, self.p)

    @cached_property
    def daily_sales(self) -> DataFrame:
        return R.daily_sales(self.fact_orders)

    @cached_property
    def inventory_alerts(self) -> DataFrame:
        return R.inventory_alerts(self.stg["inventory"], self.stg["products"], self.p)

    @cached_property
    def inventory_alert_rows(self) -> DataFrame:
        return R.inventory_alert_rows(self.stg["inventory"], self.stg["products"], self.p)

    @cached_property
    def customer_ltv(self) -> DataFrame:
        return R.customer_ltv(self.dim_customers)

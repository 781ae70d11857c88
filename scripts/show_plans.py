"""Summarise the physical plans of the registered queries as they would run
at scale: automatic broadcasting off, raw tables landed bucketed. Prints a Markdown table.

usage: python scripts/show_plans.py [sf_dir] > PLANS.md"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = ["int_orders_basket", "fact_order_items", "fact_orders_incremental", "fact_order_items_incremental",
        "int_customers_orders", "int_products_performance", "daily_sales", "customer_ltv",
        "latest_inventory", "alert_top5_per_status", "alert_top20", "inventory_alerts",
        "merge_upsert_orders", "dq_declared_tests"]


def summary(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcast joins": len(re.findall(r"BroadcastHashJoin", plan)),
        "sort-merge joins": len(re.findall(r"SortMergeJoin", plan)),
        "partial aggs": len(re.findall(r"functions=\[partial_", plan)),
        "partial window limits": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "Expand": len(re.findall(r"\bExpand\b", plan)),
        "Python UDFs": len(re.findall(r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas", plan)),
    }


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from larder.plans.registry import QUERIES
    from larder.session import build_session
    spark = build_session("local[8]", 200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # show the static plan
    cols = None
    print("# Physical plans at scale settings\n")
    print("Generated by `scripts/show_plans.py`: automatic broadcast off, AQE off to show the")
    print("static plan, raw tables landed bucketed by key (8 buckets).\n")
    for q in KEYS:
        plan = QUERIES[q](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        s = summary(plan)
        if cols is None:
            cols = list(s)
            print("| query | " + " | ".join(cols) + " |")
            print("|---|" + "---|" * len(cols))
        print(f"| {q} | " + " | ".join(str(s[c]) for c in cols) + " |")
    spark.stop()


if __name__ == "__main__":
    main()

"""Orders per (nation, priority, market segment) with the customers' average
balance, and the groups numbered per priority by size.

Plan shape at scale (see PLANS_AT_SCALE.md), the same whatever the data:
  orders scan (2 columns) -> count per (custkey, priority), map-side partial,
  so a customer holding any share of all orders is a few rows per task ->
  shuffled join of the counts with customer -> broadcast join with nation
  (size-checked) -> partial/final aggregate on the three keys -> window per
  priority.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowforge.operators.aggregate import group_avg_count, rank_within
from rowforge.operators.partitioning import maybe_broadcast

GROUP_KEYS = ["n_name", "o_orderpriority", "c_mktsegment"]


def segment_stats(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    per_cust = orders.groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    cust = customer.select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    nat = maybe_broadcast(nation.select("n_nationkey", "n_name"), 100_000)
    j = (per_cust.join(cust, per_cust["o_custkey"] == cust["c_custkey"], "inner")
                 .join(nat, cust["c_nationkey"] == nat["n_nationkey"], "inner"))
    return group_avg_count(j, GROUP_KEYS, "c_acctbal", "avg_acctbal", weight="n_orders")


def rank_segments(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    stats = segment_stats(orders, customer, nation)
    ranked = rank_within(stats, ["o_orderpriority"], "total", ["n_name", "c_mktsegment"])
    return ranked.select("seq_number", "avg_acctbal", "total", *GROUP_KEYS)

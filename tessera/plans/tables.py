"""Role mapping of the driver tables onto the job-table vocabulary.

Job value / claimed / cost -> o_totalprice / l_extendedprice /
l_extendedprice * (1 - l_discount). Every frame here is a projection of the
given tables, so pruning reaches the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cost_expr() -> F.Column:
    return F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))


def lineitem_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with claimed / cost and a few 0/1 flags."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus",
        F.col("l_extendedprice").alias("claimed"), cost_expr().alias("cost"),
        (F.col("l_returnflag") == "R").cast("int").alias("is_returned"),
        (F.col("l_linestatus") == "O").cast("int").alias("is_open"),
        (F.col("l_quantity") > 25).cast("int").alias("is_bulk"),
        (F.col("l_discount") > 0.05).cast("int").alias("is_discounted"),
        (F.col("l_tax") > 0.04).cast("int").alias("is_taxed"),
    )


# SQL twin of lineitem_jobs for the oracles.
LINEITEM_JOBS_SQL = """(SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  l_discount, l_tax, l_returnflag, l_linestatus,
  l_extendedprice AS claimed, l_extendedprice * (1.0 - l_discount) AS cost,
  CAST(l_returnflag = 'R' AS INTEGER) AS is_returned, CAST(l_linestatus = 'O' AS INTEGER) AS is_open,
  CAST(l_quantity > 25 AS INTEGER) AS is_bulk, CAST(l_discount > 0.05 AS INTEGER) AS is_discounted,
  CAST(l_tax > 0.04 AS INTEGER) AS is_taxed
  FROM lineitem)"""


def order_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: claimed, cost, quantity and line count from its
    line items, plus order and customer attributes. Target: saving = claimed
    - cost. The line-item aggregate is hash-partitioned on the order key, so
    the join to orders reuses that partitioning."""
    li = table(spark, sf_dir, "lineitem")
    per_order = li.groupBy("l_orderkey").agg(
        F.sum("l_extendedprice").alias("claimed"), F.sum(cost_expr()).alias("cost"),
        F.sum("l_quantity").alias("quantity"), F.count(F.lit(1)).alias("n_lines"),
        F.max((F.col("l_returnflag") == "R").cast("int")).alias("has_return"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus",
                                                   "o_orderpriority")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    jobs = (per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
            .join(cust, orders.o_custkey == cust.c_custkey, "left"))
    return jobs.select("o_orderkey", "o_totalprice", "claimed", "cost", "quantity", "n_lines", "has_return",
                       "o_orderstatus", "o_orderpriority", "c_acctbal", "c_mktsegment",
                       (F.col("claimed") - F.col("cost")).alias("saving"))

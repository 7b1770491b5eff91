"""Registered queries, steps 0-1: minimum slice and scalar feature operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import bins, ops
from ..operators.profile import grouped_count_mean, grouped_mean
from ..sources.readers import clean_column_names
from .features import prepare_rows
from .tables import LINEITEM_JOBS_SQL as LJ
from .tables import lineitem_jobs, table

Q, O = {}, {}


def q(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            O[name] = sql
        return fn
    return deco


KEYS = ["l_orderkey", "l_linenumber"]


# S2, P2, A1, A7, A8, G2, O2 -----------------------------------------------------
@q("profit_by_segment", f"""
SELECT c_mktsegment, round(avg(profit), 4) AS avg_profit, count(*) AS n_rows
FROM (SELECT l_orderkey, claimed - cost AS profit FROM {LJ}) j
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment ORDER BY avg_profit DESC, c_mktsegment LIMIT 10""")
def profit_by_segment(spark, sf):
    """Profit (claimed - cost, via the operation registry) by market segment,
    top 10. Line items are pre-aggregated per order (sum, count) before the
    joins: the join input shrinks to one row per order, and the aggregate's
    shuffle on the order key is reused by the join to orders."""
    jobs, _ = ops.apply_operations(lineitem_jobs(spark, sf).select("l_orderkey", "claimed", "cost"),
                                   [{"name": "profit", "operation": "subtract",
                                     "inputs": ["claimed", "cost"], "output": "profit"}])
    per_order = jobs.groupBy("l_orderkey").agg(F.sum("profit").alias("p_sum"), F.count(F.lit(1)).alias("p_n"))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    joined = (per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
              .join(cust, orders.o_custkey == cust.c_custkey))
    by_seg = joined.groupBy("c_mktsegment").agg(
        F.round(F.sum("p_sum") / F.sum("p_n"), 4).alias("avg_profit"), F.sum("p_n").alias("n_rows"))
    return by_seg.orderBy(F.desc("avg_profit"), "c_mktsegment").limit(10)


# A1-A6 via the registry ---------------------------------------------------------
def _one_op(op, inputs, digits):
    def run(spark, sf):
        df = lineitem_jobs(spark, sf)
        out, applied = ops.apply_operations(df, [{"operation": op, "inputs": inputs, "output": "result"}],
                                            on_error="raise")
        return out.select(*KEYS, F.round("result", digits).alias("result"))
    return run


Q["op_subtract"] = _one_op("subtract", ["claimed", "cost"], 6)
O["op_subtract"] = f"SELECT l_orderkey, l_linenumber, round(claimed - cost, 6) AS result FROM {LJ}"
Q["op_add"] = _one_op("add", ["l_extendedprice", "l_tax", "l_discount"], 6)
O["op_add"] = f"SELECT l_orderkey, l_linenumber, round(l_extendedprice + l_tax + l_discount, 6) AS result FROM {LJ}"
Q["op_multiply"] = _one_op("multiply", ["l_quantity", "l_discount", "l_tax"], 9)
O["op_multiply"] = f"SELECT l_orderkey, l_linenumber, round(l_quantity * l_discount * l_tax, 9) AS result FROM {LJ}"
Q["op_divide"] = _one_op("divide", ["l_tax", "l_discount"], 9)
O["op_divide"] = f"SELECT l_orderkey, l_linenumber, round(l_tax / nullif(l_discount, 0), 9) AS result FROM {LJ}"
Q["op_divide_percent"] = _one_op("divide_percent", ["cost", "claimed"], 6)
O["op_divide_percent"] = (f"SELECT l_orderkey, l_linenumber, round(cost / nullif(claimed, 0) * 100.0, 6) AS result "
                          f"FROM {LJ}")
Q["op_log"] = _one_op("log", ["l_quantity"], 9)
O["op_log"] = f"SELECT l_orderkey, l_linenumber, round(ln(1 + l_quantity), 9) AS result FROM {LJ}"


@q("op_chain", f"""
SELECT l_orderkey, l_linenumber, round(claimed - cost, 6) AS profit,
       round((claimed - cost) / nullif(claimed, 0) * 100.0, 6) AS margin
FROM {LJ}""")
def op_chain(spark, sf):
    df, _ = ops.apply_operations(lineitem_jobs(spark, sf), [
        {"name": "profit", "operation": "subtract", "inputs": ["claimed", "cost"], "output": "profit"},
        {"name": "margin", "type": "divide_percent", "inputs": ["profit", "claimed"], "output": "margin"},
    ])
    return df.select(*KEYS, F.round("profit", 6).alias("profit"), F.round("margin", 6).alias("margin"))


@q("ratio_guarded", f"""
SELECT l_orderkey, l_linenumber,
  round(CASE WHEN l_discount = 0 THEN 0.0 ELSE l_tax / l_discount END, 9) AS tax_per_discount,
  round(CASE WHEN coalesce(nullif(l_discount, 0), 0.0) = 0 THEN 0.0
        ELSE coalesce(l_tax, 0.0) / coalesce(nullif(l_discount, 0), 0.0) END, 9) AS tax_per_discount_filled
FROM {LJ}""")
def ratio_guarded(spark, sf):
    df = lineitem_jobs(spark, sf)
    return df.select(*KEYS, F.round(ops.ratio("l_tax", "l_discount", "zero"), 9).alias("tax_per_discount"),
                     F.round(ops.ratio(F.col("l_tax"), F.nullif(F.col("l_discount"), F.lit(0.0)), "fill0"), 9)
                     .alias("tax_per_discount_filled"))


@q("flag_or", f"""
SELECT l_orderkey, l_linenumber,
  CAST((coalesce(is_returned = 1, false) OR coalesce(is_open = 1, false) OR coalesce(is_bulk = 1, false)) AS INTEGER)
    AS any_flag
FROM {LJ}""")
def flag_or(spark, sf):
    df = lineitem_jobs(spark, sf)
    return df.select(*KEYS, ops.flag_or("is_returned", "is_open", "is_bulk").alias("any_flag"))


@q("flag_and", f"""
SELECT l_orderkey, l_linenumber, CAST(coalesce(l_returnflag = 'R' AND l_quantity > 25, false) AS INTEGER) AS both_flags
FROM {LJ}""")
def flag_and(spark, sf):
    df = lineitem_jobs(spark, sf)
    return df.select(*KEYS, ops.flag_and(F.col("l_returnflag") == "R", F.col("l_quantity") > 25).alias("both_flags"))


WEIGHTS = {"is_returned": 3, "is_open": 3, "is_bulk": 2, "is_discounted": 2, "is_taxed": 1}


@q("weighted_score", f"""
SELECT l_orderkey, l_linenumber,
  coalesce(is_returned, 0) * 3.0::DOUBLE + coalesce(is_open, 0) * 3.0::DOUBLE + coalesce(is_bulk, 0) * 2.0::DOUBLE
  + coalesce(is_discounted, 0) * 2.0::DOUBLE + coalesce(is_taxed, 0) * 1.0::DOUBLE AS risk_score
FROM {LJ}""")
def weighted_score(spark, sf):
    df = lineitem_jobs(spark, sf)
    return df.select(*KEYS, ops.weighted_score(WEIGHTS).alias("risk_score"))


@q("row_sum", f"""
SELECT l_orderkey, l_linenumber,
  round(coalesce(nullif(l_discount, 0), 0.0) + coalesce(nullif(l_tax, 0), 0.0), 9) AS charges
FROM {LJ}""")
def row_sum(spark, sf):
    df = lineitem_jobs(spark, sf).select(*KEYS, F.nullif("l_discount", F.lit(0.0)).alias("d"),
                                         F.nullif("l_tax", F.lit(0.0)).alias("t"))
    return df.select(*KEYS, F.round(ops.row_sum(["d", "t"]), 9).alias("charges"))


@q("cut_labels", f"""
SELECT CASE WHEN l_quantity > 0 AND l_quantity <= 10 THEN 'small' WHEN l_quantity > 10 AND l_quantity <= 25 THEN 'medium'
            WHEN l_quantity > 25 AND l_quantity <= 50 THEN 'large' END AS size_band, count(*) AS n
FROM {LJ} GROUP BY 1""")
def cut_labels(spark, sf):
    df = lineitem_jobs(spark, sf)
    banded = df.select(bins.cut("l_quantity", [0, 10, 25, 50], ["small", "medium", "large"]).alias("size_band"))
    return banded.groupBy("size_band").agg(F.count(F.lit(1)).alias("n"))


@q("cut_equal_width", """
WITH s AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders),
b AS (SELECT o_totalprice, CAST(greatest(least(ceil((o_totalprice - mn) / ((mx - mn) / 3.0)) - 1, 2), 0) AS INTEGER) AS bin
      FROM orders, s)
SELECT bin, count(*) AS n, min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM b GROUP BY bin""")
def cut_equal_width(spark, sf):
    df = table(spark, sf, "orders").select("o_totalprice")
    b = bins.equal_width_bins(df, "o_totalprice", 3, "bin", right_closed=True)
    return b.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.min("o_totalprice").alias("lo"),
                                F.max("o_totalprice").alias("hi"))


@q("qcut_quartiles", """
WITH e AS (SELECT quantile_cont(l_extendedprice, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM lineitem)
SELECT CASE WHEN l_extendedprice >= q[1] AND l_extendedprice <= q[2] THEN 'Q1'
            WHEN l_extendedprice > q[2] AND l_extendedprice <= q[3] THEN 'Q2'
            WHEN l_extendedprice > q[3] AND l_extendedprice <= q[4] THEN 'Q3'
            WHEN l_extendedprice > q[4] AND l_extendedprice <= q[5] THEN 'Q4' END AS quartile,
       count(*) AS n, round(min(l_extendedprice), 2) AS lo, round(max(l_extendedprice), 2) AS hi
FROM lineitem, e GROUP BY 1""")
def qcut_quartiles(spark, sf):
    df = table(spark, sf, "lineitem").select("l_extendedprice")
    b = bins.qcut(df, "l_extendedprice", 4, ["Q1", "Q2", "Q3", "Q4"], out="quartile")
    return b.groupBy("quartile").agg(F.count(F.lit(1)).alias("n"), F.round(F.min("l_extendedprice"), 2).alias("lo"),
                                     F.round(F.max("l_extendedprice"), 2).alias("hi"))


@q("symlog_roundtrip", """
SELECT o_orderkey, round(sign(x) * ln(1 + abs(x)), 9) AS slog,
       round(sign(sign(x) * ln(1 + abs(x))) * (exp(abs(sign(x) * ln(1 + abs(x)))) - 1), 4) AS back
FROM (SELECT o_orderkey, o_totalprice - 150000.0 AS x FROM orders)""")
def symlog_roundtrip(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", (F.col("o_totalprice") - 150000.0).alias("x"))
    s = df.select("o_orderkey", ops.symlog("x").alias("s"))
    return s.select("o_orderkey", F.round("s", 9).alias("slog"), F.round(ops.symexp("s"), 4).alias("back"))


@q("poly_degree2", f"""
SELECT l_orderkey, l_linenumber, l_quantity AS "l_quantity", l_discount AS "l_discount",
  round(l_quantity * l_quantity, 9) AS "l_quantity^2", round(l_quantity * l_discount, 9) AS "l_quantity l_discount",
  round(l_discount * l_discount, 9) AS "l_discount^2"
FROM {LJ}""")
def poly_degree2(spark, sf):
    df = lineitem_jobs(spark, sf)
    terms = bins.poly_terms(["l_quantity", "l_discount"], 2)
    return df.select(*KEYS, *[(F.round(e, 9) if "^" in n or " " in n else e).alias(n) for n, e in terms])


@q("poly_interactions", f"""
SELECT l_orderkey, l_linenumber, l_quantity AS "l_quantity", l_discount AS "l_discount", l_tax AS "l_tax",
  round(l_quantity * l_discount, 9) AS "l_quantity l_discount", round(l_quantity * l_tax, 9) AS "l_quantity l_tax",
  round(l_discount * l_tax, 9) AS "l_discount l_tax",
  round(l_quantity * l_discount * l_tax, 9) AS "l_quantity l_discount l_tax"
FROM {LJ}""")
def poly_interactions(spark, sf):
    df = lineitem_jobs(spark, sf)
    terms = bins.poly_terms(["l_quantity", "l_discount", "l_tax"], 3, interaction_only=True)
    return df.select(*KEYS, *[(F.round(e, 9) if " " in n else e).alias(n) for n, e in terms])


@q("drop_null_target", """
SELECT count(*) AS n_before, count(nullif(l_discount, 0)) AS n_after,
       count(*) - count(nullif(l_discount, 0)) AS n_dropped,
       round(avg(nullif(l_discount, 0)), 9) AS mean_target
FROM lineitem""")
def drop_null_target(spark, sf):
    df = table(spark, sf, "lineitem").select(F.nullif("l_discount", F.lit(0.0)).alias("target"))
    before = df.select(F.lit(1).alias("all"), F.lit(0).alias("kept"), F.lit(None).cast("double").alias("label"))
    after = prepare_rows(df, "target").select(F.lit(0).alias("all"), F.lit(1).alias("kept"), "label")
    stats = before.union(after).agg(F.sum("all").alias("n_before"), F.sum("kept").alias("n_after"), F.round(F.avg("label"), 9).alias("mean_target"))
    return stats.select("n_before", "n_after", (F.col("n_before") - F.col("n_after")).alias("n_dropped"),
                        "mean_target")


@q("clean_names", """
SELECT c_custkey AS Customer_Key, c_acctbal AS Account_Balance, c_mktsegment AS Market_Segment FROM customer""")
def clean_names(spark, sf):
    raw = table(spark, sf, "customer").select(F.col("c_custkey").alias(" Customer Key"),
                                              F.col("c_acctbal").alias("Account Balance "),
                                              F.col("c_mktsegment").alias("Market Segment"))
    return clean_column_names(raw)


@q("grouped_stats", """
SELECT p_brand, count(p_retailprice) AS count, round(avg(p_retailprice), 6) AS mean FROM part
WHERE p_brand IS NOT NULL GROUP BY p_brand""")
def grouped_stats(spark, sf):
    g = grouped_count_mean(table(spark, sf, "part"), "p_brand", "p_retailprice")
    return g.select("p_brand", "count", F.round("mean", 6).alias("mean"))


@q("grouped_mean", """
SELECT o_orderpriority, round(avg(o_totalprice), 4) AS mean FROM orders
WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""")
def grouped_mean_q(spark, sf):
    g = grouped_mean(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice")
    return g.select("o_orderpriority", F.round("mean", 4).alias("mean"))

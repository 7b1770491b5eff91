"""Registered queries, steps 3-4: impute, encode, scale, target-aware encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import prep, target
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


def _nulls(spark, sf):
    return table(spark, sf, "lineitem").select(*KEYS, F.nullif("l_discount", F.lit(0.0)).alias("discount"),
                                                F.nullif("l_tax", F.lit(0.0)).alias("tax"))


_NULLS_SQL = "(SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax FROM lineitem)"


def _impute(strategy):
    def run(spark, sf):
        df = _nulls(spark, sf)
        model = prep.NumericImputer(["discount", "tax"], strategy=strategy).fit(df)
        out = model.transform(df)
        return out.select(*KEYS, F.round("discount", 9).alias("discount"), F.round("tax", 9).alias("tax"))
    return run


Q["impute_mean"] = _impute("mean")
O["impute_mean"] = f"""SELECT l_orderkey, l_linenumber,
  round(coalesce(discount, (SELECT avg(discount) FROM {_NULLS_SQL})), 9) AS discount,
  round(coalesce(tax, (SELECT avg(tax) FROM {_NULLS_SQL})), 9) AS tax FROM {_NULLS_SQL}"""
Q["impute_median"] = _impute("median")
O["impute_median"] = f"""SELECT l_orderkey, l_linenumber,
  round(coalesce(discount, (SELECT median(discount) FROM {_NULLS_SQL})), 9) AS discount,
  round(coalesce(tax, (SELECT median(tax) FROM {_NULLS_SQL})), 9) AS tax FROM {_NULLS_SQL}"""
Q["impute_constant"] = _impute("constant")
O["impute_constant"] = f"""SELECT l_orderkey, l_linenumber, round(coalesce(discount, 0.0), 9) AS discount,
  round(coalesce(tax, 0.0), 9) AS tax FROM {_NULLS_SQL}"""


@q("fill_unknown", """
SELECT CASE WHEN rf IS NULL OR rf = 'nan' THEN 'Unknown' ELSE rf END AS returnflag,
       CASE WHEN ls IS NULL OR ls = 'nan' THEN 'Unknown' ELSE ls END AS linestatus,
       round(sum(coalesce(disc, 0.0)), 4) AS discount_sum, count(*) AS n
FROM (SELECT nullif(l_returnflag, 'N') AS rf, CASE WHEN l_linestatus = 'O' THEN 'nan' ELSE l_linestatus END AS ls,
             nullif(l_discount, 0) AS disc FROM lineitem) GROUP BY 1, 2""")
def fill_unknown(spark, sf):
    df = table(spark, sf, "lineitem").select(
        F.nullif("l_returnflag", F.lit("N")).alias("returnflag"),
        F.when(F.col("l_linestatus") == "O", F.lit("nan")).otherwise(F.col("l_linestatus")).alias("linestatus"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"))
    # M1 baseline for text, M4 sweep for what is left (numeric -> 0).
    out = prep.FillMissing().transform(prep.CategoricalBaseline(["returnflag"]).transform(df))
    return out.groupBy("returnflag", "linestatus").agg(F.round(F.sum("discount"), 4).alias("discount_sum"),
                                                       F.count(F.lit(1)).alias("n"))


@q("label_encode", """
WITH p AS (SELECT o_orderpriority AS v, dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS code
           FROM (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IS NOT NULL)),
s AS (SELECT o_orderstatus AS v, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS code
      FROM (SELECT DISTINCT o_orderstatus FROM orders WHERE o_orderstatus IS NOT NULL))
SELECT coalesce(p.code, -1) AS o_orderpriority, coalesce(s.code, -1) AS o_orderstatus, count(*) AS n
FROM orders LEFT JOIN p ON o_orderpriority = p.v LEFT JOIN s ON o_orderstatus = s.v GROUP BY 1, 2""")
def label_encode(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderpriority", "o_orderstatus")
    model = prep.LabelEncoder(["o_orderpriority", "o_orderstatus"]).fit(orders)
    return model.transform(orders).groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


_CUTOFF = "1997-01-01"


@q("label_encode_unseen", f"""
WITH m AS (SELECT v, dense_rank() OVER (ORDER BY v) - 1 AS code
           FROM (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS v FROM orders WHERE o_orderdate < TIMESTAMP '{_CUTOFF}'))
SELECT o_orderkey, coalesce(m.code, -1) AS cust_code
FROM orders LEFT JOIN m ON CAST(o_custkey AS VARCHAR) = m.v WHERE o_orderdate >= TIMESTAMP '{_CUTOFF}'""")
def label_encode_unseen(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("cust_code"),
                                               "o_orderdate")
    fit_rows = orders.where(F.col("o_orderdate") < F.lit(_CUTOFF).cast("timestamp_ntz"))
    later = orders.where(F.col("o_orderdate") >= F.lit(_CUTOFF).cast("timestamp_ntz"))
    model = prep.LabelEncoder(["cust_code"]).fit(fit_rows)
    return model.transform(later).select("o_orderkey", "cust_code")


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@q("onehot_wide", "SELECT c_custkey, " + ", ".join(
    f"CAST(coalesce(c_mktsegment, 'Unknown') = '{s}' AS DOUBLE) AS c_mktsegment_{s}" for s in _SEGMENTS)
   + " FROM customer")
def onehot_wide(spark, sf):
    cust = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return prep.OneHotWide(["c_mktsegment"]).fit(cust).transform(cust)


_SCALE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _scale(method, digits):
    def run(spark, sf):
        df = table(spark, sf, "lineitem").select(*KEYS, *_SCALE_COLS)
        out = prep.Scaler(_SCALE_COLS, method).fit(df).transform(df)
        return out.select(*KEYS, *[F.round(c, digits).alias(c) for c in _SCALE_COLS])
    return run


Q["scale_standard"] = _scale("standard", 6)
O["scale_standard"] = ("WITH s AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1.0 ELSE stddev_pop({c}) END AS s_{c}" for c in _SCALE_COLS)
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in _SCALE_COLS) + " FROM lineitem, s")
Q["scale_minmax"] = _scale("minmax", 9)
O["scale_minmax"] = ("WITH s AS (SELECT " + ", ".join(
    f"min({c}) AS lo_{c}, CASE WHEN max({c}) = min({c}) THEN 1.0 ELSE max({c}) - min({c}) END AS r_{c}"
    for c in _SCALE_COLS) + " FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - lo_{c}) / r_{c}, 9) AS {c}" for c in _SCALE_COLS) + " FROM lineitem, s")
Q["scale_robust"] = _scale("robust", 6)
O["scale_robust"] = ("WITH s AS (SELECT " + ", ".join(
    f"quantile_cont({c}, 0.5) AS md_{c}, CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN 1.0 "
    f"ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS r_{c}" for c in _SCALE_COLS)
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, " + ", ".join(
    f"round(({c} - md_{c}) / r_{c}, 6) AS {c}" for c in _SCALE_COLS) + " FROM lineitem, s")


# --- step 4: target-aware -------------------------------------------------------

_RARE_CUTOFF = "1998-01-01"
_MIN_FREQ = 0.0008


def _rare(version):
    def run(spark, sf):
        orders = table(spark, sf, "orders").select(F.col("o_custkey").cast("string").alias("customer"), "o_orderdate")
        fit_rows = orders.where(F.col("o_orderdate") < F.lit(_RARE_CUTOFF).cast("timestamp_ntz"))
        model = target.RareCategoryGrouper(["customer"], _MIN_FREQ, version=version).fit(fit_rows)
        return model.transform(orders).groupBy("customer").agg(F.count(F.lit(1)).alias("n"))
    return run


_RARE_FIT = f"""WITH f AS (SELECT CAST(o_custkey AS VARCHAR) AS v, count(*) AS c FROM orders
  WHERE o_orderdate < TIMESTAMP '{_RARE_CUTOFF}' AND o_custkey IS NOT NULL GROUP BY 1),
t AS (SELECT sum(c) AS total FROM f),
m AS (SELECT v, c / total < {_MIN_FREQ} AS rare FROM f, t)"""
Q["rare_group_v1"] = _rare(1)
O["rare_group_v1"] = _RARE_FIT + """
SELECT CASE WHEN coalesce(m.rare, false) THEN 'Other' ELSE CAST(o_custkey AS VARCHAR) END AS customer, count(*) AS n
FROM orders LEFT JOIN m ON CAST(o_custkey AS VARCHAR) = m.v GROUP BY 1"""
Q["rare_group_v2"] = _rare(2)
O["rare_group_v2"] = _RARE_FIT + """
SELECT CASE WHEN m.rare = false THEN CAST(o_custkey AS VARCHAR) ELSE 'Other' END AS customer, count(*) AS n
FROM orders LEFT JOIN m ON CAST(o_custkey AS VARCHAR) = m.v GROUP BY 1"""


def _brand_profit(spark, sf):
    li = lineitem_jobs(spark, sf).select("l_partkey", (F.col("claimed") - F.col("cost")).alias("profit"))
    part = table(spark, sf, "part").select("p_partkey", "p_brand")
    return li.join(part, li.l_partkey == part.p_partkey).select("p_brand", "profit")


def _tiers(m):
    def run(spark, sf):
        df = _brand_profit(spark, sf).withColumn("brand", F.col("p_brand"))
        model = target.TargetTierGrouper(["p_brand"], "profit", smoothing=m).fit(df)
        return model.transform(df).groupBy("brand", "p_brand_Tier").agg(F.count(F.lit(1)).alias("n"))
    return run


def _tier_sql(m):
    mean = "avg(profit)" if not m else f"(count(*) * avg(profit) + {m}.0::DOUBLE * (SELECT avg(profit) FROM j)) / (count(*) + {m}.0::DOUBLE)"
    return f"""WITH j AS (SELECT p_brand, claimed - cost AS profit FROM {LJ} JOIN part ON l_partkey = p_partkey),
s AS (SELECT p_brand, {mean} AS mean FROM j WHERE p_brand IS NOT NULL GROUP BY p_brand),
e AS (SELECT quantile_cont(mean, [0.0, 1.0::DOUBLE / 3, 2.0::DOUBLE / 3, 1.0]) AS q FROM s),
r AS (SELECT round(q[1], 9) AS e0, round(q[2], 9) AS e1, round(q[3], 9) AS e2, round(q[4], 9) AS e3 FROM e),
t AS (SELECT p_brand, CASE WHEN e0 = e1 OR e1 = e2 OR e2 = e3 THEN 'Tier_2'
     WHEN round(mean, 9) >= e0 AND round(mean, 9) <= e1 THEN 'Tier_3'
     WHEN round(mean, 9) > e1 AND round(mean, 9) <= e2 THEN 'Tier_2'
     WHEN round(mean, 9) > e2 AND round(mean, 9) <= e3 THEN 'Tier_1' END AS tier FROM s, r)
SELECT j.p_brand AS brand, coalesce(t.tier, 'Tier_2') AS p_brand_Tier, count(*) AS n
FROM j LEFT JOIN t ON j.p_brand = t.p_brand GROUP BY 1, 2"""


Q["tier_plain"] = _tiers(0.0)
O["tier_plain"] = _tier_sql(0)
Q["tier_smoothed"] = _tiers(10.0)
O["tier_smoothed"] = _tier_sql(10)


@q("tier_fallback", """
WITH s AS (SELECT CAST(p_size AS VARCHAR) AS v, avg(CAST(p_size > 25 AS INTEGER)) AS mean FROM part
           WHERE p_size IS NOT NULL GROUP BY 1),
e AS (SELECT quantile_cont(mean, [0.0, 1.0::DOUBLE / 3, 2.0::DOUBLE / 3, 1.0]) AS q FROM s),
r AS (SELECT round(q[1], 9) AS e0, round(q[2], 9) AS e1, round(q[3], 9) AS e2, round(q[4], 9) AS e3 FROM e),
t AS (SELECT v, CASE WHEN e0 = e1 OR e1 = e2 OR e2 = e3 THEN 'Tier_2'
     WHEN round(mean, 9) <= e1 THEN 'Tier_3' WHEN round(mean, 9) <= e2 THEN 'Tier_2' ELSE 'Tier_1' END AS tier FROM s, r)
SELECT coalesce(t.tier, 'Tier_2') AS p_size_Tier, count(*) AS n
FROM part LEFT JOIN t ON CAST(p_size AS VARCHAR) = t.v GROUP BY 1""")
def tier_fallback(spark, sf):
    part = table(spark, sf, "part").select("p_size", (F.col("p_size") > 25).cast("int").alias("big"))
    model = target.TargetTierGrouper(["p_size"], "big").fit(part)
    return model.transform(part).groupBy("p_size_Tier").agg(F.count(F.lit(1)).alias("n"))


@q("ordered_target_encoding", """
SELECT event_id, round((coalesce(sum(value) OVER w, 0.0) + 1.0 * (SELECT avg(value) FROM events))
  / (coalesce(count(*) OVER w, 0) + 1.0), 4) AS value_enc
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def ordered_target_encoding(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "event_type", "value")
    enc = target.ordered_target_encode(ev, "event_type", "value", "event_id", "value_enc", prior_weight=1.0)
    return enc.select("event_id", F.round("value_enc", 4).alias("value_enc"))

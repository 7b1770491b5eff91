"""Registered queries, step 2: profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile
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


def _rounded(df, digits, skip=()):
    from pyspark.sql.types import DoubleType
    return df.select(*[F.round(c, digits).alias(c) if isinstance(df.schema[c].dataType, DoubleType) and c not in skip
                       else F.col(c) for c in df.columns])


def _nullable_lineitem(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_quantity", F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"), F.nullif("l_returnflag", F.lit("N")).alias("returnflag"))


_NULLABLE_SQL = """(SELECT l_quantity, nullif(l_discount, 0) AS discount, nullif(l_tax, 0) AS tax,
  nullif(l_returnflag, 'N') AS returnflag FROM lineitem)"""


@q("null_report", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS null_count, "
    f"round((count(*) - count({c})) * 100.0 / count(*), 4) AS null_pct, "
    f"(count(*) - count({c})) * 100.0 / count(*) > 5.0 AS warn FROM {_NULLABLE_SQL}"
    for c in ["l_quantity", "discount", "tax", "returnflag"]) + ") WHERE null_count > 0")
def null_report(spark, sf):
    rep = profile.null_report(_nullable_lineitem(spark, sf))
    return rep.select("column_name", "null_count", "null_pct", "warn")


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@q("describe_numeric", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    f"round(quantile_cont({c}, 0.75), 6) AS p75, round(max({c}), 6) AS max FROM lineitem" for c in _DESC_COLS))
def describe_numeric(spark, sf):
    return _rounded(profile.describe(table(spark, sf, "lineitem"), _DESC_COLS), 6)


@q("value_shares", """
SELECT o_orderpriority, count(*) AS cnt, round(count(*) / sum(count(*)) OVER (), 9) AS share
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""")
def value_shares(spark, sf):
    s = profile.value_shares(table(spark, sf, "orders"), "o_orderpriority")
    return s.select("o_orderpriority", "cnt", F.round("share", 9).alias("share"))


@q("target_profile", """
SELECT count(o_totalprice) AS n, round(avg(o_totalprice), 6) AS mean, round(median(o_totalprice), 6) AS median,
  round(stddev_samp(o_totalprice), 6) AS std, round(min(o_totalprice), 6) AS min, round(max(o_totalprice), 6) AS max,
  round(max(o_totalprice) - min(o_totalprice), 6) AS range, round(skewness(o_totalprice), 6) AS skew,
  round(kurtosis(o_totalprice), 6) AS kurtosis
FROM orders""")
def target_profile(spark, sf):
    return _rounded(profile.target_profile(table(spark, sf, "orders"), "o_totalprice"), 6)


@q("iqr_outliers", """
WITH q AS (SELECT quantile_cont(o_totalprice, 0.25) AS q1, quantile_cont(o_totalprice, 0.75) AS q3 FROM orders),
f AS (SELECT q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
SELECT round(q1, 4) AS q1, round(q3, 4) AS q3, round(iqr, 4) AS iqr, round(lo, 4) AS lower_fence,
  round(hi, 4) AS upper_fence,
  count(*) FILTER (WHERE o_totalprice < lo OR o_totalprice > hi) AS n_outliers,
  round(count(*) FILTER (WHERE o_totalprice < lo OR o_totalprice > hi) * 100.0 / count(o_totalprice), 6) AS pct_outliers,
  round(min(o_totalprice) FILTER (WHERE o_totalprice < lo OR o_totalprice > hi), 4) AS min_outlier,
  round(max(o_totalprice) FILTER (WHERE o_totalprice < lo OR o_totalprice > hi), 4) AS max_outlier
FROM orders, f GROUP BY q1, q3, iqr, lo, hi""")
def iqr_outliers(spark, sf):
    r = profile.iqr_outliers(table(spark, sf, "orders"), "o_totalprice")
    r = _rounded(r, 4)
    return r.withColumn("pct_outliers", F.round("pct_outliers", 6))


@q("histogram30", """
WITH s AS (SELECT min(o_totalprice) AS mn, max(o_totalprice) AS mx FROM orders),
b AS (SELECT CAST(least(floor((o_totalprice - mn) / ((mx - mn) / 30.0)), 29) AS INTEGER) AS bin FROM orders, s),
c AS (SELECT bin, count(*) AS cnt FROM b GROUP BY bin)
SELECT CAST(r.bin AS INTEGER) AS bin, coalesce(c.cnt, 0) AS count, round(mn + r.bin * ((mx - mn) / 30.0), 4) AS lower,
  round(mn + (r.bin + 1) * ((mx - mn) / 30.0), 4) AS upper
FROM (SELECT range AS bin FROM range(30)) r LEFT JOIN c ON r.bin = c.bin, s""")
def histogram30(spark, sf):
    h = profile.histogram(table(spark, sf, "orders"), "o_totalprice", 30)
    return h.select("bin", "count", F.round("lower", 4).alias("lower"), F.round("upper", 4).alias("upper"))


_FLAGS = ["is_returned", "is_open", "is_bulk"]


@q("flag_exclusivity", f"""
SELECT round(avg(CAST(s <= 1 AS DOUBLE)), 9) AS exclusivity_rate, round(avg(s), 9) AS mean_active, count(*) AS n_rows
FROM (SELECT coalesce(is_returned, 0.0) + coalesce(is_open, 0.0) + coalesce(is_bulk, 0.0) AS s FROM {LJ})""")
def flag_exclusivity(spark, sf):
    r = profile.flag_exclusivity(lineitem_jobs(spark, sf), _FLAGS)
    return r.select(F.round("exclusivity_rate", 9).alias("exclusivity_rate"),
                    F.round("mean_active", 9).alias("mean_active"), "n_rows")


@q("flag_bundle", f"""
SELECT CASE WHEN is_returned = 1 THEN 'is_returned' WHEN is_open = 1 THEN 'is_open' WHEN is_bulk = 1 THEN 'is_bulk'
  ELSE 'none' END AS bundle, count(*) AS n,
  count(*) FILTER (WHERE coalesce(is_returned, 0) + coalesce(is_open, 0) + coalesce(is_bulk, 0) > 1) AS n_conflict
FROM {LJ} GROUP BY 1""")
def flag_bundle(spark, sf):
    return profile.flag_bundle(lineitem_jobs(spark, sf), _FLAGS)

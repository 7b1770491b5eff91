"""Registered queries, step 5: boosting statistics on the part table
(id p_partkey, feature p_retailprice, integer target p_size)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import boosting
from .tables import table

Q, O = {}, {}


def q(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            O[name] = sql
        return fn
    return deco


THRESHOLD = 950.0
LAMBDA = 1.0
ETA = 0.3
N_BINS = 20


def _part(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_retailprice", "p_size")


def _f0(df):
    return df.agg(F.avg(F.col("p_size").cast("double"))).first()[0]


_G = "(SELECT p_partkey, p_retailprice, p_size, -2.0 * (p_size - (SELECT avg(p_size) FROM part)) AS g, 2.0::DOUBLE AS h FROM part)"
_F0 = "(SELECT avg(p_size) FROM part)"


@q("grad_hess", f"SELECT p_partkey, round(g, 9) + 0.0 AS g, h FROM {_G}")
def grad_hess(spark, sf):
    gh = boosting.grad_hess(_part(spark, sf), "p_size")
    return gh.select("p_partkey", F.round("g", 9).alias("g"), "h")


_BINS = f"""(SELECT p_partkey, p_size, g, h, CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((p_retailprice - mn) / w), {N_BINS - 1}) END
  AS INTEGER) AS bin, mn, w FROM {_G},
  (SELECT min(p_retailprice) AS mn, (max(p_retailprice) - min(p_retailprice)) / {float(N_BINS)} AS w FROM part))"""


@q("grad_histogram", f"""
SELECT CAST(r.range AS INTEGER) AS bin, coalesce(c.n, 0) AS count, round(coalesce(c.G, 0.0), 6) + 0.0 AS G,
  round(coalesce(c.H, 0.0), 6) AS H, round(s.mn + r.range * s.w, 6) AS lower
FROM range({N_BINS}) r LEFT JOIN (SELECT bin, count(*) AS n, sum(g) AS G, sum(h) AS H FROM {_BINS} GROUP BY bin) c
  ON r.range = c.bin,
  (SELECT min(p_retailprice) AS mn, (max(p_retailprice) - min(p_retailprice)) / {float(N_BINS)} AS w FROM part) s""")
def grad_histogram(spark, sf):
    gh = boosting.grad_hess(_part(spark, sf), "p_size")
    hist = boosting.gradient_histogram(gh, "p_retailprice", N_BINS)
    return hist.select("bin", "count", F.round("G", 6).alias("G"), F.round("H", 6).alias("H"),
                       F.round("lower", 6).alias("lower"))


def _gain_sql(src, extra_cols):
    """Gain columns from exact prefix counts (nl, syl) and totals (nt, syt)."""
    gl = f"(2.0 * (nl * {_F0} - syl))"
    hl = "(2.0 * nl)"
    g = f"(2.0 * (nt * {_F0} - syt))"
    h = "(2.0 * nt)"
    gain = (f"0.5 * ({gl} * {gl} / ({hl} + {LAMBDA}) + ({g} - {gl}) * ({g} - {gl}) / (({h} - {hl}) + {LAMBDA}) "
            f"- {g} * {g} / ({h} + {LAMBDA}))")
    return (f"SELECT {extra_cols}, round({gain}, 4) + 0.0 AS gain, round(-{gl} / ({hl} + {LAMBDA}), 6) + 0.0 AS w_left, "
            f"round(-({g} - {gl}) / (({h} - {hl}) + {LAMBDA}), 6) + 0.0 AS w_right FROM {src}")


@q("split_gain_hist", _gain_sql(f"""(
  SELECT bin, lower, coalesce(sum(cnt) OVER w, 0) AS nl, coalesce(sum(sy) OVER w, 0) AS syl,
         sum(cnt) OVER () AS nt, sum(sy) OVER () AS syt
  FROM (SELECT r.range AS bin, coalesce(c.cnt, 0) AS cnt, coalesce(c.sy, 0) AS sy, s.mn + r.range * s.w AS lower
        FROM range({N_BINS}) r LEFT JOIN (SELECT bin, count(*) AS cnt, sum(p_size) AS sy FROM {_BINS} GROUP BY bin) c
        ON r.range = c.bin,
        (SELECT min(p_retailprice) AS mn, (max(p_retailprice) - min(p_retailprice)) / {float(N_BINS)} AS w FROM part) s)
  WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) WHERE bin >= 1""",
                                        "CAST(bin AS INTEGER) AS bin, round(lower, 6) AS threshold"))
def split_gain_hist(spark, sf):
    part = _part(spark, sf)
    f0 = _f0(part)
    binned, st = boosting.histogram_bins(part, "p_retailprice", N_BINS)
    agg = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.sum("p_size").alias("sum_y"))
    all_bins = spark.range(N_BINS).select(F.col("id").cast("int").alias("bin"))
    mn, width = st.first()
    hist = (all_bins.join(agg, "bin", "left").fillna(0, ["count", "sum_y"])
            .withColumn("lower", F.lit(mn) + F.col("bin") * F.lit(width)))
    gains = boosting.histogram_split_gains(hist, LAMBDA, f0=f0)
    return gains.select("bin", F.round("threshold", 6).alias("threshold"), F.round("gain", 4).alias("gain"),
                        F.round("w_left", 6).alias("w_left"), F.round("w_right", 6).alias("w_right"))


@q("split_exact", _gain_sql("""(
  SELECT x, nx, coalesce(sum(cnt) OVER w, 0) AS nl, coalesce(sum(sy) OVER w, 0) AS syl,
         sum(cnt) OVER () AS nt, sum(sy) OVER () AS syt
  FROM (SELECT p_retailprice AS x, lead(p_retailprice) OVER (ORDER BY p_retailprice) AS nx, cnt, sy
        FROM (SELECT p_retailprice, count(*) AS cnt, sum(p_size) AS sy FROM part GROUP BY p_retailprice))
  WINDOW w AS (ORDER BY x ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
  WHERE nx IS NOT NULL""", "round(x, 6) AS left_max, round((x + nx) / 2.0, 6) AS threshold")
    .replace("SELECT round(x", "SELECT * FROM (SELECT round(x", 1) + " ORDER BY gain DESC, threshold LIMIT 1)")
def split_exact(spark, sf):
    part = _part(spark, sf)
    f0 = _f0(part)
    stats = part.groupBy("p_retailprice").agg(F.count(F.lit(1)).alias("count"), F.sum("p_size").alias("sum_y"))
    cands = boosting.exact_split_candidates(stats, "p_retailprice", LAMBDA, f0=f0)
    best = boosting.best_split(cands)
    return best.select(F.round("left_max", 6).alias("left_max"), F.round("threshold", 6).alias("threshold"),
                       F.round("gain", 4).alias("gain"), F.round("w_left", 6).alias("w_left"),
                       F.round("w_right", 6).alias("w_right"))


@q("leaf_weights", f"""
SELECT CASE WHEN p_retailprice < {THRESHOLD} THEN 'left' ELSE 'right' END AS side, count(*) AS count,
  round(sum(g), 6) + 0.0 AS G, round(sum(h), 6) AS H, round(-sum(g) / (sum(h) + {LAMBDA}), 6) + 0.0 AS weight
FROM {_G} GROUP BY 1""")
def leaf_weights(spark, sf):
    gh = boosting.grad_hess(_part(spark, sf), "p_size")
    lw = boosting.leaf_weights(gh, "p_retailprice", THRESHOLD, lam=LAMBDA)
    return lw.select("side", "count", F.round("G", 6).alias("G"), F.round("H", 6).alias("H"),
                     F.round("weight", 6).alias("weight"))


@q("boost_step", f"""
WITH w AS (SELECT CASE WHEN p_retailprice < {THRESHOLD} THEN 'left' ELSE 'right' END AS side,
                  -sum(g) / (sum(h) + {LAMBDA}) AS weight FROM {_G} GROUP BY 1),
p AS (SELECT p_size, {_F0} AS before,
             {_F0} + {ETA} * (CASE WHEN p_retailprice < {THRESHOLD} THEN (SELECT weight FROM w WHERE side = 'left')
                                   ELSE (SELECT weight FROM w WHERE side = 'right') END) AS after FROM part)
SELECT round(avg((p_size - before) * (p_size - before)), 6) AS mse_before,
       round(avg((p_size - after) * (p_size - after)), 6) AS mse_after,
       round((avg((p_size - before) * (p_size - before)) - avg((p_size - after) * (p_size - after)))
             / avg((p_size - before) * (p_size - before)) * 100.0, 6) AS improvement_pct
FROM p""")
def boost_step(spark, sf):
    part = _part(spark, sf)
    gh = boosting.grad_hess(part, "p_size")
    w = {r["side"]: r["weight"] for r in boosting.leaf_weights(gh, "p_retailprice", THRESHOLD, lam=LAMBDA).collect()}
    f0 = _f0(part)
    stepped = boosting.boost_step(part.withColumn("before", F.lit(f0)), "p_retailprice", THRESHOLD,
                                  w.get("left", 0.0), w.get("right", 0.0), f0, ETA, out="after")
    m = boosting.mse_before_after(stepped, "p_size", "before", "after")
    return m.select(*[F.round(c, 6).alias(c) for c in ["mse_before", "mse_after", "improvement_pct"]])


@q("goss_sample", f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY abs(g) DESC, p_partkey) AS rk FROM {_G}),
n AS (SELECT count(*) AS n, CAST(floor(count(*) * 0.2) AS BIGINT) AS top_n, CAST(floor(count(*) * 0.1) AS BIGINT) AS bot_n
      FROM part),
top AS (SELECT p_partkey, 1.0 AS weight, 'top' AS part FROM r, n WHERE rk <= top_n),
rest AS (SELECT p_partkey, row_number() OVER (ORDER BY md5('42:' || CAST(p_partkey AS VARCHAR))) AS hk
         FROM r, n WHERE rk > top_n)
SELECT p_partkey, round(weight, 6) AS weight, part FROM top
UNION ALL
SELECT p_partkey, round(CAST(n - top_n AS DOUBLE) / bot_n, 6) AS weight, 'sampled' AS part FROM rest, n WHERE hk <= bot_n""")
def goss_sample(spark, sf):
    gh = boosting.grad_hess(_part(spark, sf), "p_size")
    s = boosting.goss_sample(gh, "p_partkey", "g", 0.2, 0.1, seed=42)
    return s.select("p_partkey", F.round("weight", 6).alias("weight"), "part")


@q("ordered_leaf_weight", f"""
SELECT p_partkey, CASE WHEN p_retailprice < {THRESHOLD} THEN 'left' ELSE 'right' END AS side,
  round(-coalesce(sum(g) OVER w, 0.0) / (coalesce(sum(h) OVER w, 0.0) + {LAMBDA}), 6) + 0.0 AS ordered_weight
FROM {_G} WINDOW w AS (PARTITION BY CASE WHEN p_retailprice < {THRESHOLD} THEN 'left' ELSE 'right' END
  ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""")
def ordered_leaf_weight(spark, sf):
    gh = boosting.grad_hess(_part(spark, sf), "p_size")
    o = boosting.ordered_leaf_weight(gh, "p_partkey", "p_retailprice", THRESHOLD, lam=LAMBDA)
    return o.select("p_partkey", "side", F.round("ordered_weight", 6).alias("ordered_weight"))

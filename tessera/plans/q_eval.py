"""Registered queries, step 6: splits, folds and metrics.

Predictions are deterministic without a learner (group means of an integer
target), so every metric has an exact SQL twin.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from ..functions.stats import quantiles
from ..operators import metrics, profile, split
from .learners import create_learner
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


def _r(df, digits):
    return df.select(*[F.round(c, digits).alias(c) if dict(df.dtypes)[c] == "double" else F.col(c)
                       for c in df.columns])


_HASH_RANK = "row_number() OVER (ORDER BY md5('42:' || CAST({id} AS VARCHAR)))"


@q("train_valid_split", f"""
SELECT o_orderkey, CASE WHEN {_HASH_RANK.format(id='o_orderkey')} <= (SELECT CAST(ceil(count(*) * 0.2) AS BIGINT) FROM orders)
  THEN 'valid' ELSE 'train' END AS split FROM orders""")
def train_valid_split(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return split.train_valid_split(o, "o_orderkey", 0.2, seed=42)


@q("kfold_sizes", f"""
SELECT fold, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum
FROM (SELECT o_orderkey, CAST(({_HASH_RANK.format(id='o_orderkey')} - 1) % 5 AS INTEGER) AS fold FROM orders)
GROUP BY fold""")
def kfold_sizes(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    f = split.kfold(o, "o_orderkey", 5, seed=42)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"))


# Group-mean model: predict l_quantity by the mean of its return-flag group.
def _group_mean_preds(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_quantity")
    means = li.groupBy("l_returnflag").agg(F.avg(F.col("l_quantity").cast("double")).alias("pred"))
    return li.join(F.broadcast(means), "l_returnflag")  # one row per flag value


_PRED_SQL = """(SELECT l_quantity, pred FROM lineitem
  JOIN (SELECT l_returnflag AS f, avg(l_quantity) AS pred FROM lineitem GROUP BY 1) m ON l_returnflag = m.f)"""


@q("regression_metrics", f"""
SELECT count(*) AS n, round(avg(abs(l_quantity - pred)), 9) AS mae,
  round(avg((l_quantity - pred) * (l_quantity - pred)), 9) AS mse,
  round(sqrt(avg((l_quantity - pred) * (l_quantity - pred))), 9) AS rmse,
  round(1.0 - avg((l_quantity - pred) * (l_quantity - pred)) / var_pop(l_quantity), 9) AS r2
FROM {_PRED_SQL}""")
def regression_metrics(spark, sf):
    return _r(metrics.regression_metrics(_group_mean_preds(spark, sf), "l_quantity", "pred"), 9)


@q("mape", f"""
SELECT round(avg(abs(l_quantity - pred) / greatest(abs(l_quantity), 2.220446049250313e-16)) * 100.0, 9) AS mape,
  round(avg(abs(l_quantity - pred) / abs(l_quantity)) * 100.0, 9) AS mape_raw
FROM {_PRED_SQL}""")
def mape(spark, sf):
    return _r(metrics.mape(_group_mean_preds(spark, sf), "l_quantity", "pred"), 9)


@q("residual_stats", f"""
SELECT round(avg(l_quantity - pred), 9) + 0.0 AS mean, round(stddev_samp(l_quantity - pred), 9) AS std,
  round(stddev_pop(l_quantity - pred), 9) AS std_pop, round(max(l_quantity - pred), 9) AS max,
  round(min(l_quantity - pred), 9) AS min
FROM {_PRED_SQL}""")
def residual_stats(spark, sf):
    return _r(metrics.residual_stats(_group_mean_preds(spark, sf), "l_quantity", "pred"), 9)


@q("group_mean_summary", f"""
SELECT round(min(pred), 9) AS min, round(max(pred), 9) AS max, round(avg(pred), 9) AS mean,
  round(stddev_pop(pred), 9) AS std FROM {_PRED_SQL}""")
def group_mean_summary(spark, sf):
    return _r(profile.prediction_summary(_group_mean_preds(spark, sf), "pred"), 9)


@q("baseline_improvement", f"""
WITH s AS (SELECT p_partkey, p_type, p_size,
             CASE WHEN {_HASH_RANK.format(id='p_partkey')} <= (SELECT CAST(ceil(count(*) * 0.2) AS BIGINT) FROM part)
             THEN 'valid' ELSE 'train' END AS split FROM part),
m AS (SELECT p_type, avg(p_size) AS pred FROM s WHERE split = 'train' GROUP BY p_type),
b AS (SELECT avg(p_size) AS base FROM s WHERE split = 'train'),
v AS (SELECT p_size, coalesce(m.pred, b.base) AS pred, b.base FROM s LEFT JOIN m ON s.p_type = m.p_type, b
      WHERE split = 'valid')
SELECT round(avg(abs(p_size - pred)), 9) AS mae, round(avg(abs(p_size - base)), 9) AS baseline_mae,
  round(sqrt(avg((p_size - base) * (p_size - base))), 9) AS baseline_rmse,
  round(1.0 - avg((p_size - base) * (p_size - base)) / var_pop(p_size), 9) AS baseline_r2,
  round((avg(abs(p_size - base)) - avg(abs(p_size - pred))) / avg(abs(p_size - base)) * 100.0, 9) AS improvement_pct,
  round(any_value(base), 9) AS baseline
FROM v""")
def baseline_improvement(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    s = split.train_valid_split(part, "p_partkey", 0.2, seed=42)
    train, valid = s.where(F.col("split") == "train"), s.where(F.col("split") == "valid")
    means = train.groupBy("p_type").agg(F.avg(F.col("p_size").cast("double")).alias("pred"))
    base = train.agg(F.avg(F.col("p_size").cast("double"))).first()[0]
    scored = (valid.join(F.broadcast(means), "p_type", "left")
              .withColumn("pred", F.coalesce("pred", F.lit(base).cast("double"))))
    return _r(metrics.baseline_comparison(train, scored, "p_size", "pred"), 9)


# Classification: label = returned line, prediction = discount above 5 %.
def _cls(spark, sf):
    return lineitem_jobs(spark, sf).select(F.col("is_returned").alias("label"),
                                           F.col("is_discounted").alias("pred"),
                                           (F.col("l_discount") * 10.0 + F.col("l_tax")).alias("score"))


_CLS_SQL = f"(SELECT is_returned AS label, is_discounted AS pred, l_discount * 10.0 + l_tax AS score FROM {LJ})"


@q("confusion", f"""
SELECT label, count(*) FILTER (WHERE pred = 0) AS pred_0, count(*) FILTER (WHERE pred = 1) AS pred_1
FROM {_CLS_SQL} GROUP BY label""")
def confusion(spark, sf):
    return metrics.confusion_matrix(_cls(spark, sf), "label", "pred", [0, 1])


_PER_CLASS_SQL = f"""WITH cells AS (SELECT label, pred, count(*) AS c FROM {_CLS_SQL} GROUP BY 1, 2),
sup AS (SELECT label AS cls, sum(c) AS support FROM cells GROUP BY 1),
prd AS (SELECT pred AS cls, sum(c) AS predicted FROM cells GROUP BY 1),
tp AS (SELECT label AS cls, c AS tp FROM cells WHERE label = pred),
base AS (SELECT coalesce(sup.cls, prd.cls) AS cls, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted,
         coalesce(tp.tp, 0) AS tp FROM sup FULL JOIN prd ON sup.cls = prd.cls LEFT JOIN tp ON coalesce(sup.cls, prd.cls) = tp.cls),
per AS (SELECT cls, support, predicted, tp,
          CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS precision,
          CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS recall FROM base),
per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END
         AS f1 FROM per)"""


@q("class_report", _PER_CLASS_SQL + """
SELECT CAST(cls AS VARCHAR) AS class, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1,
  CAST(support AS BIGINT) AS support FROM per2
UNION ALL SELECT 'accuracy', round(sum(tp) / sum(support), 9), round(sum(tp) / sum(support), 9),
  round(sum(tp) / sum(support), 9), CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
  CAST(sum(support) AS BIGINT) FROM per2
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
  round(sum(recall * support) / sum(support), 9), round(sum(f1 * support) / sum(support), 9),
  CAST(sum(support) AS BIGINT) FROM per2""")
def class_report(spark, sf):
    return _r(metrics.classification_report(_cls(spark, sf), "label", "pred"), 9)


@q("balanced_accuracy", _PER_CLASS_SQL + """
SELECT round(sum(tp) / sum(support), 9) AS accuracy, round(avg(recall), 9) AS balanced_accuracy,
  round(avg(f1), 9) AS macro_f1 FROM per2""")
def balanced_accuracy(spark, sf):
    return _r(metrics.classification_scores(_cls(spark, sf), "label", "pred"), 9)


@q("roc_auc", f"""
WITH s AS (SELECT score, count(*) FILTER (WHERE label = 1) AS p, count(*) FILTER (WHERE label <> 1) AS q
           FROM {_CLS_SQL} GROUP BY score),
c AS (SELECT p, q, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM s)
SELECT round(sum(p * (nb + 0.5 * q)) / (sum(p) * sum(q)), 9) AS auc, CAST(sum(p) AS BIGINT) AS n_pos,
  CAST(sum(q) AS BIGINT) AS n_neg FROM c""")
def roc_auc(spark, sf):
    return _r(metrics.roc_auc(_cls(spark, sf), "label", "score"), 9)


@q("class_weights", """
SELECT l_returnflag, count(*) AS n_c,
  round((SELECT count(*) FROM lineitem) / ((SELECT count(DISTINCT l_returnflag) FROM lineitem) * count(*)), 9) AS weight
FROM lineitem GROUP BY l_returnflag""")
def class_weights(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag")
    return _r(metrics.class_weights(li, "l_returnflag"), 9)


_MI_FEATURES = ["l_linestatus", "l_linenumber", "is_bulk"]


def _mi_sql(src, features, label):
    parts = " UNION ALL ".join(f"SELECT '{f}' AS feature, CAST({f} AS VARCHAR) AS value, {label} AS y FROM {src}"
                               for f in features)
    return f"""WITH long AS ({parts}),
cells AS (SELECT feature, value, y, count(*) AS nxy FROM long WHERE y IS NOT NULL GROUP BY ALL),
nx AS (SELECT feature, value, sum(nxy) AS nx FROM cells GROUP BY ALL),
ny AS (SELECT feature, y, sum(nxy) AS ny FROM cells GROUP BY ALL),
n AS (SELECT feature, sum(nxy) AS n FROM cells GROUP BY ALL)
SELECT feature, round(sum(nxy / n * ln((nxy * n) / (nx * ny))), 9) AS mi
FROM cells JOIN nx USING (feature, value) JOIN ny USING (feature, y) JOIN n USING (feature) GROUP BY feature"""


@q("mutual_info_discrete", _mi_sql(LJ, _MI_FEATURES, "l_returnflag"))
def mutual_info_discrete(spark, sf):
    mi = profile.mutual_info(lineitem_jobs(spark, sf), _MI_FEATURES, "l_returnflag")
    return mi.select("feature", F.round("mi", 9).alias("mi"))


_MI_BIN_SRC = """(SELECT l_returnflag,
  CASE WHEN l_extendedprice <= e[2] THEN 0 WHEN l_extendedprice <= e[3] THEN 1 WHEN l_extendedprice <= e[4] THEN 2
       WHEN l_extendedprice <= e[5] THEN 3 ELSE 4 END AS price_bin,
  CASE WHEN l_tax <= t[2] THEN 0 WHEN l_tax <= t[3] THEN 1 WHEN l_tax <= t[4] THEN 2
       WHEN l_tax <= t[5] THEN 3 ELSE 4 END AS tax_bin
FROM lineitem, (SELECT quantile_cont(l_extendedprice, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS e,
                       quantile_cont(l_tax, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0]) AS t FROM lineitem))"""


@q("mutual_info_binned", _mi_sql(_MI_BIN_SRC, ["price_bin", "tax_bin"], "l_returnflag"))
def mutual_info_binned(spark, sf):
    li = table(spark, sf, "lineitem").select("l_returnflag", "l_extendedprice", "l_tax")
    out = li
    probs = [i / 5 for i in range(6)]
    all_edges = quantiles(li, ["l_extendedprice", "l_tax"], probs)  # both columns in the same passes
    for src, name in [("l_extendedprice", "price_bin"), ("l_tax", "tax_bin")]:
        edges = all_edges[src]
        # Edges may repeat on coarse columns: each value goes to its first bin.
        expr = None
        for i in range(1, 5):
            cond = F.col(src) <= F.lit(edges[i])
            expr = F.when(cond, F.lit(i - 1)) if expr is None else expr.when(cond, F.lit(i - 1))
        out = out.withColumn(name, expr.otherwise(F.lit(4)))
    mi = profile.mutual_info(out, ["price_bin", "tax_bin"], "l_returnflag")
    return mi.select("feature", F.round("mi", 9).alias("mi"))


@q("ols_closed_form", """
SELECT round(regr_slope(l_extendedprice, l_quantity), 6) AS slope,
  round(regr_intercept(l_extendedprice, l_quantity), 6) AS intercept,
  round(regr_r2(l_extendedprice, l_quantity), 9) AS r2 FROM lineitem""")
def ols_closed_form(spark, sf):
    """The linear learner on one feature: coefficient, intercept and R2."""
    li = table(spark, sf, "lineitem").select(array_to_vector(F.array(F.col("l_quantity").cast("double"))).alias("features"),
                                             F.col("l_extendedprice").alias("label"))
    model = create_learner({"type": "linear"}).fit(li)
    rows = [(float(model.coefficients[0]), float(model.intercept), float(model.summary.r2))]
    fitted = spark.createDataFrame(rows, "slope double, intercept double, r2 double")
    return fitted.select(F.round("slope", 6).alias("slope"), F.round("intercept", 6).alias("intercept"), F.round("r2", 9).alias("r2"))


@q("overfit_gap", f"""
WITH s AS (SELECT p_type, p_size,
             CASE WHEN {_HASH_RANK.format(id='p_partkey')} <= (SELECT CAST(ceil(count(*) * 0.2) AS BIGINT) FROM part)
             THEN 'valid' ELSE 'train' END AS split FROM part),
m AS (SELECT p_type, avg(p_size) AS pred FROM s WHERE split = 'train' GROUP BY p_type),
e AS (SELECT split, 1.0 - avg((p_size - pred) * (p_size - pred)) / var_pop(p_size) AS r2
      FROM s JOIN m USING (p_type) GROUP BY split)
SELECT round(t.r2, 9) AS train_r2, round(v.r2, 9) AS test_r2, round(t.r2 - v.r2, 9) AS gap,
  CASE WHEN t.r2 - v.r2 < 0.1 THEN 'ok' WHEN t.r2 - v.r2 < 0.2 THEN 'mild' ELSE 'severe' END AS band
FROM e t, e v WHERE t.split = 'train' AND v.split = 'valid'""")
def overfit_gap(spark, sf):
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    s = split.train_valid_split(part, "p_partkey", 0.2, seed=42)
    means = s.where(F.col("split") == "train").groupBy("p_type").agg(
        F.avg(F.col("p_size").cast("double")).alias("pred"))
    scored = s.join(F.broadcast(means), "p_type")
    tr = metrics.regression_metrics(scored.where(F.col("split") == "train"), "p_size", "pred")
    te = metrics.regression_metrics(scored.where(F.col("split") == "valid"), "p_size", "pred")
    return _r(metrics.overfit_gap(tr, te), 9)

"""Registered queries, step 7: train, tune, score, log.

The job table is ``order_jobs`` (one row per order, id ``o_orderkey``). Linear
flows are checked against least squares in SQL. Learners without a closed form
report facts that SQL knows: which features they used, how many rows they were
judged on, and whether they beat the mean.
"""

from __future__ import annotations

import os
import uuid
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from ..operators import metrics, profile
from ..session import ensure_checkpoint_dir, kept
from ..sources.sinks import RunLog, load_model, save_model
from . import learners, score, search, train
from .features import plan_features, prepare_rows, split_rows
from .tables import order_jobs, table

Q, O = {}, {}
ID = "o_orderkey"
FEATURES = ["o_totalprice", "quantity", "n_lines", "c_acctbal", "o_orderstatus", "o_orderpriority", "c_mktsegment"]


def q(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            O[name] = sql
        return fn
    return deco


# The job table, its hash split (T1) and least squares on two features, for the oracles.
JOBS_SQL = """j AS (SELECT o_orderkey, o_totalprice, quantity, n_lines, c_acctbal, o_orderstatus, o_orderpriority, c_mktsegment,
  claimed - cost AS saving, has_return
  FROM (SELECT l_orderkey, sum(l_extendedprice) AS claimed, sum(l_extendedprice * (1.0 - l_discount)) AS cost,
          sum(l_quantity) AS quantity, count(*) AS n_lines, max(CAST(l_returnflag = 'R' AS INTEGER)) AS has_return
        FROM lineitem GROUP BY l_orderkey)
  JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey),
s AS (SELECT *, row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR))) <= ceil(count(*) OVER () * 0.2) AS valid
  FROM j)"""


def ols_sql(y: str, ridge: str = "0") -> str:
    """Least squares of ``y`` on (o_totalprice, quantity) over the train rows; ``ridge`` is added to both variances."""
    return f"""m AS (SELECT avg(o_totalprice) AS m1, avg(quantity) AS m2, avg({y}) AS my, var_pop(o_totalprice) + {ridge} AS s11,
  var_pop(quantity) + {ridge} AS s22, covar_pop(o_totalprice, quantity) AS s12, covar_pop(o_totalprice, {y}) AS s1y,
  covar_pop(quantity, {y}) AS s2y FROM s WHERE NOT valid),
f AS (SELECT *, (s1y * s22 - s2y * s12) / (s11 * s22 - s12 * s12) AS b1, (s2y * s11 - s1y * s12) / (s11 * s22 - s12 * s12) AS b2
  FROM m)"""


PREDICT_SQL = "(my + b1 * (o_totalprice - m1) + b2 * (quantity - m2))"
LINEAR = ["o_totalprice", "quantity"]


def _linear_cfg(model_type="linear", params=None, target="saving", search_cfg=None):
    return {"experiment_name": f"{model_type}_two", "random_state": 42, "val_size": 0.2, "cv_folds": 3,
            "data": {"target_column": target, "feature_columns": LINEAR}, "feature_engineering": {},
            "model": {"type": model_type, "task": "regression", "params": params or {},
                      "hyperparameter_search": search_cfg or {"enabled": False, "cv": 3}}}


FEATURE_NAMES = "o_totalprice,quantity,n_lines,c_acctbal,value_per_unit,o_orderstatus,o_orderpriority,c_mktsegment"
FACTS_SQL = f"""WITH {JOBS_SQL} SELECT fact, value FROM (
  SELECT 'features' AS fact, '{FEATURE_NAMES}' AS value
  UNION ALL SELECT 'valid_rows', CAST(count(*) FILTER (WHERE valid) AS VARCHAR) FROM s
  UNION ALL SELECT 'beats_mean', 'true')"""


def _facts(spark, result, n_valid):
    """Facts of a training run that SQL can confirm."""
    m = result.metrics
    return spark.createDataFrame([("features", ",".join(result.feature_cols)), ("valid_rows", str(n_valid)),
                                  ("beats_mean", str(m["Improvement_percent"] > 0).lower())], "fact string, value string")


def _run_facts(spark, sf, cfg):
    with kept(_jobs(spark, sf)) as jobs:
        _, valid = split_rows(prepare_rows(jobs, "saving"), ID, 0.2, 42)
        return _facts(spark, train.train(spark, jobs, cfg, ID), valid.count())


def _cfg(model_type, params=None, task="regression", target="saving", search_cfg=None, prep=None):
    return {
        "experiment_name": f"{model_type}_{task}", "random_state": 42, "val_size": 0.2, "cv_folds": 3,
        "data": {"target_column": target, "feature_columns": FEATURES,
                 "categorical_features": ["o_orderstatus", "o_orderpriority", "c_mktsegment"]},
        "feature_engineering": {"operations": [
            {"name": "value_per_unit", "operation": "divide", "inputs": ["o_totalprice", "quantity"],
             "output": "value_per_unit"}], "preprocessing": prep or {"missing_strategy": "mean"}},
        "model": {"type": model_type, "task": task, "params": params or {},
                  "hyperparameter_search": search_cfg or {"enabled": False, "cv": 3}},
    }


def _jobs(spark, sf, target="saving"):
    return order_jobs(spark, sf).select(ID, *FEATURES, target)


def _metrics_frame(spark, m: dict):
    return spark.createDataFrame([(k, float(v)) for k, v in m.items()], "metric string, value double")


@q("train_gbt", FACTS_SQL)
def train_gbt(spark, sf):
    return _run_facts(spark, sf, _cfg("catboost", {"iterations": 15, "depth": 4, "learning_rate": 0.1}))


@q("train_forest", FACTS_SQL)
def train_forest(spark, sf):
    return _run_facts(spark, sf, _cfg("randomforest", {"n_estimators": 20, "max_depth": 6}))


@q("train_linear", f"""
WITH {JOBS_SQL}, {ols_sql("saving")},
e AS (SELECT saving, {PREDICT_SQL} AS p FROM s, f WHERE valid)
SELECT metric, round(value, 4) AS value FROM (
  SELECT 'MAE' AS metric, avg(abs(saving - p)) AS value FROM e UNION ALL SELECT 'RMSE', sqrt(avg((saving - p) ** 2)) FROM e
  UNION ALL SELECT 'R2', 1 - sum((saving - p) ** 2) / (var_pop(saving) * count(*)) FROM e
  UNION ALL SELECT 'Residual_mean', avg(saving - p) FROM e)""")
def train_linear(spark, sf):
    """T14 with least squares: every metric against SQL."""
    m = train.train(spark, _jobs(spark, sf), _linear_cfg(), ID).metrics
    return _metrics_frame(spark, {k: round(m[k], 4) for k in ("MAE", "RMSE", "R2", "Residual_mean")})


@q("ridge_coefficients", f"""
WITH {JOBS_SQL}, n AS (SELECT CAST(1000000000000.0 AS DOUBLE) / count(*) AS lam FROM s WHERE NOT valid), {ols_sql("saving", "(SELECT lam FROM n)")}
SELECT 'o_totalprice' AS feature, round(b1, 9) AS coef FROM f UNION ALL SELECT 'quantity', round(b2, 6) FROM f""")
def ridge_coefficients(spark, sf):
    """Ridge by its own alpha, as the normal equations give it."""
    with _prepared(spark, sf, _linear_cfg("ridge", {"alpha": 1e12}), prefix=LINEAR) as (plan, tr, _):
        model = plan.pipeline(learners.create_learner({"type": "ridge", "params": {"alpha": 1e12}})).fit(tr)
    return learners.coefficients(spark, model, LINEAR).withColumn(
        "coef", F.when(F.col("feature") == "quantity", F.round("coef", 6)).otherwise(F.round("coef", 9)))


@contextmanager
def _prepared(spark, sf, cfg, target="saving", prefix=None):
    """Feature plan, train and valid rows; the job table is computed once and held inside the block."""
    rows = prepare_rows(_jobs(spark, sf, target), target).drop(target)
    if prefix:
        rows = rows.select(ID, *prefix, "label")
    plan = plan_features(rows.drop("label"), cfg, id_col=ID)
    with kept(rows) as held:
        tr, va = split_rows(held, ID, 0.2, 42)
        yield plan, tr, va


# One feature: every penalty has a closed form. soft() is the soft threshold.
ONE_SQL = f"""{JOBS_SQL}, soft AS (SELECT avg(quantity) AS mx, avg(saving) AS my, var_pop(quantity) AS sxx, covar_pop(quantity, saving) AS sxy,
  count(*) AS n FROM s WHERE NOT valid)"""
ONE = ["quantity"]


def _one_cfg(model_type, params=None, search_cfg=None):
    cfg = _linear_cfg(model_type, params, search_cfg=search_cfg)
    cfg["data"]["feature_columns"] = ONE
    return cfg


@q("train_linear_family", f"""
WITH {ONE_SQL}, b AS (
  SELECT 'linear' AS model, sxy / sxx AS b FROM soft UNION ALL SELECT 'ridge', sxy / (sxx + 100000.0 / n) FROM soft
  UNION ALL SELECT 'lasso', sign(sxy) * greatest(abs(sxy) - 50.0, 0) / sxx FROM soft
  UNION ALL SELECT 'elasticnet', sign(sxy) * greatest(abs(sxy) - 25.0, 0) / (sxx + 25.0) FROM soft)
SELECT model, round(avg(abs(saving - my - b * (quantity - mx))), 3) AS mae, round(sqrt(avg((saving - my - b * (quantity - mx)) ** 2)), 3) AS rmse
FROM s, soft, b WHERE valid GROUP BY model""")
def train_linear_family(spark, sf):
    """T17 over the linear family, each by its own alpha."""
    ls = {t: learners.create_learner({"type": t, "params": p}) for t, p in [
        ("linear", {}), ("ridge", {"alpha": 100000.0}), ("lasso", {"alpha": 50.0}),
        ("elasticnet", {"alpha": 50.0, "l1_ratio": 0.5})]}
    with _prepared(spark, sf, _one_cfg("linear")) as (plan, tr, va):
        table_ = train.compare_models(spark, tr, va, plan.stages, ls)
    return table_.select("model", F.round("mae", 3).alias("mae"), F.round("rmse", 3).alias("rmse"))


@q("model_comparison", """SELECT * FROM (VALUES ('decisiontree', true, true), ('randomforest', true, true), ('gbt', true, true), ('linear', true, true))
  t(model, explains, mae_below_rmse)""")
def model_comparison(spark, sf):
    """Every learner explains some of the variance and no mean error exceeds the squared one's root."""
    cfg = _cfg("randomforest")
    ls = {"decisiontree": learners.create_learner({"type": "decisiontree", "params": {"max_depth": 5}}),
          "randomforest": learners.create_learner({"type": "randomforest", "params": {"n_estimators": 10}}),
          "gbt": learners.create_learner({"type": "xgboost", "params": {"n_estimators": 10, "max_depth": 3}}),
          "linear": learners.create_learner({"type": "linear"})}
    with _prepared(spark, sf, cfg) as (plan, tr, va):
        table_ = train.compare_models(spark, tr, va, plan.stages, ls)
    return table_.select("model", (F.col("r2") > 0).alias("explains"), (F.col("mae") <= F.col("rmse")).alias("mae_below_rmse"))


def cv_sql(alphas: list[float], score: str, digits: int = 3) -> str:
    """Cross-validated ridge on one feature: folds are ranges of the hash order of the train rows."""
    values = ", ".join(f"({i}, CAST({a!r} AS DOUBLE), '{{''alpha'': {a!r}}}')" for i, a in enumerate(alphas))
    return f"""WITH {JOBS_SQL}, t AS (SELECT quantity AS x, saving AS y, count(*) OVER () AS n,
  row_number() OVER (ORDER BY md5('42:' || CAST(o_orderkey AS VARCHAR))) - 1 AS r FROM s WHERE NOT valid),
g AS (SELECT x, y, CASE WHEN r < (n % 3) * (n // 3 + 1) THEN r // (n // 3 + 1)
                   ELSE (n % 3) + (r - (n % 3) * (n // 3 + 1)) // (n // 3) END AS fold FROM t),
a AS (SELECT * FROM (VALUES {values}) v(candidate, alpha, params)),
fit AS (SELECT f.fold, candidate, params, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) / (var_pop(x) + alpha / count(*)) AS b
        FROM g JOIN (SELECT DISTINCT fold FROM g) f ON g.fold <> f.fold, a GROUP BY f.fold, candidate, alpha, params),
e AS (SELECT fold, candidate, params, {score} AS v FROM g JOIN fit USING (fold) GROUP BY fold, candidate, params)
SELECT CAST(candidate AS INTEGER) AS candidate, round(avg(v), {digits}) AS metric, round(stddev_pop(v), {digits}) AS metric_std, params
FROM e GROUP BY candidate, params"""


RMSE_SQL, MAE_SQL = "sqrt(avg((y - my - b * (x - mx)) ** 2))", "avg(abs(y - my - b * (x - mx)))"


def _cv_rows(result):
    return result.cv.select("candidate", F.round("metric", 3).alias("metric"), F.round("metric_std", 3).alias("metric_std"), "params")


@q("cv_linear", cv_sql([0.0], RMSE_SQL).replace("{'alpha': 0.0}", "{}").replace("{''alpha'': 0.0}", "{}"))
def cv_linear(spark, sf):
    """cross_validate of the linear learner, mean and deviation over the folds."""
    return _cv_rows(train.train(spark, _jobs(spark, sf), _one_cfg("linear"), ID))


@q("grid_search", cv_sql([0.0, 100000.0, 10000000.0], RMSE_SQL))
def grid_search(spark, sf):
    """Every alpha of the grid, cross-validated."""
    cfg = _one_cfg("ridge", search_cfg={
        "enabled": True, "method": "grid_search", "cv": 3, "scoring": "neg_root_mean_squared_error",
        "param_distributions": {"alpha": [0.0, 100000.0, 10000000.0]}})
    return _cv_rows(train.train(spark, _jobs(spark, sf), cfg, ID))


@q("random_search", cv_sql([0.0, 1000.0], MAE_SQL))
def random_search(spark, sf):
    """The two draws of seed 42 out of four alphas (places 0 and 3 of the list below)."""
    cfg = _one_cfg("ridge", search_cfg={
        "enabled": True, "method": "randomized_search", "n_iter": 2, "cv": 3, "scoring": "neg_mean_absolute_error",
        "param_distributions": {"alpha": [0.0, 100000.0, 10000000.0, 1000.0]}})
    return _cv_rows(train.train(spark, _jobs(spark, sf), cfg, ID))


@q("adaptive_search", "SELECT 12 AS trials, 12 AS distinct_trials, true AS later_no_worse, true AS in_space")
def adaptive_search(spark, sf):
    """Distinct trials inside typed dimensions; the best of all is no worse than the best of the random start."""
    cfg = _one_cfg("decisiontree")
    learner = learners.create_learner(cfg["model"])
    with _prepared(spark, sf, cfg) as (plan, tr, _):
        folded = search.assign_folds(tr, ID, 3)
        _, trials = search.adaptive_search(plan.pipeline(learner), learner,
                                           {"max_depth": {"low": 2, "high": 8}, "min_samples_leaf": [1, 5, 20]},
                                           folded, search.evaluator_for("neg_root_mean_squared_error"), n_trials=12, n_startup=4)
    depth = F.regexp_extract("params", r"'max_depth': (\d+)", 1).cast("int")
    return trials.agg(F.count("*").cast("int").alias("trials"), F.count_distinct("params").cast("int").alias("distinct_trials"),
                      (F.min("metric") <= F.min(F.when(F.col("trial") < 4, F.col("metric")))).alias("later_no_worse"),
                      F.every(depth.between(2, 8)).alias("in_space"))


@q("feature_importance", f"""
SELECT unnest(string_split('{FEATURE_NAMES}', ',')) AS feature, true AS in_range, true AS sums_to_one""")
def feature_importance(spark, sf):
    """One importance in [0, 1] for each configured feature, adding up to 1."""
    cfg = _cfg("randomforest", {"n_estimators": 15, "max_depth": 6})
    imp = train.train(spark, _jobs(spark, sf), cfg, ID).importance
    total = imp.agg(F.sum("importance")).first()[0]
    return imp.select("feature", F.col("importance").between(0, 1).alias("in_range"), F.lit(abs(total - 1) < 1e-6).alias("sums_to_one"))


ALPHAS = [0.01, 10.0, 100.0, 1000.0]
PATH_SQL = f"""WITH {ONE_SQL}, p AS (SELECT alpha, sign(sxy) * greatest(abs(sxy) - alpha, 0) / sxx AS coef FROM soft,
  (SELECT unnest({ALPHAS}) AS alpha))"""


def _lasso_path(spark, sf):
    with _prepared(spark, sf, _one_cfg("lasso")) as (plan, tr, _):
        return train.coefficient_path(spark, tr, plan.stages, plan.feature_cols, ALPHAS)


@q("coef_path", f"{PATH_SQL} SELECT CAST(alpha AS DOUBLE) AS alpha, 'quantity' AS feature, round(coef, 4) AS coef FROM p")
def coef_path(spark, sf):
    """The lasso path of one feature."""
    return _lasso_path(spark, sf).withColumn("coef", F.round("coef", 4))


@q("coef_stats", f"""{PATH_SQL} SELECT CAST(alpha AS DOUBLE) AS alpha, CAST(abs(coef) > 1e-10 AS BIGINT) AS n_nonzero, round(abs(coef), 4) AS max_abs FROM p""")
def coef_stats_q(spark, sf):
    """G23 per regularisation strength."""
    path = _lasso_path(spark, sf)
    out = None
    for a in ALPHAS:
        one = profile.coef_stats(path.where(F.col("alpha") == a), "coef").select(
            F.lit(a).alias("alpha"), F.col("n_nonzero").cast("long").alias("n_nonzero"), F.round("max_abs", 4).alias("max_abs"))
        out = one if out is None else out.union(one)
    return out


def _model_dir(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


@q("score_batch", f"""
WITH {JOBS_SQL}, {ols_sql("saving")}
SELECT o_orderkey, o_totalprice, quantity, n_lines, c_acctbal, o_orderstatus, o_orderpriority, c_mktsegment,
  round({PREDICT_SQL}, 3) AS "Predicted_saving", 'linear' AS "Model_Type" FROM s, f""")
def score_batch(spark, sf):
    """Fit on the train split, save, load, score every order. All source columns come back as they were."""
    cfg = _linear_cfg()
    path = _model_dir(spark, "model")
    with _prepared(spark, sf, cfg) as (plan, tr, _):
        save_model(plan.pipeline(learners.create_learner(cfg["model"])).fit(tr), path)
    scored = score.score(load_model(path), _jobs(spark, sf).drop("saving"), cfg["data"])
    return scored.drop("Prediction_Timestamp").withColumn("Predicted_saving", F.round("Predicted_saving", 3))


@q("experiment_log", """
SELECT * FROM (VALUES ('exp1', 'Baseline_MAE,CV_RMSE_mean,CV_RMSE_std,CV_neg_root_mean_squared_error,Improvement_percent,MAE,R2,RMSE,Residual_mean,Residual_std', 1),
                      ('exp2', 'Baseline_MAE,CV_RMSE_mean,CV_RMSE_std,CV_neg_root_mean_squared_error,Improvement_percent,MAE,R2,RMSE,Residual_mean,Residual_std', 1))
  t(experiment_name, metric_names, runs)""")
def experiment_log(spark, sf):
    """Two runs logged and read back: names, metrics and one id each."""
    log_dir = _model_dir(spark, "runlog")
    runs = RunLog(log_dir)
    with kept(_jobs(spark, sf)) as jobs:
        for name, mtype in [("exp1", "linear"), ("exp2", "decisiontree")]:
            cfg = _cfg(mtype)
            cfg["experiment_name"] = name
            res = train.train(spark, jobs, cfg, ID)
            runs.append(spark, name, res.metrics, learners.model_params(res.model))
    names = F.array_join(F.array_sort(F.map_keys("metrics")), ",")
    return runs.read(spark).groupBy("experiment_name").agg(F.max(names).alias("metric_names"), F.count_distinct("run_id").cast("int").alias("runs"))


@q("training_history", "SELECT CAST(i AS INTEGER) AS iter, 'squared' AS metric, true AS no_worse FROM range(1, 13) r(i)")
def training_history(spark, sf):
    """The loss on the training rows falls (or stays) with every boosting round."""
    cfg = _cfg("lightgbm", {"n_estimators": 12, "max_depth": 4})
    with _prepared(spark, sf, cfg) as (plan, tr, _):
        model = plan.pipeline(learners.create_learner(cfg["model"])).fit(tr)
        losses = learners.training_history(model, PipelineModel(model.stages[:-1]).transform(tr), "squared")
    return spark.createDataFrame([(i + 1, "squared", i == 0 or v <= losses[i - 1] * (1 + 1e-9)) for i, v in enumerate(losses)],
                                 "iter int, metric string, no_worse boolean")


@q("classify_logistic", f"""WITH {JOBS_SQL} SELECT CAST(has_return AS DOUBLE) AS class, count(*) AS support, true AS in_range
FROM s WHERE valid GROUP BY has_return""")
def classify_logistic(spark, sf):
    """T20 + G15: balanced class weights for a rare label (order has a return): the report's classes, supports and ranges."""
    cfg = _cfg("logistic", {"max_iter": 50}, task="classification", target="has_return",
               prep={"missing_strategy": "mean", "scale_features": True})
    learner = learners.create_learner(cfg["model"]).setWeightCol("weight")
    with _prepared(spark, sf, cfg, "has_return") as (plan, tr, va):
        model = plan.pipeline(learner).fit(metrics.with_class_weights(tr, "label", "weight"))
    report = metrics.classification_report(model.transform(va), "label", "prediction")
    return report.withColumn("class", F.col("class").try_cast("double")).where("class is not null").select("class", F.col("support").cast("long").alias("support"),
                         (F.col("precision").between(0, 1) & F.col("recall").between(0, 1)).alias("in_range"))


@q("stream_score", """
WITH f AS (SELECT regr_slope(o_custkey, o_totalprice) AS b, regr_intercept(o_custkey, o_totalprice) AS a FROM orders)
SELECT o_orderkey, round(a + b * o_totalprice, 3) AS "Predicted_Value" FROM orders, f""")
def stream_score(spark, sf):
    """A fitted model on a stream: the table's files as they land, a file sink with a checkpoint in the shared folder."""
    from ..streaming.scoring import run_to_files, stream_table_scores
    orders = table(spark, sf, "orders")
    cfg = {"data": {"target_column": "o_custkey", "feature_columns": ["o_totalprice"]}, "feature_engineering": {},
           "model": {"type": "linear"}}
    rows = prepare_rows(orders.select(ID, "o_totalprice", "o_custkey"), "o_custkey").drop("o_custkey")
    plan = plan_features(rows.drop("label"), cfg, id_col=ID)
    model = plan.pipeline(learners.create_learner(cfg["model"])).fit(rows)
    scored = stream_table_scores(spark, model, f"{sf}/orders.parquet", orders.schema, [ID])
    return run_to_files(scored, _model_dir(spark, "stream-out"), _model_dir(spark, "stream-ckpt")).withColumn(
        "Predicted_Value", F.round("Predicted_Value", 3))

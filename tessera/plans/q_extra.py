"""Registered queries: folds, CV summary, grouped imputation, and the
remaining training flows (experiment from a file, transformed target, tree
stats, engineered table, transformer-parameter search, MLP regressor)."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from ..functions import ops
from ..operators import metrics, prep, split, target
from ..session import kept
from ..sources.sinks import RunLog, load_model
from . import learners, score, train
from .features import plan_features, prepare_rows, route_columns, split_rows
from .q_train import FEATURE_NAMES, ID, JOBS_SQL, PREDICT_SQL, _cfg, _jobs, _linear_cfg, _model_dir, ols_sql
from .search import assign_folds, cross_validate, evaluator_for
from .tables import table

Q, O = {}, {}


def q(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            O[name] = sql
        return fn
    return deco


_MD5 = "md5('42:' || CAST({id} AS VARCHAR))"


@q("stratified_folds", f"""
SELECT fold, o_orderstatus, count(*) AS n FROM (
  SELECT o_orderstatus, CAST((row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_MD5.format(id='o_orderkey')}) - 1)
    % 5 AS INTEGER) AS fold FROM orders) GROUP BY fold, o_orderstatus""")
def stratified_folds_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    f = split.stratified_folds(o, "o_orderkey", "o_orderstatus", 5)
    return f.groupBy("fold", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@q("contiguous_folds", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS r, count(*) OVER () AS n FROM orders),
f AS (SELECT o_orderkey, CASE WHEN r < (n % 5) * (n // 5 + 1) THEN r // (n // 5 + 1)
                              ELSE (n % 5) + (r - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM r)
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM f GROUP BY fold""")
def contiguous_folds_q(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    f = split.contiguous_folds(o, "o_orderkey", 5)
    return f.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"),
                                 F.max("o_orderkey").alias("last_key"))


@q("cv_scores", f"""
WITH f AS (SELECT p_type, p_size, CAST((row_number() OVER (ORDER BY {_MD5.format(id='p_partkey')}) - 1) % 5 AS INTEGER)
             AS fold FROM part),
ft AS (SELECT fold, p_type, sum(p_size) AS s, count(*) AS c FROM f GROUP BY fold, p_type),
t AS (SELECT p_type, sum(s) AS s, sum(c) AS c FROM ft GROUP BY p_type),
m AS (SELECT ft.fold, ft.p_type, (t.s - ft.s) / (t.c - ft.c) AS pred FROM ft JOIN t USING (p_type)),
sc AS (SELECT f.fold, sqrt(avg((p_size - pred) * (p_size - pred))) AS rmse FROM f JOIN m USING (fold, p_type)
       GROUP BY f.fold)
SELECT round(avg(rmse), 9) AS mean, round(stddev_pop(rmse), 9) AS std, count(*) AS folds,
  round(avg(rmse) - 2 * stddev_pop(rmse), 9) AS low, round(avg(rmse) + 2 * stddev_pop(rmse), 9) AS high FROM sc""")
def cv_scores(spark, sf):
    """G19 with T2 folds: out-of-fold group means (totals minus the fold),
    per-fold RMSE, then mean, population std and mean +- 2 std."""
    part = table(spark, sf, "part").select("p_partkey", "p_type", "p_size")
    f = split.kfold(part, "p_partkey", 5)
    ft = f.groupBy("fold", "p_type").agg(F.sum("p_size").alias("s"), F.count(F.lit(1)).alias("c"))
    tot = ft.groupBy("p_type").agg(F.sum("s").alias("ts"), F.sum("c").alias("tc"))
    oof = ft.join(tot, "p_type").select("fold", "p_type",
                                         ((F.col("ts") - F.col("s")) / (F.col("tc") - F.col("c"))).alias("pred"))
    scored = f.join(oof, ["fold", "p_type"])
    per_fold = scored.groupBy("fold").agg(F.sqrt(F.avg((F.col("p_size") - F.col("pred")) ** 2)).alias("score"))
    s = metrics.cv_summary(per_fold, "score")
    return s.select(*[F.round(c, 9).alias(c) if c != "folds" else F.col(c) for c in ["mean", "std", "folds", "low", "high"]])


@q("impute_by_kind", """
WITH d AS (SELECT nullif(l_discount, 0) AS discount, CASE WHEN l_linestatus = 'O' THEN NULL
              ELSE CAST(l_returnflag = 'R' AS INTEGER) END AS is_returned, nullif(l_returnflag, 'N') AS returnflag
           FROM lineitem)
SELECT coalesce(returnflag, 'missing') AS returnflag, coalesce(is_returned, 0) AS is_returned,
  round(sum(coalesce(discount, (SELECT median(discount) FROM d))), 6) AS discount_sum, count(*) AS n
FROM d GROUP BY 1, 2""")
def impute_by_kind_q(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.when(F.col("l_linestatus") == "O", F.lit(None).cast("int"))
        .otherwise((F.col("l_returnflag") == "R").cast("int")).alias("is_returned"),
        F.nullif("l_returnflag", F.lit("N")).alias("returnflag"))
    kinds = prep.column_kinds(li)
    out = prep.impute_by_kind(li, kinds["numeric"], kinds["flag"], kinds["text"])
    return out.groupBy("returnflag", "is_returned").agg(F.round(F.sum("discount"), 6).alias("discount_sum"),
                                                        F.count(F.lit(1)).alias("n"))


# --- rows-only training flows ---------------------------------------------------

@q("run_experiment", """
SELECT 'features' AS fact, 'p_size,p_brand,p_type' AS value
UNION ALL SELECT 'runs_logged', '1' UNION ALL SELECT 'scored_rows', CAST(count(*) AS VARCHAR) FROM part""")
def run_experiment_q(spark, sf):
    """T15 from a config naming a file (the part table), with its run log and model paths."""
    cfg = {"experiment_name": "part_price", "random_state": 42, "val_size": 0.2, "cv_folds": 3,
           "data": {"file_path": f"{sf}/part.parquet", "file_type": "parquet",
                    "columns_needed": ["p_partkey", "p_size", "p_brand", "p_type", "p_retailprice"],
                    "target_column": "p_retailprice", "categorical_features": ["p_brand", "p_type"]},
           "feature_engineering": {"preprocessing": {"missing_strategy": "median"}},
           "model": {"type": "lightgbm", "task": "regression", "params": {"n_estimators": 10, "max_depth": 4}}}
    cfg |= {"track_path": _model_dir(spark, "runs"), "save_path": _model_dir(spark, "model")}
    result = train.run_experiment(spark, cfg, "p_partkey")
    scored = score.score(load_model(cfg["save_path"]), table(spark, sf, "part").drop("p_retailprice"), cfg["data"])
    facts = [("features", ",".join(result.feature_cols)), ("runs_logged", str(RunLog(cfg["track_path"]).read(spark).count())),
             ("scored_rows", str(scored.where("Predicted_p_retailprice is not null").count()))]
    return spark.createDataFrame(facts, "fact string, value string")


@q("train_symlog_target", f"""
WITH {JOBS_SQL}, {ols_sql("sign(saving) * ln(1 + abs(saving))")},
e AS (SELECT saving AS y, {PREDICT_SQL} AS z FROM s, f WHERE valid), p AS (SELECT y, sign(z) * (exp(abs(z)) - 1) AS p FROM e)
SELECT round(avg(abs(y - p)), 3) AS mae, round(sqrt(avg((y - p) ** 2)), 3) AS rmse FROM p""")
def train_symlog_target(spark, sf):
    """Fit on symlog(target), invert predictions with symexp, score on the
    original scale."""
    cfg = _linear_cfg()
    rows = prepare_rows(_jobs(spark, sf), "saving").drop("saving")
    plan = plan_features(rows.drop("label"), cfg, id_col=ID)
    with kept(rows) as held:
        tr, va = split_rows(held, ID, 0.2, 42)
        model = plan.pipeline(learners.create_learner(cfg["model"])).fit(tr.withColumn("label", ops.symlog("label")))
    scored = model.transform(va).withColumn("prediction", ops.symexp("prediction"))
    return metrics.regression_metrics(scored, "label", "prediction").select(F.round("mae", 3).alias("mae"), F.round("rmse", 3).alias("rmse"))


@q("tree_stats", "SELECT 6 AS depth, true AS binary_tree, true AS leaves_fit")
def tree_stats_q(spark, sf):
    """A tree grown to its full depth has one leaf more than inner nodes, 2 ** depth at most."""
    cfg = _cfg("decisiontree", {"max_depth": 6})
    res = train.train(spark, _jobs(spark, sf), cfg, ID)
    st = learners.tree_stats(res.model)
    inner = st["nodes"] - st["leaves"]
    return spark.createDataFrame([(st["depth"], st["leaves"] == inner + 1, 6 < st["leaves"] <= 64)],
                                 "depth int, binary_tree boolean, leaves_fit boolean")


@q("engineered_table", f"""
WITH {JOBS_SQL}, d AS (SELECT o_orderkey, o_totalprice, CAST(quantity AS DOUBLE) AS quantity, CAST(n_lines AS DOUBLE) AS n_lines,
  coalesce(c_acctbal, (SELECT avg(c_acctbal) FROM j)) AS c_acctbal, CASE WHEN quantity = 0 THEN 0 ELSE o_totalprice / quantity END AS value_per_unit,
  CAST(dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS DOUBLE) AS o_orderstatus,
  CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS o_orderpriority,
  CAST(dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS DOUBLE) AS c_mktsegment, saving AS label FROM j),
k AS (SELECT {", ".join(f"median({c}) AS m_{c}, CASE WHEN quantile_cont({c}, 0.75) = quantile_cont({c}, 0.25) THEN 1 ELSE quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) END AS w_{c}" for c in FEATURE_NAMES.split(","))} FROM d)
SELECT o_orderkey, {", ".join(f"round(({c} - m_{c}) / w_{c}, 6) AS {c}" for c in FEATURE_NAMES.split(","))}, round(label, 6) AS label FROM d, k""")
def engineered_table(spark, sf):
    """Fit the preprocessing stages without a learner; view the table."""
    cfg = _cfg("lightgbm", prep={"missing_strategy": "mean", "scale_features": True, "scaling_method": "robust"})
    rows = prepare_rows(_jobs(spark, sf), "saving").drop("saving")
    plan = plan_features(rows.drop("label"), cfg, id_col=ID)
    model = Pipeline(stages=plan.stages[:-1]).fit(rows)
    copy = prep.FeatureCopies.SUFFIX
    return model.transform(rows).select(ID, *[F.round(c + copy, 6).alias(c) for c in plan.feature_cols], F.round("label", 6).alias("label"))


@q("search_transformer_params", """SELECT * FROM (VALUES (0, '{''smoothing'': 0.0, ''maxDepth'': 3}', true), (1, '{''smoothing'': 0.0, ''maxDepth'': 5}', true),
  (2, '{''smoothing'': 10.0, ''maxDepth'': 3}', true), (3, '{''smoothing'': 10.0, ''maxDepth'': 5}', true)) t(candidate, params, positive)""")
def search_transformer_params(spark, sf):
    """The grid spans a transformer Param (tier smoothing) and a learner Param."""
    jobs = _jobs(spark, sf)
    rows = prepare_rows(jobs, "saving").drop("saving")
    tiers = target.TargetTierGrouper(["c_mktsegment"], "label")
    cfg = _cfg("decisiontree")
    cfg["data"]["feature_columns"] = [c for c in cfg["data"]["feature_columns"] if c != "c_mktsegment"]
    base = plan_features(rows.drop("label", "c_mktsegment"), cfg, id_col=ID)
    learner = learners.create_learner({"type": "decisiontree"})
    pipe = Pipeline(stages=[prep.CategoricalBaseline(["c_mktsegment"]), tiers,
                            prep.LabelEncoder(["c_mktsegment_Tier"])] + base.stages[:-1] + [
        VectorAssembler(inputCols=base.stages[-1].getInputCols() + ["c_mktsegment_Tier"], outputCol="features",
                        handleInvalid="keep"),
        learner])
    grid = (ParamGridBuilder().addGrid(tiers.smoothing, [0.0, 10.0]).addGrid(learner.maxDepth, [3, 5]).build())
    with kept(rows) as held:
        tr, _ = split_rows(held, ID, 0.2, 42)
        folded = assign_folds(tr, ID, 3)
        _, table_ = cross_validate(pipe, grid, folded, evaluator_for("neg_root_mean_squared_error"), 2, 3)
    return table_.select("candidate", "params", (F.col("metric") > 0).alias("positive"))


@q("mlp_regressor", "SELECT true AS loss_falls, true AS explains, true AS mae_below_rmse")
def mlp_regressor(spark, sf):
    """MLP regression as a distributed gradient job (scaled inputs)."""
    cfg = _cfg("mlp", {"hidden_layer_sizes": [16], "max_iter": 60, "learning_rate_init": 0.05},
               prep={"missing_strategy": "mean", "scale_features": True})
    rows = prepare_rows(_jobs(spark, sf), "saving").withColumn("label", F.col("label") / 1000.0).drop("saving")
    plan = plan_features(rows.drop("label"), cfg, id_col=ID)
    with kept(rows) as held:
        tr, va = split_rows(held, ID, 0.2, 42)
        model = plan.pipeline(learners.create_learner(cfg["model"])).fit(tr)
        m = metrics.regression_metrics(model.transform(va), "label", "prediction").first()
    history = model.stages[-1].history
    return spark.createDataFrame([(history[-1] < history[0], m["r2"] > 0, m["mae"] <= m["rmse"])],
                                 "loss_falls boolean, explains boolean, mae_below_rmse boolean")


@q("score_probability", f"WITH {JOBS_SQL} SELECT o_orderkey, true AS in_range, true AS agrees FROM j")
def score_probability(spark, sf):
    """T16 + T26: a classifier scored in batch with the positive-class
    probability stamped next to the prediction; the two agree."""
    cfg = _cfg("randomforest", {"n_estimators": 10, "max_depth": 5}, task="classification", target="has_return")
    rows = prepare_rows(_jobs(spark, sf, "has_return"), "has_return").drop("has_return")
    plan = plan_features(rows.drop("label"), cfg, id_col=ID)
    with kept(rows) as held:
        tr, _ = split_rows(held, ID, 0.2, 42)
        model = plan.pipeline(learners.create_learner(cfg["model"])).fit(tr)
    scored = score.score(model, _jobs(spark, sf, "has_return").drop("has_return"), keep=[ID], with_probability=True)
    p = F.col("Probability")
    return scored.select(ID, p.between(0, 1).alias("in_range"), ((p > 0.5).cast("double") == F.col("Predicted_Value")).alias("agrees"))


@q("encode_on_batch", """
SELECT o_orderkey, dense_rank() OVER (ORDER BY coalesce(o_orderpriority, 'Unknown')) - 1 AS o_orderpriority FROM orders""")
def encode_on_batch_q(spark, sf):
    """E5: codes fitted on the scored batch itself."""
    return score.encode_on_batch(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), ["o_orderpriority"])


SUMMARY_SQL = f"""
WITH {JOBS_SQL}, {ols_sql("saving")}, p AS (SELECT {PREDICT_SQL} AS p FROM s, f)
SELECT round(min(p), 3) AS min, round(max(p), 3) AS max, round(avg(p), 3) AS mean, round(stddev_pop(p), 3) AS std FROM p"""


@q("prediction_summary", SUMMARY_SQL)
@q("predicted_value_summary", SUMMARY_SQL)
def prediction_summary(spark, sf):
    """G1 of the predictions: fit on the train split, score every order, summarise. Both names stand for this job."""
    cfg = _linear_cfg()
    with kept(_jobs(spark, sf)) as jobs:
        rows = prepare_rows(jobs, "saving").drop("saving")
        plan = plan_features(rows.drop("label"), cfg, id_col=ID)
        tr, _ = split_rows(rows, ID, 0.2, 42)
        model = plan.pipeline(learners.create_learner(cfg["model"])).fit(tr)
        scored = score.score(model, jobs.drop("saving"), cfg["data"])
        row = score.prediction_summary_row(scored, "Predicted_saving")
    return spark.createDataFrame([tuple(round(row[k], 3) for k in ("min", "max", "mean", "std"))], "min double, max double, mean double, std double")


@q("route_columns", """
SELECT o_orderkey, round((o_totalprice - avg(o_totalprice) OVER ()) / stddev_pop(o_totalprice) OVER (), 9) AS price,
  CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS DOUBLE) AS priority, CAST(o_custkey AS DOUBLE) AS rest FROM orders""")
def route_columns_q(spark, sf):
    """SC5: scaled numbers, coded text and untouched columns in one vector."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority", F.col("o_custkey").cast("double").alias("o_custkey"))
    routed = route_columns({"numbers": ([prep.Scaler(["o_totalprice"])], ["o_totalprice"]),
                            "text": ([prep.LabelEncoder(["o_orderpriority"])], ["o_orderpriority"])}, remainder=["o_custkey"])
    v = vector_to_array("features")
    return routed.fit(orders).transform(orders).select("o_orderkey", F.round(v[0], 9).alias("price"), v[1].alias("priority"), v[2].alias("rest"))


@q("top_predictions", f"""
WITH {JOBS_SQL}, {ols_sql("saving")}
SELECT o_orderkey, round({PREDICT_SQL}, 3) AS "Predicted_saving" FROM s, f ORDER BY {PREDICT_SQL} DESC, o_orderkey LIMIT 10""")
def top_predictions(spark, sf):
    """O3: the ten largest predictions (a top-k report)."""
    cfg = _linear_cfg()
    rows = prepare_rows(_jobs(spark, sf), "saving").drop("saving")
    plan = plan_features(rows.drop("label"), cfg, id_col=ID)
    with kept(rows) as held:
        tr, _ = split_rows(held, ID, 0.2, 42)
        model = plan.pipeline(learners.create_learner(cfg["model"])).fit(tr)
    scored = score.score(model, _jobs(spark, sf).drop("saving"), cfg["data"], keep=[ID])
    top = scored.orderBy(F.desc("Predicted_saving"), ID).limit(10)
    return top.select(ID, F.round("Predicted_saving", 3).alias("Predicted_saving"))

import os
import random

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import metrics
from tessera.plans import learners, search
from tessera.plans.mlp import MLPRegressor
from tessera.sources.sinks import RunLog
from tessera.streaming.scoring import run_to_table, stream_scores


def _linear(spark, n=400):
    rng = random.Random(5)
    rows = [(i, rng.uniform(-1, 1), rng.uniform(-1, 1)) for i in range(n)]
    return spark.createDataFrame([(i, a, b, 3 * a - 2 * b + 0.5) for i, a, b in rows], "id int, a double, b double, label double")


def test_mlp_regressor_learns_linear_map(spark):
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(_linear(spark))
    model = MLPRegressor(hidden=(8,), learningRate=0.05, maxIter=150).fit(df)
    r = metrics.regression_metrics(model.transform(df), "label", "prediction").first()
    assert r.r2 > 0.95 and model.history[-1] < model.history[0]


def test_grid_and_random_draws(spark):
    learner = learners.create_learner({"type": "randomforest"})
    space = {"n_estimators": [5, 10, 20], "max_depth": [3, 5], "not_a_param": [1]}
    with pytest.raises(ValueError, match="not_a_param"):  # never a smaller search than was asked for
        search.grid(learner, space)
    ignore = ("not_a_param",)
    assert len(search.grid(learner, space, ignore)) == 6
    draws = search.random_draws(learner, space, 4, seed=1, ignore=ignore)
    assert len(draws) == 4 and len({str(sorted((p.name, v) for p, v in d.items())) for d in draws}) == 4
    assert search.random_draws(learner, space, 4, seed=1, ignore=ignore) == draws


def test_cross_validate_and_adaptive(spark):
    df = _linear(spark, 200)
    stages = [VectorAssembler(inputCols=["a", "b"], outputCol="features")]
    learner = learners.create_learner({"type": "decisiontree"})
    folded = search.assign_folds(df, "id", 3)
    ev = search.evaluator_for("neg_root_mean_squared_error")
    best, table = search.cross_validate(Pipeline(stages=stages + [learner]),
                                        search.grid(learner, {"max_depth": [1, 4]}), folded, ev, 2, 3)
    rows = table.orderBy("candidate").collect()
    assert len(rows) == 2 and rows[1].metric < rows[0].metric  # deeper tree fits better
    _, trials = search.adaptive_search(Pipeline(stages=stages + [learner]), learner, {"max_depth": [1, 2, 3, 4]},
                                       folded, ev, n_trials=3, n_startup=1)
    assert trials.count() == 3


def test_adaptive_search_uses_up_the_space(spark, monkeypatch):
    """Candidates that no single step from the best reaches are tried too."""
    score = {}

    def scored(pipeline, maps, *rest, **named):
        values = tuple(sorted((p.name, v) for p, v in maps[0].items()))
        score[values] = 1.0 if len(score) == 0 else 100.0 + len(score)  # the first trial stays the best
        return None, spark.createDataFrame([(0, score[values])], "candidate int, metric double")

    monkeypatch.setattr(search, "cross_validate", scored)
    monkeypatch.setattr(search.FoldMemo, "fit", lambda memo, fold, params: None)
    learner = learners.create_learner({"type": "decisiontree"})
    folded = spark.createDataFrame([(0,), (1,)], "fold int")
    space = {"max_depth": [1, 2], "min_samples_leaf": [1, 5], "minInfoGain": [0.0, 0.1]}
    ev = search.evaluator_for("neg_root_mean_squared_error")
    for asked, done in ((8, 8), (20, 8)):
        score.clear()
        _, trials = search.adaptive_search(Pipeline(stages=[learner]), learner, space, folded, ev, n_trials=asked, n_startup=1)
        assert trials.count() == done == len(score)


def test_run_log_skips_corrupt_line(spark, tmp_dir):
    log = RunLog(tmp_dir + "/log")
    log.append(spark, "exp1", {"MAE": 1.0})
    with open(os.path.join(tmp_dir, "log", "part-corrupt.json"), "w") as fh:
        fh.write("{not json\n")
    assert [r.experiment_name for r in log.read(spark).collect()] == ["exp1"]


def test_stream_scoring_matches_batch(spark, tmp_dir):
    df = _linear(spark, 100)
    src = tmp_dir + "/in"
    df.drop("label").repartition(3).write.parquet(src)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                             learners.create_learner({"type": "linear"})]).fit(df)
    scored = stream_scores(spark, model, src, df.drop("label").schema, ["id"])
    run_to_table(scored, "stream_test_out", tmp_dir + "/ckpt")
    got = {r.id: r.Predicted_Value for r in spark.table("stream_test_out").collect()}
    want = {r.id: r.prediction for r in model.transform(df).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert F is not None


def test_batch_scorer_accepts_a_stream(spark, tmp_dir):
    """T16 on a readStream frame: the same score() call, stamps included."""
    from tessera.plans import score
    df = _linear(spark, 60)
    src = tmp_dir + "/in2"
    df.drop("label").write.parquet(src)
    model = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                             learners.create_learner({"type": "linear"})]).fit(df)
    stream = spark.readStream.schema(df.drop("label").schema).parquet(src)
    scored = score.score(model, stream, keep=["id"])
    assert scored.isStreaming
    run_to_table(scored, "stream_score_fn", tmp_dir + "/ckpt2")
    rows = spark.table("stream_score_fn").collect()
    assert len(rows) == 60 and {r.Model_Type for r in rows} == {"linear"}


def test_shipped_search_spaces_map_to_spark_params(spark):
    gbt = learners.create_learner({"type": "xgboost"})
    maps = search.grid(gbt, {"n_estimators": [300, 400], "learning_rate": [0.05], "max_depth": [3],
                             "min_child_weight": [1, 2], "subsample": [0.8], "colsample_bytree": [0.6, 0.8],
                             "gamma": [0.1], "reg_alpha": [0.1]}, ignore=("reg_alpha",))
    assert len(maps) == 8 and {m[gbt.getParam("minInstancesPerNode")] for m in maps} == {1, 2}
    assert {m[gbt.getParam("featureSubsetStrategy")] for m in maps} == {"0.6", "0.8"}
    mlp = learners.create_learner({"type": "neuralnetwork", "task": "regression"})
    maps = search.grid(mlp, {"hidden_layer_sizes": [[50], [100, 50]], "activation": ["relu", "tanh"],
                             "alpha": [0.001], "learning_rate_init": [0.01], "batch_size": [32]}, ignore=("batch_size",))
    assert len(maps) == 4 and {tuple(m[mlp.getParam("hidden")]) for m in maps} == {(50,), (100, 50)}

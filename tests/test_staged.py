"""Boosting in rounds with test rows."""

import math

import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.plans import learners, staged, train


def vector():
    return [VectorAssembler(inputCols=["x"], outputCol="features")]


def booster(rounds=6, kind="xgboost", task="regression", **more):
    return learners.create_learner({"type": kind, "task": task, "params": {"n_estimators": rounds, "max_depth": 2, "learning_rate": 0.5, **more}})


def rows(spark, shift=0.0, n=200):
    return spark.createDataFrame([(float(i % 20), float((i % 20) ** 2 % 37) + shift * (i % 20)) for i in range(n)], "x double, label double").coalesce(1)


def test_history_equals_the_prefixes_of_the_trees(spark):
    model, curve = staged.fit_staged(vector(), booster(), rows(spark), rows(spark, 0.1, 60))
    own = curve.collect()
    trees, weights = model.stages[-1].trees, model.stages[-1].treeWeights
    assert len(own) == 2 * len(trees) and {r.metric for r in own} == {"RMSE", "R2"}
    data = model.transform(rows(spark, 0.1, 60)).select("features", "label").collect()
    mean = sum(r.label for r in data) / len(data)
    spread = sum((r.label - mean) ** 2 for r in data) / len(data)
    for k in range(1, len(trees) + 1):
        mse = sum((r.label - sum(w * t.predict(r.features) for t, w in zip(trees[:k], weights))) ** 2 for r in data) / len(data)
        got = {r.metric: r.test for r in own if r.iter == k}
        assert got["RMSE"] == pytest.approx(math.sqrt(mse)) and got["R2"] == pytest.approx(1 - mse / spread)
    times = [(r.elapsed_ms, r.remaining_ms) for r in own if r.metric == "RMSE"]
    assert times == sorted(times) and times[-1][1] == pytest.approx(0, abs=1e-6)
    assert {round(a + b, 6) for a, b in times} == {round(times[0][0] + times[0][1], 6)}


def test_rounds_stop_when_the_test_error_rises(spark):
    noise = rows(spark).withColumn("label", F.col("label") * -1 + 40)  # what is learned is wrong on these rows
    stopped, curve = staged.fit_staged(vector(), booster(8), rows(spark), noise)
    full, whole = staged.fit_staged(vector(), booster(8), rows(spark), noise, stop=False)
    test = [r.test for r in curve.where("metric = 'RMSE'").orderBy("iter").collect()]
    every = [r.test for r in whole.where("metric = 'RMSE'").orderBy("iter").collect()]
    assert len(every) == 8 and len(test) < 8
    assert test == pytest.approx(every[:len(test)]) and every[len(test)] >= test[-1] == min(test)
    assert stopped.stages[-1].getNumTrees == len(test) and full.stages[-1].getNumTrees == 8


def test_odd_inputs(spark):
    model, curve = staged.fit_staged(vector(), booster(3), rows(spark), rows(spark).limit(0))
    assert curve.count() == 6 and curve.where("test is not null").count() == 0 and model.stages[-1].getNumTrees == 3
    with pytest.raises(ValueError, match="rounds"):
        staged.fit_staged(vector(), learners.create_learner({"type": "ridge"}), rows(spark), rows(spark))
    flags = rows(spark).withColumn("label", (F.col("label") > 15).cast("double"))
    _, own = staged.fit_staged(vector(), booster(3, task="classification"), flags, flags)
    got = own.orderBy("iter").collect()
    assert {r.metric for r in got} == {"Logloss"} and all(0 < r.learn < 0.7 and r.learn == pytest.approx(r.test) for r in got)


def test_training_with_stop_on_test(spark):
    df = spark.createDataFrame([(i, float(i % 20), f"c{i % 7}", float((i % 20) ** 2 + i % 3)) for i in range(200)], "id long, x double, c string, y double")
    cfg = {"data": {"target_column": "y", "feature_columns": ["x", "c"]}, "cv_folds": 2,
           "model": {"type": "catboost", "params": {"iterations": 3, "depth": 2}, "stop_on_test": True}}
    res = train.train(spark, df, cfg, "id")
    last = res.history.where("metric = 'RMSE'").orderBy(F.desc("iter")).first()
    assert last.test == pytest.approx(res.metrics["RMSE"])
    with pytest.raises(ValueError, match="rounds"):
        train.train(spark, df, {**cfg, "model": {"type": "ridge", "stop_on_test": True}}, "id")

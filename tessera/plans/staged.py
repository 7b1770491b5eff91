"""Boosting watched on test rows: the curve of both errors, the times of the rounds, a stop when the test error rises."""

from __future__ import annotations

import math
import time

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.base import fit_learner, fit_stage
from ..operators.classes import learner_stage

HISTORY = "iter int, metric string, learn double, test double, elapsed_ms double, remaining_ms double"


def fit_staged(stages: list, learner, train_df: DataFrame, test_df: DataFrame, stop: bool = True) -> tuple[PipelineModel, DataFrame]:
    """Fit the stages on the training rows, then the booster, and return the model with its history.

    With ``stop`` no round is added once the error on the test rows rises, and the model keeps the rounds up to its
    least; test rows take part in nothing else. Without test rows every round is fitted and ``test`` is null. A
    learner that is no booster raises ``ValueError``.
    """
    if not isinstance(learner, (GBTRegressor, GBTClassifier)):
        raise ValueError(f"{type(learner).__name__} is not fitted in rounds")
    fitted, learn, test = [], train_df, test_df
    for stage in stages:  # target statistics of the training rows are cross-fitted, those of the test rows are not
        own, learn = fit_stage(stage, learn)
        test = own.transform(test)
        fitted.append(own)
    cols = [learner.getFeaturesCol(), learner.getLabelCol()]
    learn, test = learn.select(*cols).persist(), test.select(*cols).persist()
    try:
        tested = not test.isEmpty()
        rows = learn
        if stop and tested:
            learner = learner.copy({learner.validationIndicatorCol: "is_test", learner.validationTol: 0.0})
            rows = learn.withColumn("is_test", F.lit(False)).union(test.withColumn("is_test", F.lit(True)))
        start = time.perf_counter()
        booster = fit_learner(learner, rows)
        seconds = time.perf_counter() - start
        model = PipelineModel(stages=[*fitted, booster])
        return model, history(model, learn, test if tested else None, seconds)
    finally:
        learn.unpersist()
        test.unpersist()


def history(model, learn: DataFrame, test: DataFrame | None, seconds: float) -> DataFrame:
    """``(iter, metric, learn, test, elapsed_ms, remaining_ms)`` of a booster on rows that hold its features and label.

    The errors are those of the model's first ``iter`` trees: ``RMSE`` and ``R2``, or ``Logloss`` of two classes (one
    pass over each side for all rounds). Spark times a fit as a whole; as a round makes one pass over the rows for
    each level of its tree, the measured ``seconds`` are dealt to the rounds by their levels.
    """
    booster = learner_stage(model)
    classes = hasattr(booster, "numClasses")
    sides = [_curves(booster, learn, classes), _curves(booster, test, classes) if test is not None else {}]
    levels = [tree.depth + 1 for tree in booster.trees]
    rows, passed = [], 0
    for k, own in enumerate(levels):
        passed += own
        elapsed = seconds * 1000 * passed / sum(levels)
        rows += [(k + 1, metric, values[k], sides[1][metric][k] if sides[1] else None, elapsed, seconds * 1000 - elapsed)
                 for metric, values in sides[0].items()]
    return learn.sparkSession.createDataFrame(rows, HISTORY)


def _curves(booster, df: DataFrame, classes: bool) -> dict[str, list[float]]:
    if classes:  # Spark's loss is 2 log(1 + exp(-2 y F)) for y of -1 and 1
        return {"Logloss": [v / 2 for v in booster.evaluateEachIteration(df)]}
    mse = list(booster.evaluateEachIteration(df, "squared"))
    spread = df.agg(F.var_pop(booster.getLabelCol())).first()[0]
    return {"RMSE": [math.sqrt(v) for v in mse], "R2": [1 - v / spread if spread else math.nan for v in mse]}

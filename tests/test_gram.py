"""Linear models from sums of products against direct solutions, and the memo of fitted stages."""

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tessera.operators import gram, prep
from tessera.operators.base import CrossFitPipeline
from tessera.plans import learners, search


def data(n=400, d=4, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1, 10, 0.1, 3][:d] + 1e4
    y = x @ np.array([2.0, -0.5, 7.0, 0.0][:d]) + rng.normal(size=n) + 5
    return x, y


def test_moments_merge_to_the_whole():
    x, y = data()
    rows = np.column_stack([x, y])
    whole = gram.Moments.of(rows)
    parts = sum((gram.Moments.of(p) for p in np.array_split(rows, 7)), gram.Moments.none(5))
    assert whole.n == parts.n and np.allclose(whole.mean, parts.mean) and np.allclose(whole.prod, parts.prod, rtol=1e-9, atol=1e-6)


def test_ridge_and_error_from_moments():
    x, y = data()
    m, other = gram.Moments.of(np.column_stack([x[:300], y[:300]])), gram.Moments.of(np.column_stack([x[300:], y[300:]]))
    for alpha in (0.0, 3.0, 1e4):
        xc, yc = x[:300] - x[:300].mean(0), y[:300] - y[:300].mean()
        b = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
        fit = gram.solve(m, "ridge", alpha)
        assert np.allclose(fit.coef, b, rtol=1e-6)
        e = y[300:] - x[300:] @ fit.coef - fit.intercept
        assert np.isclose(gram.score(other, fit, "rmse"), np.sqrt((e ** 2).mean()), rtol=1e-8)
        assert np.isclose(gram.score(other, fit, "r2"), 1 - (e ** 2).sum() / ((y[300:] - y[300:].mean()) ** 2).sum(), rtol=1e-8)


@pytest.mark.parametrize("l1", [1.0, 0.3])
def test_coordinate_descent_meets_its_conditions(l1):
    """At the solution the gradient equals the penalty's slope where a coefficient is not zero and stays under it elsewhere."""
    x, y = data()
    m = gram.Moments.of(np.column_stack([x, y]))
    for alpha in (0.001, 0.1, 5.0, 1e4):
        b = gram.solve(m, "elasticnet", alpha, l1).coef
        slope = (m.prod[:-1, -1] - m.prod[:-1, :-1] @ b) / m.n - alpha * (1 - l1) * b
        assert np.all(np.abs(slope[b == 0]) <= alpha * l1 + 1e-6)
        assert np.allclose(slope[b != 0], alpha * l1 * np.sign(b[b != 0]), atol=1e-6)


def test_singular_columns_have_a_solution():
    x, y = data(d=2)
    m = gram.Moments.of(np.column_stack([x, x[:, :1], np.ones(len(y)), y]))
    assert np.isclose(gram.score(m, gram.solve(m, "linear"), "rmse"),
                      gram.score(gram.Moments.of(np.column_stack([x, y])), gram.solve(gram.Moments.of(np.column_stack([x, y])), "linear"), "rmse"))


def frame(spark):
    x, y = data()
    rows = [(i, *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, d double, label double")


@pytest.mark.parametrize("metric", ["rmse", "mae", "r2"])
@pytest.mark.parametrize("scaled", [False, True])
def test_same_scores_as_fits_by_spark(spark, monkeypatch, metric, scaled):
    folded = search.assign_folds(frame(spark).repartition(5), "id", 3)
    stages = ([prep.Scaler(["a", "b", "c", "d"])] if scaled else []) + [VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features")]
    learner = learners.create_learner({"type": "ridge"})
    maps = search.grid(learner, {"alpha": [0.0, 2.0, 500.0]})
    ev = RegressionEvaluator(metricName=metric)
    _, got = search.cross_validate(CrossFitPipeline(stages=[*stages, learner]), maps, folded, ev)
    monkeypatch.setattr(search, "_gram_scores", lambda *a: None)
    _, want = search.cross_validate(CrossFitPipeline(stages=[*stages, learner]), maps, folded, ev)
    for g, w in zip(got.orderBy("candidate").collect(), want.orderBy("candidate").collect()):
        assert g.params == w.params and g.metric == pytest.approx(w.metric, rel=1e-5) and g.metric_std == pytest.approx(w.metric_std, rel=1e-3)


def test_rows_are_read_once(spark, monkeypatch):
    """Any number of alphas and folds of a linear learner on stages without state takes one pass of products."""
    calls = []
    own = gram.fold_moments
    monkeypatch.setattr(gram, "fold_moments", lambda *a, **k: calls.append(1) or own(*a, **k))
    learner = learners.create_learner({"type": "lasso"})
    pipe = CrossFitPipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"), learner])
    _, table = search.cross_validate(pipe, search.grid(learner, {"alpha": [10.0 ** k for k in range(-4, 4)]}),
                                     search.assign_folds(frame(spark), "id", 5), RegressionEvaluator(metricName="rmse"), refit=False)
    assert table.count() == 8 and len(calls) == 1


def test_memo_refits_only_what_changes(spark):
    df = frame(spark).withColumn("a", F.when(F.col("id") % 5 > 0, F.col("a")))
    folded = search.assign_folds(df, "id", 3)
    imputer, scaler = prep.NumericImputer(["a"]), prep.Scaler(["a", "b"])
    learner = learners.create_learner({"type": "decisiontree", "params": {"max_depth": 2}})
    pipe = CrossFitPipeline(stages=[imputer, scaler, VectorAssembler(inputCols=["a", "b"], outputCol="features"), learner])
    memo = search.FoldMemo(pipe, folded)
    depth = [{learner.maxDepth: d} for d in (1, 2, 3)]
    search.cross_validate(pipe, depth, folded, RegressionEvaluator(metricName="rmse"), k=3, memo=memo, refit=False)
    assert memo.fits == 6  # two stages by three folds, whatever the number of trees
    search.cross_validate(pipe, [{scaler.method: "minmax", **depth[0]}], folded, RegressionEvaluator(metricName="rmse"), k=3, memo=memo, refit=False)
    assert memo.fits == 9  # the scaler again, the imputer not
    search.cross_validate(pipe, [{imputer.strategy: "median", **depth[0]}], folded, RegressionEvaluator(metricName="rmse"), k=3, memo=memo, refit=False)
    assert memo.fits == 15
    best, trials = search.adaptive_search(pipe, learner, {"max_depth": [1, 2, 3, 4]}, folded, RegressionEvaluator(metricName="rmse"), n_trials=4)
    assert trials.count() == 4 and best.stages[-1].depth <= 4

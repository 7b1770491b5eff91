"""Cross-validation and parameter search."""

from __future__ import annotations

import logging
import itertools
import math
import random
import threading
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gram
from ..operators.base import fit_learner, fit_stage
from ..operators.metrics import classification_scores
from ..operators.split import contiguous_folds, cut_folds, hash_folds, kfold, stratified_folds
from .learners import PARAM_MAP, convert_param, linear_kind, rate_scale

log = logging.getLogger(__name__)


class ClassScoreEvaluator(Evaluator):
    """Macro F1 / balanced accuracy (Spark's evaluator has weighted F1)."""

    metric = Param(Params._dummy(), "metric", "macro_f1 or balanced_accuracy", TypeConverters.toString)

    def __init__(self, metric: str = "macro_f1", labelCol: str = "label", predictionCol: str = "prediction"):
        super().__init__()
        self._set(metric=metric)
        self.label_col, self.pred_col = labelCol, predictionCol

    def _evaluate(self, dataset: DataFrame) -> float:
        row = classification_scores(dataset, self.label_col, self.pred_col).first()
        return float(row[self.getOrDefault(self.metric)])

    def isLargerBetter(self) -> bool:
        return True


def evaluator_for(scoring: str, label: str = "label") -> Evaluator:
    """Scoring name -> evaluator; the sign lives in isLargerBetter."""
    s = scoring.lower().replace("neg_", "")
    reg = {"root_mean_squared_error": "rmse", "rmse": "rmse", "mean_absolute_error": "mae", "mae": "mae",
           "mean_squared_error": "mse", "mse": "mse", "r2": "r2"}
    if s in reg:
        return RegressionEvaluator(labelCol=label, metricName=reg[s])
    if s in ("balanced_accuracy", "f1_macro", "macro_f1"):
        return ClassScoreEvaluator("balanced_accuracy" if s == "balanced_accuracy" else "macro_f1", label)
    if s in ("accuracy", "f1"):
        return MulticlassClassificationEvaluator(labelCol=label, metricName=s)
    raise ValueError(f"unknown scoring {scoring}")


# Search-space names of the MLP regressor and its Params.
MLP_PARAM_MAP = {"hidden_layer_sizes": "hidden", "learning_rate_init": "learningRate", "max_iter": "maxIter"}


def _param(learner, name: str):
    """The learner's Param for a reference parameter name: mapped name first,
    then the name itself; None when Spark has no twin."""
    candidates = [PARAM_MAP.get(name, name), MLP_PARAM_MAP.get(name, name), name]
    if type(learner).__name__.startswith("RandomForest") and name == "n_estimators":
        candidates.insert(0, "numTrees")
    if learner.hasParam(name):  # a learner that takes the reference name itself
        return learner.getParam(name)
    for spark_name in candidates:
        if learner.hasParam(spark_name):
            return learner.getParam(spark_name)
    return None


def _value(learner, name: str, param: Param, value):
    """A searched value of a reference parameter as the learner takes it."""
    return value * rate_scale(learner) if name == "learning_rate" and param.name == "stepSize" else convert_param(param.name, value)


def _axes(learner, space: dict, ignore: tuple = ()) -> list[tuple]:
    """(Param, values) of every searched parameter; one without a Spark twin raises unless listed in ``ignore``."""
    axes = []
    for k, values in space.items():
        p = _param(learner, k)
        if p is not None:
            axes.append((p, [_value(learner, k, p, v) for v in values]))
        elif k in ignore:
            log.info("search parameter %s ignored as configured", k)
        else:
            raise ValueError(f"search parameter {k} has no Spark twin; list it under model.ignore_params to search without it")
    return axes


def _combination(axes: list[tuple], index: int) -> dict:
    """The ``index``-th combination of the grid (last parameter fastest), without building the others."""
    out = {}
    for p, values in reversed(axes):
        index, i = divmod(index, len(values))
        out[p] = values[i]
    return dict(reversed(out.items()))


def grid_size(axes: list[tuple]) -> int:
    return math.prod(len(v) for _, v in axes)


def grid(learner, space: dict, ignore: tuple = ()) -> list[dict]:
    """The full grid; keys may use reference names (mapped to Spark)."""
    axes = _axes(learner, space, ignore)
    return [_combination(axes, i) for i in range(grid_size(axes))]


def random_draws(learner, space: dict, n_iter: int, seed: int = 42, ignore: tuple = ()) -> list[dict]:
    """n_iter distinct draws from the grid, seeded (all of it when smaller); only the draws are built."""
    axes = _axes(learner, space, ignore)
    total = grid_size(axes)
    chosen = range(total) if total <= n_iter else random.Random(seed).sample(range(total), n_iter)
    return [_combination(axes, i) for i in chosen]


class Dimension:
    """One searched parameter: a list of choices (None allowed), or ``{"low", "high"}`` with ``"step"`` (integers
    unless the step is fractional) or ``"log": True`` (floats drawn evenly in the logarithm)."""

    def __init__(self, spec):
        self.spec = spec
        self.choices = list(spec) if not isinstance(spec, dict) else spec.get("choices")
        if self.choices is None and not spec.get("log") and (spec.get("step") or isinstance(spec["low"], int)):
            step = spec.get("step", 1)
            self.choices = [spec["low"] + i * step for i in range(int((spec["high"] - spec["low"]) / step + 1e-9) + 1)]

    def draw(self, rng: random.Random):
        if self.choices is not None:
            return rng.choice(self.choices)
        lo, hi = self.spec["low"], self.spec["high"]
        return math.exp(rng.uniform(math.log(lo), math.log(hi))) if self.spec.get("log") else rng.uniform(lo, hi)

    def step(self, value, rng: random.Random):
        """A value near ``value``: the next choice, or up to a tenth of the range away."""
        if self.choices is not None:
            at = self.choices.index(value) + rng.choice([-1, 1])
            return self.choices[min(max(at, 0), len(self.choices) - 1)]
        lo, hi = self.spec["low"], self.spec["high"]
        if self.spec.get("log"):
            return min(max(value * (hi / lo) ** rng.uniform(-0.1, 0.1), lo), hi)
        return min(max(value + (hi - lo) * rng.uniform(-0.1, 0.1), lo), hi)


def assign_folds(df: DataFrame, id_col: str, k: int, mode: str = "shuffle", label: str = "label",
                 seed: int = 42) -> DataFrame:
    """Shuffled (exact cuts of the hash order, rows not moved), ``rank`` (rank mod k), contiguous
    (regressor default), stratified, or ``hash`` folds (expected sizes)."""
    if mode == "rank":
        return kfold(df, id_col, k, seed)
    if mode == "hash":
        return hash_folds(df, id_col, k, seed)
    if mode == "contiguous":
        return contiguous_folds(df, id_col, k)
    if mode == "stratified":
        return stratified_folds(df, id_col, label, k, seed)
    return cut_folds(df, id_col, k, seed)


class FoldMemo:
    """Fitted stages before the learner, per fold, shared by all candidates of a search.

    A stage is fitted again only when a Param of it or of an earlier stage differs from what was fitted. ``fits`` counts
    the fits of stages with state. Fold -1 stands for all rows.
    """

    def __init__(self, pipeline: Pipeline, folded: DataFrame):
        stages = pipeline.getStages()
        self.prefix, self.learner, self.folded = stages[:-1], stages[-1], folded
        self.fits = 0
        self._known: dict[tuple, tuple] = {}
        self._locks: dict[int, threading.Lock] = {}
        self._guard = threading.Lock()

    def own(self, stage, params: dict) -> dict:
        return {p: v for p, v in params.items() if p.parent == stage.uid}

    def key(self, params: dict) -> tuple:
        """What of ``params`` concerns the stages before the learner."""
        return tuple((i, p.name, repr(v)) for i, s in enumerate(self.prefix) for p, v in sorted(self.own(s, params).items(), key=lambda x: x[0].name))

    def stateless(self) -> bool:
        return all(isinstance(s, Transformer) for s in self.prefix)

    def training(self, fold: int, params: dict) -> tuple[list, DataFrame]:
        """The fitted stages for a fold's training rows, and those rows as the learner sees them."""
        with self._guard:
            lock = self._locks.setdefault(fold, threading.Lock())
        with lock:
            rows = self.folded if fold < 0 else self.folded.where(F.col("fold") != fold)
            fitted, path = [], (fold,)
            for i, stage in enumerate(self.prefix):
                own = self.own(stage, params)
                path += (i, *sorted((p.name, repr(v)) for p, v in own.items()))
                if path not in self._known:
                    self._known[path] = fit_stage(stage.copy(own) if own else stage, rows)
                    self.fits += not isinstance(stage, Transformer)
                model, rows = self._known[path]
                fitted.append(model)
            return fitted, rows

    def held_out(self, fold: int, fitted: list) -> DataFrame:
        return PipelineModel(fitted).transform(self.folded.where(F.col("fold") == fold))

    def fit(self, fold: int, params: dict) -> PipelineModel:
        fitted, rows = self.training(fold, params)
        learner = self.learner.copy(self.own(self.learner, params))
        return PipelineModel([*fitted, fit_learner(learner, rows)])


def _gram_scores(memo: FoldMemo, maps: list[dict], evaluator: Evaluator, k: int, parallelism: int) -> list[list[float]] | None:
    """Scores (candidate, fold) of linear learners from sums of products, or None where they do not apply.

    Stages without state give every fold the same features: one pass for all folds and candidates. Fitted stages differ
    by fold: one pass a fold. The mean absolute error is no function of the products and takes one pass more.
    """
    metric = evaluator.getMetricName() if isinstance(evaluator, RegressionEvaluator) else None
    kinds = [linear_kind(memo.learner.copy(memo.own(memo.learner, m))) for m in maps]
    if metric not in ("rmse", "mse", "r2", "mae") or None in kinds:
        return None
    label = evaluator.getLabelCol()
    features = memo.learner.getFeaturesCol()
    scores = [[0.0] * k for _ in maps]
    for key in dict.fromkeys(map(memo.key, maps)):
        chosen = [i for i, m in enumerate(maps) if memo.key(m) == key]
        sides = {}
        if memo.stateless():
            fitted, rows = memo.training(-1, maps[chosen[0]])
            if _width(rows, features) > gram.WIDEST:
                return None
            found = gram.fold_moments(rows, "fold", features, label)
            none = gram.Moments.none(len(next(iter(found.values())).mean))
            sides = {f: (sum((m for g, m in found.items() if g != f), none), found.get(f, none)) for f in range(k)}
            frames = {-1: rows}
        else:
            def one(f: int):
                fitted, rows = memo.training(f, maps[chosen[0]])
                both = rows.select("fold", features, label).union(memo.held_out(f, fitted).select("fold", features, label))
                found = gram.fold_moments(both.withColumn("held", (F.col("fold") == f).cast("int")), "held", features, label)
                none = gram.Moments.none(len(next(iter(found.values())).mean))
                return f, (found.get(0, none), found.get(1, none)), memo.held_out(f, fitted)

            if _width(memo.training(0, maps[chosen[0]])[1], features) > gram.WIDEST:
                return None
            with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
                done = list(pool.map(one, range(k)))
            sides, frames = {f: s for f, s, _ in done}, {f: held for f, _, held in done}
        fits = {(i, f): gram.solve(sides[f][0], *kinds[i]) for i in chosen for f in range(k)}
        if metric != "mae":
            for (i, f), fit in fits.items():
                scores[i][f] = gram.score(sides[f][1], fit, metric)
            continue
        from pyspark.ml.functions import vector_to_array
        for at, frame in frames.items():
            x = frame.select(F.col("fold"), F.col(label).alias("__y"), vector_to_array(features).alias("__x"))
            held = {(i, f): _absolute_error(fit) for (i, f), fit in fits.items() if at in (-1, f)}
            row = x.agg(*[F.avg(F.when(F.col("fold") == f, e)).alias(f"{i}_{f}") for (i, f), e in held.items()]).first()
            for i, f in held:
                scores[i][f] = row[f"{i}_{f}"]
    return scores


def _absolute_error(fit: gram.LinearFit) -> F.Column:
    prediction = F.lit(fit.intercept)
    for j, c in enumerate(fit.coef.tolist()):
        prediction = prediction + F.col("__x")[j] * F.lit(c)
    return F.abs(F.col("__y") - prediction)


def _width(df: DataFrame, features: str) -> int:
    attrs = df.schema[features].metadata.get("ml_attr", {})
    return int(attrs.get("num_attrs", 0)) or sum(map(len, attrs.get("attrs", {}).values()))


def cross_validate(pipeline: Pipeline, param_maps: list[dict], folded: DataFrame, evaluator: Evaluator,
                   parallelism: int = 4, k: int | None = None, memo: FoldMemo | None = None, refit: bool = True):
    """K-fold CV over a fold column; returns (best model refitted on
    all rows, table of (candidate, mean metric, its deviation over the folds, params)).

    Stages before the learner are fitted once per fold and setting (``FoldMemo``). Linear learners are solved for every
    candidate and fold from sums of products; every other (candidate, fold) fit is an independent Spark job, submitted
    from a thread pool. The fold-tagged input is cached once. Without ``refit`` the first result is None.
    """
    held = memo is None
    if held:
        memo = FoldMemo(pipeline, folded.persist())
    if k is None:
        k = memo.folded.agg(F.max("fold")).first()[0] + 1
    maps = param_maps or [{}]
    scores = _gram_scores(memo, maps, evaluator, int(k), parallelism)
    if scores is None:
        def run(job):
            i, f = job
            model = memo.fit(f, maps[i])
            return float(evaluator.evaluate(model.transform(memo.folded.where(F.col("fold") == f))))

        jobs = [(i, f) for i in range(len(maps)) for f in range(int(k))]
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            results = dict(zip(jobs, pool.map(run, jobs)))
        scores = [[results[i, f] for f in range(int(k))] for i in range(len(maps))]
    means = [sum(s) / k for s in scores]
    devs = [math.sqrt(sum((x - m) ** 2 for x in s) / k) for s, m in zip(scores, means)]
    pick = max if evaluator.isLargerBetter() else min
    best = memo.fit(-1, maps[means.index(pick(means))]) if refit else None
    rows = [(i, means[i], devs[i], str({p.name: v for p, v in pm.items()})) for i, pm in enumerate(maps)]
    table = folded.sparkSession.createDataFrame(rows, "candidate int, metric double, metric_std double, params string")
    if held:
        memo.folded.unpersist()
    return best, table


def _untried(axes: dict[str, Dimension], tried: list[dict], rng: random.Random) -> dict | None:
    """A candidate not tried yet, drawn over the whole space; None if a space of choices holds no more."""
    for _ in range(100):
        cand = {name: d.draw(rng) for name, d in axes.items()}
        if cand not in tried:
            return cand
    if any(d.choices is None for d in axes.values()):
        return None
    every = (dict(zip(axes, values)) for values in itertools.product(*(d.choices for d in axes.values())))
    left = [c for c in every if c not in tried]
    return rng.choice(left) if left else None


def adaptive_search(pipeline: Pipeline, learner, space: dict, folded: DataFrame, evaluator: Evaluator,
                    n_trials: int = 12, n_startup: int = 4, seed: int = 42, parallelism: int = 2):
    """T9 (re-aimed): a driver loop of Spark CV jobs. The first trials are
    random draws; later ones perturb the best quarter so far by one step on
    one parameter, or any untried candidate once those steps are used up, so
    it ends early only when the space does. Fitted stages are shared by all trials, and only the best candidate is
    fitted on all rows, once. Returns (best model, trial log DataFrame)."""
    rng = random.Random(seed)
    axes = {name: Dimension(spec) for name, spec in space.items()}
    for name in axes:
        if _param(learner, name) is None:
            raise ValueError(f"search parameter {name} has no Spark twin")
    tried: list[tuple[dict, float]] = []
    best_map, best_score = {}, None
    larger = evaluator.isLargerBetter()
    memo = FoldMemo(pipeline, folded.persist())
    k = memo.folded.agg(F.max("fold")).first()[0] + 1
    for t in range(n_trials):
        for _ in range(100):  # a new candidate, if the space still holds one
            if t < n_startup:
                cand = {name: d.draw(rng) for name, d in axes.items()}
            else:
                ranked = sorted(tried, key=lambda x: x[1], reverse=larger)
                cand = dict(rng.choice(ranked[: max(1, len(ranked) // 4)])[0])
                name = rng.choice(list(axes))
                cand[name] = axes[name].step(cand[name], rng) if rng.random() < 0.8 else axes[name].draw(rng)
            if all(cand != c for c, _ in tried):
                break
        else:
            cand = _untried(axes, [c for c, _ in tried], rng)
            if cand is None:
                break
        pm = {_param(learner, name): _value(learner, name, _param(learner, name), v) for name, v in cand.items()}
        _, table = cross_validate(pipeline, [pm], folded, evaluator, parallelism, k, memo, refit=False)
        score = table.first()["metric"]
        tried.append((cand, score))
        if best_score is None or (score > best_score if larger else score < best_score):
            best_map, best_score = pm, score
    best_model = memo.fit(-1, best_map) if tried else None
    memo.folded.unpersist()
    spark = folded.sparkSession
    return best_model, spark.createDataFrame([(i, str(c), float(s)) for i, (c, s) in enumerate(tried)],
                                             "trial int, params string, metric double")

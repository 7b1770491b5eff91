"""Learner factory and model introspection."""

from __future__ import annotations

import logging

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, RandomForestClassifier)
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasWeightCol
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classes import learner_stage

log = logging.getLogger(__name__)

# Parameter names of the reference learners and their Spark twins.
PARAM_MAP = {
    "iterations": "maxIter", "n_estimators": "maxIter", "depth": "maxDepth", "max_depth": "maxDepth",
    "learning_rate": "stepSize", "border_count": "maxBins", "min_data_in_leaf": "minInstancesPerNode",
    "min_child_samples": "minInstancesPerNode", "min_samples_leaf": "minInstancesPerNode",
    "subsample": "subsamplingRate", "colsample_bytree": "featureSubsetStrategy", "max_features": "featureSubsetStrategy",
    "gamma": "minInfoGain", "min_impurity_decrease": "minInfoGain", "criterion": "impurity",
    "max_iter": "maxIter", "alpha": "regParam", "l1_ratio": "elasticNetParam",
}
PARAM_MAP["min_child_weight"] = "minInstancesPerNode"
# Settings that steer a library's run or printing and no model.
INERT_PARAMS = {"verbose", "verbosity", "n_jobs", "thread_count", "random_state", "random_seed", "seed", "eval_metric", "objective",
                "solver", "cat_features", "learning_rate_schedule", "logging_level", "allow_writing_files"}
UNLIMITED_DEPTH = 30  # the deepest tree Spark grows
BOOSTERS = ("catboost", "xgboost", "lightgbm", "gbt")
FOREST_PARAMS = {"n_estimators": "numTrees"}


def encoding_for(model_type: str, configured: str = "label") -> str:
    """nn/mlp -> onehot, catboost -> native, lightgbm/xgboost/randomforest
    -> label, otherwise the configured method."""
    t = (model_type or "").lower()
    if t in ("neuralnetwork", "nn", "mlp"):
        return "onehot"
    if t == "catboost":
        return "native"
    if t in ("lightgbm", "xgboost", "randomforest"):
        return "label"
    return configured


def convert_param(name: str, value):
    """A reference parameter value as its Spark twin takes it."""
    if name == "featureSubsetStrategy":
        return "all" if value is None else str(value)
    if name == "maxDepth" and (value is None or value < 0):
        return UNLIMITED_DEPTH
    if name == "impurity" and value in ("squared_error", "mse"):
        return "variance"
    return value


def rate_scale(learner) -> float:
    """What a reference learning rate is multiplied by: Spark's squared loss fits twice the residual, so half the rate
    makes the same step."""
    return 0.5 if isinstance(learner, GBTRegressor) and learner.getLossType() == "squared" else 1.0


def _spark_params(learner, params: dict, extra: dict | None = None, ignore: tuple = ()) -> dict:
    """Spark Params for reference parameters. One without a Spark twin raises unless the config lists it under
    ``ignore_params``: a model other than the one asked for is never trained silently."""
    out = {}
    mapping = {**PARAM_MAP, **(extra or {})}
    for k, v in (params or {}).items():
        name = mapping.get(k, k)
        if k == "loss_function":
            loss = str(v).upper()
            if loss not in ("RMSE", "MAE", "LOGLOSS") or (loss == "MAE" and not learner.hasParam("lossType")):
                raise ValueError(f"loss {v} has no Spark twin")
            if loss == "MAE":
                out["lossType"] = "absolute"
        elif learner.hasParam(name):
            out[name] = convert_param(name, v)
        elif k in INERT_PARAMS or k in ignore:
            log.info("parameter %s has no effect on Spark", k)
        else:
            raise ValueError(f"parameter {k} has no Spark twin; list it under model.ignore_params to train without it")
    if "learning_rate" in (params or {}) and "stepSize" in out and out.get("lossType") != "absolute":
        out["stepSize"] *= rate_scale(learner)
    return out


class LinearByAlpha(Estimator, HasFeaturesCol, HasLabelCol):
    """Ridge, lasso and elastic net by their own ``alpha``.

    Spark scales the label by its deviation and the loss by 1 / n, so its strength depends on the data: with s the
    population deviation and n the rows, ridge is alpha * s / n, lasso alpha, and elastic net weighs both parts.
    """

    alpha = Param(Params._dummy(), "alpha", "regularisation strength", TypeConverters.toFloat)
    l1_ratio = Param(Params._dummy(), "l1_ratio", "share of the absolute penalty", TypeConverters.toFloat)

    def __init__(self, kind: str = "ridge", featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self.kind = kind
        self._setDefault(alpha=1.0, l1_ratio=0.5)
        self._set(featuresCol=featuresCol, labelCol=labelCol)

    def setParams(self, **params):
        return self._set(**params)

    def _fit(self, df: DataFrame):
        y, a = F.col(self.getLabelCol()), self.getOrDefault(self.alpha)
        n, s = df.agg(F.count(y), F.stddev_pop(y)).first()
        l1 = {"ridge": 0.0, "lasso": 1.0}.get(self.kind, self.getOrDefault(self.l1_ratio))
        if self.kind == "ridge":
            reg, net = a * (s or 0.0) / max(n, 1), 0.0
        else:
            reg = a * (l1 + (s or 0.0) * (1 - l1))
            net = a * l1 / reg if reg else 0.0
        return LinearRegression(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), standardization=False,
                                regParam=reg, elasticNetParam=net).fit(df)


class LogisticByC(Estimator, HasFeaturesCol, HasLabelCol, HasWeightCol):
    """Logistic regression by the inverse strength ``C``: Spark's regParam is 1 / (C * sum of weights)."""

    C = Param(Params._dummy(), "C", "inverse regularisation strength", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)

    def __init__(self, featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self._setDefault(C=1.0, maxIter=100)
        self._set(featuresCol=featuresCol, labelCol=labelCol)

    def setParams(self, **params):
        return self._set(**params)

    def setWeightCol(self, value: str):
        return self._set(weightCol=value)

    def _fit(self, df: DataFrame):
        weight = F.col(self.getWeightCol()) if self.isSet(self.weightCol) else F.lit(1.0)
        total = df.agg(F.sum(weight)).first()[0] or 1.0
        learner = LogisticRegression(featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), standardization=False,
                                     maxIter=self.getOrDefault(self.maxIter), regParam=1.0 / (self.getOrDefault(self.C) * total))
        if self.isSet(self.weightCol):
            learner.setWeightCol(self.getWeightCol())
        return learner.fit(df)


class PerceptronByLayers(Estimator, HasFeaturesCol, HasLabelCol):
    """MLP classifier by ``hidden_layer_sizes``; input and output layers are read from the data."""

    hidden_layer_sizes = Param(Params._dummy(), "hidden_layer_sizes", "hidden layers", TypeConverters.toListInt)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    def __init__(self, featuresCol: str = "features", labelCol: str = "label", seed: int = 42):
        super().__init__()
        self._setDefault(hidden_layer_sizes=[100], maxIter=200)
        self._set(featuresCol=featuresCol, labelCol=labelCol, seed=seed)

    def setParams(self, **params):
        return self._set(**params)

    def _fit(self, df: DataFrame):
        width = df.select(self.getFeaturesCol()).first()[0].size
        classes = int(df.agg(F.max(self.getLabelCol())).first()[0]) + 1
        return MultilayerPerceptronClassifier(
            featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(), seed=self.getOrDefault(self.seed),
            layers=[width, *self.getOrDefault(self.hidden_layer_sizes), max(classes, 2)], maxIter=self.getOrDefault(self.maxIter)).fit(df)


def create_learner(model_cfg: dict, seed: int = 42, features_col: str = "features", label_col: str = "label"):
    """Model type -> Spark learner; task regression or classification.
    Unknown types raise ValueError."""
    t = (model_cfg.get("type") or "").lower()
    task = model_cfg.get("task", "regression")
    reg = task == "regression"
    params = dict(model_cfg.get("params") or {})
    common = {"featuresCol": features_col, "labelCol": label_col}
    ignore = tuple(model_cfg.get("ignore_params") or ())
    if t in BOOSTERS:
        learner = GBTRegressor(**common, seed=seed) if reg else GBTClassifier(**common, seed=seed)
        learner.setParams(**_spark_params(learner, params, ignore=ignore))
    elif t in ("randomforest", "xgboost_rf"):
        learner = (RandomForestRegressor(**common, seed=seed) if reg else RandomForestClassifier(**common, seed=seed))
        learner.setParams(**_spark_params(learner, params, FOREST_PARAMS, ignore))
    elif t == "decisiontree":
        learner = DecisionTreeRegressor(**common, seed=seed) if reg else DecisionTreeClassifier(**common, seed=seed)
        learner.setParams(**_spark_params(learner, params, ignore=ignore))
    elif t == "linear":
        learner = LinearRegression(**common, standardization=False, regParam=0.0, elasticNetParam=0.0)
        learner.setParams(**_spark_params(learner, params, ignore=ignore))
    elif t in ("ridge", "lasso", "elasticnet"):
        learner = LinearByAlpha(t, **common)
        learner.setParams(**_spark_params(learner, params, {"alpha": "alpha", "l1_ratio": "l1_ratio"}, ignore))
    elif t == "logistic":
        learner = LogisticByC(**common)
        learner.setParams(**_spark_params(learner, params, ignore=ignore))
    elif t in ("neuralnetwork", "nn", "mlp"):
        known = {"hidden_layer_sizes", "activation", "alpha", "learning_rate_init", "max_iter", "layers"} | INERT_PARAMS | set(ignore)
        if other := sorted(set(params) - known):
            raise ValueError(f"parameters {other} have no Spark twin; list them under model.ignore_params to train without them")
        if reg:
            from .mlp import MLPRegressor
            return MLPRegressor(hidden=params.get("hidden_layer_sizes", (16,)), activation=params.get("activation", "relu"),
                                alpha=params.get("alpha", 1e-4), learningRate=params.get("learning_rate_init", 1e-2),
                                maxIter=params.get("max_iter", 100), seed=seed, featuresCol=features_col,
                                labelCol=label_col)
        hidden = list(params.get("hidden_layer_sizes") or params.get("layers", [0, 100, 0])[1:-1])
        learner = PerceptronByLayers(**common, seed=seed)
        learner.setParams(hidden_layer_sizes=hidden, maxIter=params.get("max_iter", 200))
    else:
        raise ValueError(f"Unsupported model type: {t}")
    return learner


def linear_kind(learner) -> tuple | None:
    """``(kind, alpha, l1 share)`` of a linear learner that sums of products determine, else None."""
    if isinstance(learner, LinearByAlpha):
        return learner.kind, learner.getOrDefault(learner.alpha), learner.getOrDefault(learner.l1_ratio)
    if (isinstance(learner, LinearRegression) and learner.getRegParam() == 0 and learner.getFitIntercept()
            and learner.getLoss() == "squaredError" and not learner.isSet(learner.weightCol)):
        return "linear", 0.0, 0.0
    return None


def last_stage(model):
    return learner_stage(model)


def feature_importance(spark: SparkSession, model, names: list[str]) -> DataFrame | None:
    """(feature, importance) sorted descending (ties by name); linear
    models give |coefficient|; others None."""
    m = last_stage(model)
    if hasattr(m, "models"):  # one against the rest: the mean over the classes
        each = [own.featureImportances.toArray() for own in m.models]
        values = (sum(each) / len(each)).tolist()
    elif hasattr(m, "featureImportances"):
        values = m.featureImportances.toArray().tolist()
    elif getattr(m, "numClasses", 2) > 2 and hasattr(m, "coefficientMatrix"):  # one row a class
        values = abs(m.coefficientMatrix.toArray()).mean(axis=0).tolist()
    elif hasattr(m, "coefficients"):
        values = [abs(v) for v in m.coefficients.toArray().tolist()]
    else:
        return None
    df = spark.createDataFrame(list(zip(names, [float(v) for v in values])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def coefficients(spark: SparkSession, model, names: list[str]) -> DataFrame:
    m = last_stage(model)
    return spark.createDataFrame(list(zip(names, [float(v) for v in m.coefficients.toArray().tolist()])),
                                 "feature string, coef double")


def tree_stats(model) -> dict:
    """Depth, nodes and leaves of a single tree model."""
    m = last_stage(model)
    nodes = m.numNodes
    return {"depth": m.depth, "nodes": nodes, "leaves": (nodes + 1) // 2}


def model_params(model) -> dict[str, str]:
    """Explicit parameter values of every stage, as strings."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    out = {}
    for st in stages:
        for p, v in st.extractParamMap().items():
            out[f"{type(st).__name__}.{p.name}"] = str(v)
    return out


def training_history(model, df: DataFrame, loss: str = "squared") -> list[float]:
    """Per-iteration loss of a boosted model on ``df`` (one job)."""
    m = last_stage(model)
    return list(m.evaluateEachIteration(df, loss) if hasattr(m, "evaluateEachIteration") else [])

"""Training jobs."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics
from ..operators.base import CrossFitPipeline
from ..operators.classes import class_names, is_named, with_names
from ..session import kept
from ..sources.readers import clean_column_names, clean_name, read_table
from ..sources.sinks import RunLog, save_model
from .features import plan_features, prepare_rows, slot_name, split_rows
from .learners import create_learner, feature_importance, model_params
from .search import assign_folds, cross_validate, evaluator_for, grid, random_draws
from .staged import fit_staged

log = logging.getLogger(__name__)


@dataclass
class TrainResult:
    model: PipelineModel
    metrics: dict
    importance: DataFrame | None
    cv: DataFrame | None
    feature_cols: list[str]
    run_id: str | None = None
    best_params: dict | None = None
    classes: list[str] | None = None
    report: DataFrame | None = None
    gap: dict | None = None
    history: DataFrame | None = None
    transformations: list | None = None


def evaluate_regression(model: PipelineModel, train: DataFrame, valid: DataFrame) -> dict:
    """G11, G13, G14 in two aggregate passes over the scored valid rows."""
    scored = model.transform(valid).select("label", "prediction").persist()
    reg = metrics.regression_metrics(scored, "label", "prediction").first().asDict()
    base = metrics.baseline_comparison(train, scored, "label", "prediction").first().asDict()
    res = metrics.residual_stats(scored, "label", "prediction").first().asDict()
    scored.unpersist()
    return {"MAE": reg["mae"], "RMSE": reg["rmse"], "R2": reg["r2"], "Baseline_MAE": base["baseline_mae"],
            "Improvement_percent": base["improvement_pct"], "Residual_mean": res["mean"], "Residual_std": res["std"]}


def evaluate_classification(model: PipelineModel, valid: DataFrame) -> dict:
    scored = model.transform(valid)
    s = metrics.classification_scores(scored, "label", "prediction").first().asDict()
    return {k: float(v) for k, v in s.items()}


def train(spark: SparkSession, df: DataFrame, cfg: dict, id_col: str, exact_split: bool = True,
          fit_on: str = "train") -> TrainResult:
    """Features -> split -> (search | CV + fit) -> evaluate -> importance.

    A text or boolean target of a classification is coded; the model predicts, and the report names, its classes.

    ``fit_on="train"`` (default) fits fills, encoders and scaler inside each
    training fold only (no leakage). ``fit_on="all"`` reproduces the
    reference: those stages are fitted once on all rows before the split and
    only the learner is trained per fold.

    ``model.stop_on_test`` (boosters only) stops adding rounds once the error on the test rows rises and fills
    ``TrainResult.history``.

    The rows are computed once and held until the run ends: the cuts of split and folds, the fits and the scores all
    read them.
    """
    with kept(df) as held:
        return _train(spark, held, cfg, id_col, exact_split, fit_on)


def _train(spark: SparkSession, df: DataFrame, cfg: dict, id_col: str, exact_split: bool, fit_on: str) -> TrainResult:
    seed = int(cfg.get("random_state", 42))
    fit_on = cfg.get("fit_on", fit_on)
    data, model_cfg = cfg["data"], cfg.get("model", {})
    target = clean_name(data["target_column"])
    task = model_cfg.get("task", "regression")
    clean = clean_column_names(df)
    names = class_names(clean, target) if task == "classification" and is_named(clean, target) else None
    rows = prepare_rows(clean, target, names)
    plan = plan_features(rows.drop("label"), cfg, id_col=id_col)
    rows = rows.drop(target) if target != "label" else rows
    train_df, valid_df = split_rows(rows, id_col, float(cfg.get("val_size", 0.2)), seed, exact_split)
    learner = create_learner(model_cfg, seed)
    search = model_cfg.get("hyperparameter_search", {}) or {}
    if names and len(names) > 2 and isinstance(learner, GBTClassifier):  # which tells two classes apart
        if search.get("enabled"):
            raise ValueError("a boosted classifier of more than two classes cannot be searched; use randomforest")
        learner = OneVsRest(classifier=learner, featuresCol="features", labelCol="label")
    if fit_on == "all":
        fitted_stages = CrossFitPipeline(stages=plan.stages).fit(rows)
        pipe = CrossFitPipeline(stages=[fitted_stages, learner])
    elif fit_on == "train":
        pipe = plan.pipeline(learner)
    else:
        raise ValueError(f"fit_on must be 'train' or 'all', not {fit_on!r}")
    scoring = search.get("scoring", "neg_root_mean_squared_error")
    k = int(search.get("cv", cfg.get("cv_folds", 3)))
    folded = assign_folds(train_df, id_col, k, "shuffle" if task == "regression" else "stratified", seed=seed)
    ev = evaluator_for(scoring)
    if search.get("enabled"):
        space = search.get("param_distributions", {})
        ignore = tuple(model_cfg.get("ignore_params") or ())
        method = search.get("method", "randomized_search").lower()
        if method == "randomized_search":
            maps = random_draws(learner, space, int(search.get("n_iter", 10)), seed, ignore)
        elif method == "grid_search":
            maps = grid(learner, space, ignore)
        else:
            raise ValueError(f"Unsupported search method: {method}")
    else:
        maps = [{}]
    best, cv_table = cross_validate(pipe, maps, folded, ev, parallelism=int(search.get("parallelism", 4)), k=k)
    curve = None
    if model_cfg.get("stop_on_test"):
        best, curve = _staged_best(pipe, maps, cv_table, ev, train_df, valid_df)
    model = with_names(best, names) if names else best
    m = evaluate_regression(model, train_df, valid_df) if task == "regression" else evaluate_classification(model, valid_df)
    top = cv_table.orderBy(F.desc("metric") if ev.isLargerBetter() else F.asc("metric"), "candidate").first()
    m[f"CV_{scoring}"] = float(top["metric"])
    if "root_mean_squared_error" in scoring or scoring == "rmse":
        m["CV_RMSE_mean"] = float(top["metric"])
        if not search.get("enabled"):
            m["CV_RMSE_std"] = float(top["metric_std"])
    chosen = {p.name: v for p, v in maps[top["candidate"]].items()} if search.get("enabled") else None
    imp = feature_importance(spark, model, _vector_names(model, valid_df))
    test = {"root_mean_squared_error": "RMSE", "rmse": "RMSE", "mean_absolute_error": "MAE", "mae": "MAE", "r2": "R2"}
    own_test = m.get(test.get(scoring.lower().replace("neg_", "")))
    gap = metrics.cv_test_gap(float(top["metric"]), own_test) if own_test is not None else None
    if gap and gap["too_far"]:
        log.warning("the test metric %.6g is over 10 %% away from the cross-validated %.6g", own_test, gap["cv"])
    report = None
    if task == "classification":
        own = ("label_class", "prediction_class") if names else ("label", "prediction")
        report = metrics.classification_report(model.transform(valid_df).select(*own), *own)
    return TrainResult(model, m, imp, cv_table, plan.feature_cols, best_params=chosen, classes=names, report=report, gap=gap,
                       history=curve, transformations=plan.summary["transformations"])


def _staged_best(pipe, maps: list[dict], cv_table: DataFrame, ev, train_df: DataFrame, valid_df: DataFrame):
    """The best candidate's booster, fitted in rounds until the error on the test rows rises, and its history."""
    top = cv_table.orderBy(F.desc("metric") if ev.isLargerBetter() else F.asc("metric"), "candidate").first()
    *stages, learner = pipe.getStages()
    return fit_staged(stages, learner.copy(maps[top["candidate"]]), train_df, valid_df)


def _vector_names(model: PipelineModel, df: DataFrame) -> list[str]:
    """SC8: slot names of the assembled vector, from ML attribute metadata."""
    out = model.transform(df.limit(1))
    meta = out.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    slots = sorted([a for group in meta.values() for a in group], key=lambda a: a["idx"])
    return [slot_name(a.get("name", f"f{a['idx']}")) for a in slots]


def run_experiment(spark: SparkSession, cfg: dict, id_col: str, base_dir: str | None = None,
                   log_path: str | None = None, model_path: str | None = None) -> TrainResult:
    """Read (projected), clean names, train, log the run, save the model. ``track_path`` and ``save_path`` of
    the config name the run log and the model unless the arguments do."""
    data = cfg["data"]
    df = clean_column_names(read_table(spark, data["file_path"], data.get("file_type"), base_dir=base_dir))
    needed = [clean_name(c) for c in data.get("columns_needed") or []]
    if needed:
        df = df.select(*dict.fromkeys([*needed, *([id_col] if id_col in df.columns else [])]))
    result = train(spark, df, cfg, id_col)
    log_path, model_path = log_path or cfg.get("track_path"), model_path or cfg.get("save_path")
    if log_path:
        params = model_params(result.model) | ({"best_params": result.best_params} if result.best_params else {})
        result.run_id = RunLog(log_path).append(spark, cfg.get("experiment_name", "default"), result.metrics, params)
    if model_path:
        save_model(result.model, model_path)
    return result


def compare_models(spark: SparkSession, train_df: DataFrame, valid_df: DataFrame, stages: list,
                   learners: dict, parallel: int = 3) -> DataFrame:
    """Fit several learners on one cached input (jobs submitted from a
    thread pool), score each on the valid rows; best first (O4)."""
    train_df = train_df.persist()

    def fit_one(item):
        name, learner = item
        model = CrossFitPipeline(stages=stages + [learner]).fit(train_df)
        r = metrics.regression_metrics(model.transform(valid_df), "label", "prediction").first()
        return name, float(r["mae"]), float(r["rmse"]), float(r["r2"])

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(fit_one, learners.items()))
    train_df.unpersist()
    return spark.createDataFrame(rows, "model string, mae double, rmse double, r2 double").orderBy("rmse", "model")


def coefficient_path(spark: SparkSession, train_df: DataFrame, stages: list, names: list[str],
                     alphas: list[float], l1_ratio: float = 1.0) -> DataFrame:
    """(alpha, feature, coef) of the lasso or elastic-net path; every strength is solved from one pass of products."""
    from ..operators import gram
    prepared = CrossFitPipeline(stages=stages).fit(train_df).transform(train_df).select(F.lit(0).alias("one"), "features", "label")
    found = gram.fold_moments(prepared, "one")
    rows = []
    for a in alphas:
        fit = gram.solve(found[0], "elasticnet", a, l1_ratio)
        rows += [(float(a), n, float(c)) for n, c in zip(names, fit.coef.tolist())]
    return spark.createDataFrame(rows, "alpha double, feature string, coef double")

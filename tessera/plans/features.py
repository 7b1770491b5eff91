"""Feature build (T13): config -> unfitted pyspark.ml Pipeline of stages.

operations -> feature copies -> baseline text fill -> numeric impute -> null
sweep -> categorical encoding (chosen by model type) -> optional scaling -> vector.
All fitted state lives in the stages, so scoring reuses the same fills,
encoders and scaler (the reference re-fits or drops them at scoring).
"""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, RobustScaler, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ops import apply_operations
from ..operators import prep
from ..operators.base import CrossFitPipeline
from ..operators.categories import CategoryCodes
from ..operators.classes import class_codes
from ..operators.split import hash_split, train_valid_split
from ..sources.readers import clean_name, required_feature_columns
from .learners import encoding_for

log = logging.getLogger(__name__)

KNOWN_PREP_KEYS = {"scale_features", "scaling_method", "categorical_encoding", "missing_strategy",
                   "handle_missing"}  # handle_missing is accepted for config compatibility; it has no effect


@dataclass
class FeaturePlan:
    stages: list
    feature_cols: list[str]
    label: str
    categorical: list[str]
    summary: dict = field(default_factory=dict)

    def pipeline(self, learner=None) -> Pipeline:
        return CrossFitPipeline(stages=self.stages + ([learner] if learner is not None else []))


def plan_features(df: DataFrame, cfg: dict, model_type: str | None = None, id_col: str | None = None) -> FeaturePlan:
    """Build the stage list from a config (``data`` + ``feature_engineering``).

    Features are the configured ``feature_columns`` (else ``columns_needed``
    without the target; else every numeric and text column), never the id or
    the target, plus the outputs of the operations. All stages work on copies
    (``<col>__f``): source columns pass through a fitted model unchanged.
    Without a ``preprocessing`` key nothing is imputed or scaled; what is
    missing becomes ``Unknown`` or 0. Column kinds come from the schema (no
    job). Unknown preprocessing keys are rejected instead of being ignored.
    """
    data = cfg.get("data", {})
    fe = cfg.get("feature_engineering", {}) or {}
    label = clean_name(data["target_column"])
    model_type = (model_type or cfg.get("model", {}).get("type", "")).lower()
    configured = "preprocessing" in fe
    pre = fe.get("preprocessing", {}) or {}
    unknown = set(pre) - KNOWN_PREP_KEYS
    if unknown:
        raise ValueError(f"unknown preprocessing keys: {sorted(unknown)}")
    if "handle_missing" in pre:
        log.info("preprocessing.handle_missing has no effect; missing values are always filled")
    ops = [{**op, **{k: [clean_name(c) for c in op[k]] if k == "inputs" else clean_name(op[k])
                     for k in ("inputs", "output") if k in op}} for op in fe.get("operations") or []]
    if data.get("feature_columns") or data.get("columns_needed"):
        listed = [c for c in required_feature_columns(data) if c != id_col or c in map(clean_name, data.get("feature_columns") or [])]
        missing = [c for c in listed if c not in df.columns]
        if missing:
            raise ValueError(f"missing required columns: {missing}")
    else:
        listed = [c for c in df.columns if c not in (label, id_col)]
    text = set(prep.string_columns(df)) | {clean_name(c) for c in data.get("categorical_features") or []}
    cats = [c for c in listed if c in text]
    numbers = set(prep.numeric_columns(df))
    # Training leaves out what cannot run; the saved stage holds the rest and raises when scoring data lack an input.
    _, applied_ops = apply_operations(df, ops, "skip")
    made = [op["output"] for op in applied_ops]
    ops = [op for op in ops if op.get("output") in made and (op.get("operation") or op.get("type"))]
    numeric = [c for c in listed if c in numbers and c not in cats and c not in made] + made
    copy = prep.FeatureCopies.SUFFIX
    num_f, cat_f = [c + copy for c in numeric], [c + copy for c in cats]

    strategy = pre.get("missing_strategy", "mean")
    method = encoding_for(model_type, pre.get("categorical_encoding", "label"))
    kinds = {k: len([c for c in v if c in numeric + cats]) for k, v in prep.column_kinds(df).items()}
    applied = ["columns: " + ", ".join(f"{n} {k}" for k, n in kinds.items())]
    stages: list = []
    if ops:
        stages.append(prep.FeatureOperations(ops, onError="raise"))
        applied.append(f"operations: {', '.join(made)}")
    stages += [prep.FeatureCopies(numeric + cats), prep.CategoricalBaseline(cat_f, listedOnly=True)]
    applied.append(f"text filled with {prep.UNKNOWN}: {', '.join(cats)}")
    if configured:
        stages.append(prep.NumericImputer(num_f, strategy=strategy))
        applied.append(f"numbers filled by {strategy}")
    else:
        applied.append("numbers filled with 0")
    stages.append(prep.FillMissing(inputCols=num_f + cat_f))  # before indexing, which hangs metadata on its outputs
    cat_features: list[str] = []
    if cats and method in ("onehot", "native"):
        idx = [f"{c}__idx" for c in cats]
        # Native: nominal metadata, so trees split on sets of categories; columns too wide for tree bins get statistics.
        stages.append(CategoryCodes(cat_f, idx, "label" if method == "native" else "", id_col or ""))
        cat_features = idx
        if method == "onehot":
            # Vector one-hot: the dropped last slot is the unseen one -> all zeros.
            cat_features = [f"{c}__oh" for c in cats]
            stages.append(OneHotEncoder(inputCols=idx, outputCols=cat_features, dropLast=True))
    elif cats:
        stages.append(prep.LabelEncoder(cat_f))
        cat_features = cat_f
    applied.append(f"categories: {method}")
    scaling, scaler = bool(pre.get("scale_features", False)), pre.get("scaling_method", "standard")
    if scaling:
        stages.append(prep.Scaler(num_f + (cat_f if method == "label" else []), scaler))
        if method == "onehot" and cats:
            raw = [f"{c}__ohr" for c in cats]
            stages[-2].setOutputCols(raw)
            stages += [_vector_scaler(scaler, r, o) for r, o in zip(raw, cat_features)]
        applied.append(f"scaled: {scaler}")
    stages.append(VectorAssembler(inputCols=num_f + cat_features, outputCol="features", handleInvalid="keep"))
    return FeaturePlan(stages, numeric + cats, label, cats,
                       {"model_type": model_type, "columns": kinds, "encoding_method": method, "missing_strategy": strategy if configured else None,
                        "scaling": scaling, "scaling_method": scaler, "operations": ops, "transformations": applied})


def _vector_scaler(method: str, inp: str, out: str):
    """SC1-SC3 on a one-hot vector (0/1 slots are numbers like any other to the scaler; standard uses the sample deviation)."""
    if method == "minmax":
        return MinMaxScaler(inputCol=inp, outputCol=out)
    if method == "robust":
        return RobustScaler(inputCol=inp, outputCol=out, withCentering=True, withScaling=True)
    return StandardScaler(inputCol=inp, outputCol=out, withMean=True, withStd=True)


def slot_name(name: str) -> str:
    """The configured name behind a vector slot: copies, indexes and one-hot slots lose their suffixes."""
    for mark in ("__ohr_", "__oh_"):
        if mark in name:
            return name.replace(mark, "_", 1)
    for mark in (prep.FeatureCopies.SUFFIX, "__idx"):
        name = name.removesuffix(mark)
    return name


def prepare_rows(df: DataFrame, label: str, names: list[str] | None = None) -> DataFrame:
    """Drop rows with a null target; the target as double ``label``, or its place among the class ``names``."""
    label = clean_name(label)
    if names is not None:
        return class_codes(df, label, names)
    return df.withColumn("label", prep.number(label)).where(F.col("label").isNotNull())


def split_rows(df: DataFrame, id_col: str, val_size: float, seed: int, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """Exact-size hash-order split, or the rank-free hash threshold."""
    s = train_valid_split(df, id_col, val_size, seed) if exact else hash_split(df, id_col, val_size, seed)
    return s.where(F.col("split") == "train").drop("split"), s.where(F.col("split") == "valid").drop("split")


def route_columns(groups: dict[str, tuple[list, list[str]]], remainder: list[str] | None = None,
                  output: str = "features") -> Pipeline:
    """SC5: per-group stages (name -> (stages, output columns)) followed by one
    assembler; columns not routed are dropped unless listed in ``remainder``."""
    stages, cols = [], []
    for _, (group_stages, out_cols) in groups.items():
        stages += list(group_stages)
        cols += list(out_cols)
    cols += list(remainder or [])
    stages.append(VectorAssembler(inputCols=cols, outputCol=output, handleInvalid="keep"))
    return Pipeline(stages=stages)

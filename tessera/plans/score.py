"""Batch scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.prep import assert_numeric
from ..sources.readers import clean_column_names, clean_name, required_feature_columns, validate_columns
from ..sources.sinks import model_family, write_table


def _guarded(model: PipelineModel, df: DataFrame) -> DataFrame:
    """P10: the model's output; text that would reach its vector raises with the column names first."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    at = next((i for i, s in enumerate(stages) if isinstance(s, VectorAssembler)), None)
    if at is None:
        return model.transform(df)
    before = PipelineModel(stages[:at]).transform(df)
    have = [c for c in stages[at].getInputCols() if c in before.columns]
    return PipelineModel(stages[at:]).transform(assert_numeric(before, have))


def score(model: PipelineModel, df: DataFrame, data_cfg: dict | None = None, keep: list[str] | None = None,
          with_probability: bool = False) -> DataFrame:
    """Clean names, check required columns, predict, stamp.

    Source columns pass through unchanged, in values and types (features are
    copies; no second read of the input and no positional append). The
    prediction is named ``Predicted_<target>`` after the config's target. The
    timestamp is one literal per query.
    """
    predicted = "Predicted_Value"
    df = clean_column_names(df)
    if data_cfg:
        validate_columns(df, required_feature_columns(data_cfg))
        predicted = f"Predicted_{clean_name(data_cfg.get('target_column') or 'Target')}"
    scored = _guarded(model, df)
    named = "prediction_class" in scored.columns  # a model of named classes predicts their names
    stamps = {predicted: F.col("prediction_class" if named else "prediction"),
              "Prediction_Timestamp": F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"),
              "Model_Type": F.lit(model_family(model))}
    if with_probability and "probability" in scored.columns:
        p = vector_to_array("probability")  # T26: of the positive class; of the predicted one when there are more than two
        stamps["Probability"] = F.when(F.size(p) == 2, p[1]).otherwise(F.array_max(p)) if named else p[1]
    out = scored.withColumns(stamps)
    cols = (keep if keep is not None else df.columns) + list(stamps)
    return out.select(*cols)


def score_to_path(model: PipelineModel, df: DataFrame, path: str, fmt: str = "parquet", **kw) -> DataFrame:
    """Score and write; returns the scored plan (the write is one job)."""
    out = score(model, df, **kw)
    write_table(out, path, fmt)
    return out


def prediction_summary_row(scored: DataFrame, predicted: str = "Predicted_Value") -> dict:
    """G1 of the predictions, one aggregate."""
    x = F.col(predicted)
    return scored.agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
                      F.stddev_pop(x).alias("std")).first().asDict()


def encode_on_batch(df: DataFrame, cols: list[str]) -> DataFrame:
    """E5 (unsafe, kept for parity): label codes fitted on the scored batch
    itself when no encoder was saved. Codes depend on the batch contents."""
    from ..operators.prep import LabelEncoder
    return LabelEncoder(cols).fit(df).transform(df)

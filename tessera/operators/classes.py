"""Class labels of any type (T11, T16, T26): codes for the learner, names for everything a user sees.

A classification target that is text or boolean becomes 0-based codes in the
order of its names. The names travel in the fitted model as its last stage,
which puts ``prediction_class`` beside the learner's code, so a saved model
scores in class names without the label column or the training data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_CLASSES = 1000  # classes that a learner is asked to tell apart


def is_named(df: DataFrame, label: str) -> bool:
    """Whether the target's values are names (text or booleans), not numbers."""
    return isinstance(df.schema[label].dataType, (T.StringType, T.BooleanType))


def class_names(df: DataFrame, label: str) -> list[str]:
    """The target's distinct values as text, sorted; null is no class."""
    rows = df.select(F.col(label).cast("string").alias("c")).where(F.col("c").isNotNull()).distinct().limit(MOST_CLASSES + 1).collect()
    if len(rows) > MOST_CLASSES:
        raise ValueError(f"{label} holds over {MOST_CLASSES} classes")
    return sorted((r["c"] for r in rows), key=lambda s: s.encode("utf-8"))


def class_codes(df: DataFrame, label: str, names: Sequence[str], out: str = "label") -> DataFrame:
    """``out``: the 0-based code of the row's class as double; rows without a known class are left out."""
    at = F.array_position(F.array(*map(F.lit, names)), F.col(label).cast("string"))
    return df.withColumn(out, F.nullif(at, F.lit(0)).cast("double") - 1).where(F.col(out).isNotNull())


class ClassNames(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``<codes>_class``, the name behind a code, for every code column that is there (``prediction``, ``label``)."""

    names = Param(Params._dummy(), "names", "class names by code", TypeConverters.toListString)

    def __init__(self, names: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(names=[])
        if names is not None:
            self._set(names=list(names))

    def _transform(self, df: DataFrame) -> DataFrame:
        named = F.array(*map(F.lit, self.getOrDefault(self.names)))
        return df.withColumns({f"{c}_class": F.get(named, F.col(c).cast("int")) for c in ("prediction", "label") if c in df.columns})


def with_names(model: PipelineModel, names: Sequence[str]) -> PipelineModel:
    return PipelineModel([*model.stages, ClassNames(names)])


def learner_stage(model):
    """The fitted learner of a model: its last stage but class names."""
    stages = model.stages if isinstance(model, PipelineModel) else [model]
    return next((s for s in reversed(stages) if not isinstance(s, ClassNames)), model)

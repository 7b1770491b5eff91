"""Fit/transform stages for missing values, encoding and scaling
(M1-M6, E1-E6, SC1-SC4) as pyspark.ml Estimator/Model pairs.

Fitting computes all columns in one aggregate pass (or one unpivoted
aggregation for maps); transforming is a projection or a lookup join.
"""

from __future__ import annotations

import json
import logging
from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.stats import quantiles
from ..session import cut_lineage
from .base import (DefaultParamsReadable, DefaultParamsWritable, Estimator, HasInputCols, HasState, MapModel, Model,
                   Transformer, lookup_all, settle_map, small_rows)
from .ordered import global_rank

log = logging.getLogger(__name__)

UNKNOWN = "Unknown"


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by schema walk (no job)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def number(c: str) -> F.Column:
    """A column as double with NaN as null: NaN is a missing value everywhere."""
    return F.nullif(F.col(c).cast("double"), F.lit(float("nan")))


class FeatureCopies(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Copies source columns to ``<col>__f``; later stages work on the copies, so sources reach the output unchanged."""

    SUFFIX = "__f"

    def __init__(self, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c + self.SUFFIX: F.col(c) for c in self.getInputCols()}) if self.getInputCols() else df


class CategoricalBaseline(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Listed plus (unless ``listedOnly``) all string columns -> string, null and 'nan' -> 'Unknown'."""

    listedOnly = Param(Params._dummy(), "listedOnly", "leave unlisted text columns alone", TypeConverters.toBoolean)

    def __init__(self, inputCols: Sequence[str] | None = None, listedOnly: bool = False):
        super().__init__()
        self._setDefault(inputCols=[], listedOnly=False)
        self._set(listedOnly=listedOnly)
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _transform(self, df: DataFrame) -> DataFrame:
        rest = [] if self.getOrDefault(self.listedOnly) else string_columns(df)
        cols = list(dict.fromkeys([c for c in self.getInputCols() if c in df.columns] + rest))
        exprs = {}
        for c in cols:
            s = F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
            exprs[c] = F.when(s == "nan", F.lit(UNKNOWN)).otherwise(s)
        return df.withColumns(exprs) if exprs else df


class FillMissing(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """M4/M6: stateless sweep: numeric nulls and NaN -> number, string nulls -> text (all columns, or the listed ones)."""

    numeric = Param(Params._dummy(), "numeric", "numeric fill", TypeConverters.toFloat)
    text = Param(Params._dummy(), "text", "string fill", TypeConverters.toString)

    def __init__(self, numeric: float = 0.0, text: str = UNKNOWN, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(numeric=float(numeric), text=text)
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _transform(self, df: DataFrame) -> DataFrame:
        num = self.getOrDefault(self.numeric)
        txt = self.getOrDefault(self.text)
        listed = set(self.getInputCols()) if self.isSet(self.inputCols) else set(df.columns)
        exprs = {}
        for c in numeric_columns(df):
            kind = df.schema[c].dataType
            known = F.nullif(F.col(c), F.lit(float("nan")).cast(kind)) if isinstance(kind, (T.FloatType, T.DoubleType)) else F.col(c)
            exprs[c] = F.coalesce(known, F.lit(num).cast(kind))
        exprs.update({c: F.coalesce(F.col(c), F.lit(txt)) for c in string_columns(df)})
        exprs = {c: e for c, e in exprs.items() if c in listed}
        return df.withColumns(exprs) if exprs else df


# --- M2/M5: numeric imputation --------------------------------------------------

class NumericImputer(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """M2: mean | median (exact) | constant fill; the fill value is stored for
    every input column (also those without nulls at fit time)."""

    strategy = Param(Params._dummy(), "strategy", "mean, median or constant", TypeConverters.toString)
    fillValue = Param(Params._dummy(), "fillValue", "constant fill", TypeConverters.toFloat)

    def __init__(self, inputCols: Sequence[str] | None = None, strategy: str = "mean", fillValue: float = 0.0):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(strategy=strategy, fillValue=float(fillValue))
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> NumericImputerModel:
        cols = self.getInputCols() or numeric_columns(df)
        strategy = self.getOrDefault(self.strategy)
        if strategy == "mean":
            row = df.agg(*[F.avg(number(c)).alias(c) for c in cols]).first().asDict()
            fills = {c: (row[c] if row[c] is not None else 0.0) for c in cols}
        elif strategy == "median":
            med = quantiles(df, cols, [0.5])
            fills = {c: (med[c][0] if med[c][0] is not None else 0.0) for c in cols}
        else:
            fills = {c: self.getOrDefault(self.fillValue) for c in cols}
        return NumericImputerModel(cols, fills)


class NumericImputerModel(Model, HasInputCols, HasState, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols: Sequence[str] | None = None, fills: dict | None = None):
        super().__init__()
        self._setDefault(inputCols=[], state="{}")
        if inputCols is not None:
            self._set(inputCols=list(inputCols), state=json.dumps(fills or {}))

    @property
    def fills(self) -> dict:
        return self._state()

    def _transform(self, df: DataFrame) -> DataFrame:
        fills = self.fills
        exprs = {c: F.coalesce(number(c), F.lit(float(v))) for c, v in fills.items() if c in df.columns}
        return df.withColumns(exprs) if exprs else df


# --- E3/E4/E5: label codes with -1 for unseen ----------------------------------

class LabelEncoder(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Per column, sorted distinct values -> 0..k-1; unseen -> -1.

    All columns are unpivoted once; codes come from a distributed rank within
    each column (no single-partition window).
    """

    def __init__(self, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> LabelEncoderModel:
        cols = self.getInputCols()
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
        ])).alias("kv")).select("kv.*").where(F.col("value").isNotNull()).distinct()
        long = cut_lineage(long)
        small = small_rows(long)
        if small is not None:
            # Measured to be small: codes are assigned from the sorted distinct values.
            rows, by_col = [], {}
            for r in small:
                by_col.setdefault(r["column_name"], []).append(r["value"])
            for c, values in by_col.items():
                rows += [(c, v, i) for i, v in enumerate(sorted(values, key=lambda s: s.encode("utf-8")))]
            mapping = df.sparkSession.createDataFrame(rows, "column_name string, value string, code long")
            n = len(rows)
        else:
            ranked = global_rank(long, ["value"], "code", partition_by=["column_name"])
            mapping, n = settle_map(ranked.select("column_name", "value",
                                                  (F.col("code") - 1).cast("long").alias("code")))
        model = LabelEncoderModel(cols, n)
        model.mapping = mapping
        return model


class LabelEncoderModel(MapModel):
    def __init__(self, inputCols: Sequence[str] | None = None, n_rows: int = 0):
        super().__init__()
        self._setDefault(inputCols=[], state="{}")
        if inputCols is not None:
            self._set(inputCols=list(inputCols), state=json.dumps({"n_rows": n_rows}))

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = [c for c in self.getInputCols() if c in df.columns]
        out = lookup_all(df, self.mapping, self._state().get("n_rows", 0), {c: F.col(c).cast("string") for c in cols}, "code")
        return (out.withColumns({c: F.coalesce(F.col(f"__got_{c}"), F.lit(-1).cast("long")) for c in cols})
                .drop(*[f"__got_{c}" for c in cols]))


# --- E2: one-hot, wide columns --------------------------------------------------

class DropColumns(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCols: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[])
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getInputCols())


class OneHotWide(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """``{col}_{value}`` 0/1 columns for sorted categories; unseen -> all 0.

    A column of more than ``maxCategories`` values becomes one sparse vector column ``{col}_onehot`` instead, from a
    dictionary made on the cluster: its slots are the values in order, as ``names_table`` of the fitted codes lists.
    """

    maxCategories = Param(Params._dummy(), "maxCategories", "values up to which each becomes a column", TypeConverters.toInt)
    dropInput = Param(Params._dummy(), "dropInput", "drop the source column", TypeConverters.toBoolean)

    def __init__(self, inputCols: Sequence[str] | None = None, maxCategories: int = 1000, dropInput: bool = True):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(maxCategories=maxCategories, dropInput=dropInput)
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame):
        from .categories import OneHotVector  # which builds on this module's neighbours
        cols, bound, drop = self.getInputCols(), self.getOrDefault(self.maxCategories), self.getOrDefault(self.dropInput)
        long = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("k"), F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN)).alias("v"))
            for c in cols])).alias("kv")).select("kv.*").distinct()
        long = cut_lineage(long)
        sizes = {r["k"]: r["n"] for r in long.groupBy("k").agg(F.count("*").alias("n")).collect()}
        wide = [c for c in cols if sizes.get(c, 0) > bound]
        cats: dict[str, list[str]] = {c: [] for c in cols if c not in wide}
        for r in long.where(~F.col("k").isin(wide)).collect():  # at most ``bound`` values a column
            cats[r["k"]].append(r["v"])
        narrow = OneHotWideModel(list(cats), {c: sorted(v) for c, v in cats.items()}, drop)
        if not wide:
            return narrow
        base = CategoricalBaseline(wide, listedOnly=True)
        vectors = OneHotVector(wide, [f"{c}_onehot" for c in wide]).fit(base.transform(df))
        codes = [f"{c}_onehot__idx" for c in wide]
        return PipelineModel([narrow, base, *vectors.stages, DropColumns(codes + (wide if drop else []))])


class OneHotWideModel(Model, HasInputCols, HasState, DefaultParamsReadable, DefaultParamsWritable):
    dropInput = Param(Params._dummy(), "dropInput", "drop the source column", TypeConverters.toBoolean)

    def __init__(self, inputCols: Sequence[str] | None = None, categories: dict | None = None,
                 dropInput: bool = True):
        super().__init__()
        self._setDefault(inputCols=[], state="{}", dropInput=True)
        if inputCols is not None:
            self._set(inputCols=list(inputCols), state=json.dumps(categories or {}), dropInput=dropInput)

    @property
    def categories(self) -> dict:
        return self._state()

    def feature_names(self) -> list[str]:
        return [f"{c}_{v}" for c, vs in self.categories.items() for v in vs]

    def _transform(self, df: DataFrame) -> DataFrame:
        exprs = {}
        for c, values in self.categories.items():
            s = F.coalesce(F.col(c).cast("string"), F.lit(UNKNOWN))
            for v in values:
                exprs[f"{c}_{v}"] = (s == F.lit(v)).cast("double")
        out = df.withColumns(exprs) if exprs else df
        if self.getOrDefault(self.dropInput):
            out = out.drop(*self.categories.keys())
        return out


# --- SC1-SC4: scalers -----------------------------------------------------------

class Scaler(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """SC1 standard (population std; 0 -> 1), SC2 min-max (constant -> 0),
    SC3 robust (median / IQR, exact; IQR 0 -> 1). Unknown method -> standard."""

    method = Param(Params._dummy(), "method", "standard, minmax or robust", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] | None = None, method: str = "standard"):
        super().__init__()
        self._setDefault(inputCols=[])
        if method not in ("standard", "minmax", "robust"):
            log.warning("unknown scaling method %r, using standard", method)
            method = "standard"
        self._set(method=method)
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> ScalerModel:
        cols = self.getInputCols() or numeric_columns(df)
        method = self.getOrDefault(self.method)
        stats: dict[str, list[float]] = {}
        if method == "standard":
            row = df.agg(*[F.avg(number(c)).alias(f"m_{c}") for c in cols],
                         *[F.stddev_pop(number(c)).alias(f"s_{c}") for c in cols]).first()
            for c in cols:
                s = row[f"s_{c}"] or 0.0
                stats[c] = [row[f"m_{c}"] or 0.0, s if s != 0 else 1.0]
        elif method == "minmax":
            row = df.agg(*[F.min(number(c)).alias(f"lo_{c}") for c in cols],
                         *[F.max(number(c)).alias(f"hi_{c}") for c in cols]).first()
            for c in cols:
                lo, hi = row[f"lo_{c}"] or 0.0, row[f"hi_{c}"] or 0.0
                stats[c] = [lo, (hi - lo) if hi != lo else 1.0]
        else:
            q = quantiles(df, cols, [0.25, 0.5, 0.75])
            for c in cols:
                q1, med, q3 = [v if v is not None else 0.0 for v in q[c]]
                stats[c] = [med, (q3 - q1) if q3 != q1 else 1.0]
        return ScalerModel(cols, stats, method)


class ScalerModel(Model, HasInputCols, HasState, DefaultParamsReadable, DefaultParamsWritable):
    method = Param(Params._dummy(), "method", "standard, minmax or robust", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] | None = None, stats: dict | None = None,
                 method: str = "standard"):
        super().__init__()
        self._setDefault(inputCols=[], state="{}", method="standard")
        if inputCols is not None:
            self._set(inputCols=list(inputCols), state=json.dumps(stats or {}), method=method)

    @property
    def stats(self) -> dict:
        return self._state()

    def _transform(self, df: DataFrame) -> DataFrame:
        exprs = {c: (F.col(c).cast("double") - F.lit(center)) / F.lit(scale)
                 for c, (center, scale) in self.stats.items() if c in df.columns}
        return df.withColumns(exprs) if exprs else df


class FeatureOperations(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A8 as a pipeline stage: the ordered operation list, stored as JSON."""

    operations = Param(Params._dummy(), "operations", "operation list as JSON", TypeConverters.toString)
    onError = Param(Params._dummy(), "onError", "skip or raise", TypeConverters.toString)

    def __init__(self, operations: list | None = None, onError: str = "skip"):
        super().__init__()
        self._set(operations=json.dumps(operations or []), onError=onError)

    def get_operations(self) -> list:
        return json.loads(self.getOrDefault(self.operations))

    def _transform(self, df: DataFrame) -> DataFrame:
        from ..functions.ops import apply_operations
        out, _ = apply_operations(df, self.get_operations(), self.getOrDefault(self.onError))
        return out


def column_kinds(df: DataFrame) -> dict[str, list[str]]:
    """Numeric, text and 0/1-flag columns by schema (no job)."""
    numeric = numeric_columns(df)
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegerType, T.ByteType, T.ShortType,
                                                                           T.BooleanType))
             and (f.name.lower().startswith(("is_", "has_")) or isinstance(f.dataType, T.BooleanType))]
    return {"numeric": [c for c in numeric if c not in flags], "text": string_columns(df), "flag": flags}


def assert_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """P10: fail before a numeric learner if any feature is still text."""
    text = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    if text:
        raise ValueError(f"columns still hold text before a numeric model: {text}")
    return df


def impute_by_kind(df: DataFrame, numeric: Sequence[str], flags: Sequence[str], text: Sequence[str],
                   text_fill: str = "missing") -> DataFrame:
    """M5: median for numeric columns (fitted on ``df``), 0 for flags,
    ``text_fill`` for text; one fit pass, one projection."""
    model = NumericImputer(list(numeric), "median").fit(df) if numeric else None
    out = model.transform(df) if model else df
    exprs = {c: F.coalesce(F.col(c), F.lit(0).cast(df.schema[c].dataType)) for c in flags}
    exprs.update({c: F.coalesce(F.col(c), F.lit(text_fill)) for c in text})
    return out.withColumns(exprs) if exprs else out

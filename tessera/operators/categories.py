"""Category codes of any width (E1, E2): dictionaries made on the cluster, target statistics for wide columns.

A dictionary is one map (column_name, value) -> number, fitted in one
unpivoted aggregation and looked up for all columns at once. A column of at
most ``widest`` values gets codes in the order of its values, with nominal
metadata, so trees split on sets of categories. A wider one gets a target
statistic instead: the smoothed mean target of its value.

A training row must not see its own target. ``fitTransform`` therefore deals
the training rows over ``blocks`` by a hash of their order column, and a row's
statistic comes from the earlier blocks alone. ``transform`` uses all rows of
the fit. Inside a cross-validation both see the fold's training rows only.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import (DefaultParamsReadable, DefaultParamsWritable, Estimator, HasInputCols, MapModel, lookup_all, settle_map)
from .ordered import global_rank

WIDEST = 254  # values of a column that trees take as a nominal attribute
NAMED = 1000  # values up to which they are named in the metadata
SEED = 42


class _CategoryParams(HasInputCols):
    outputCols = Param(Params._dummy(), "outputCols", "output columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "target of the statistics; empty: codes for every column", TypeConverters.toString)
    orderCol = Param(Params._dummy(), "orderCol", "column whose hash orders the training rows; empty: all columns", TypeConverters.toString)
    widest = Param(Params._dummy(), "widest", "values up to which a column gets codes", TypeConverters.toInt)
    blocks = Param(Params._dummy(), "blocks", "blocks of the training order", TypeConverters.toInt)
    priorWeight = Param(Params._dummy(), "priorWeight", "weight of the mean target", TypeConverters.toFloat)

    def outputs(self) -> dict[str, str]:
        return dict(zip(self.getInputCols(), self.getOrDefault(self.outputCols)))


def _pairs(df: DataFrame, cols: Sequence[str], extra: dict[str, Column]) -> DataFrame:
    """(column_name, value) of every row and column, null values left out."""
    kv = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]))
    return df.select(kv.alias("kv"), *[e.alias(n) for n, e in extra.items()]).select("kv.*", *extra).where(F.col("value").isNotNull())


def training_block(order_col: str, columns: Sequence[str], blocks: int, seed: int = SEED) -> Column:
    """The block of a training row: md5('seed:order') modulo ``blocks`` (null orders hash as the empty string)."""
    if order_col:
        h = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(order_col).cast("string"), F.lit(""))))
        return (F.conv(F.substring(h, 1, 7), 16, 10).cast("long") % blocks).cast("int")
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(blocks)).cast("int")


class CategoryCodes(Estimator, _CategoryParams, DefaultParamsReadable, DefaultParamsWritable):
    """Codes for narrow columns, smoothed target means for wide ones. Null values and values not met at fit time get the
    code after the last (codes) or the mean target (statistics)."""

    def __init__(self, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None, labelCol: str = "",
                 orderCol: str = "", widest: int = WIDEST, blocks: int = 16, priorWeight: float = 1.0):
        super().__init__()
        self._setDefault(inputCols=[], outputCols=[])
        self._set(labelCol=labelCol, orderCol=orderCol, widest=widest, blocks=blocks, priorWeight=float(priorWeight))
        if inputCols is not None:
            self._set(inputCols=list(inputCols), outputCols=list(outputCols or [f"{c}__code" for c in inputCols]))

    def _fit(self, df: DataFrame) -> CategoryCodesModel:
        return self._fitted(df)[0]

    def _fitted(self, df: DataFrame) -> tuple[CategoryCodesModel, DataFrame | None, list[str]]:
        cols, label, blocks = self.getInputCols(), self.getOrDefault(self.labelCol), self.getOrDefault(self.blocks)
        known = bool(label) and label in df.columns
        order = self.getOrDefault(self.orderCol)
        order = order if order in df.columns else ""
        y = F.col(label).cast("double") if known else F.lit(None).cast("double")
        pairs = _pairs(df, cols, {"y": y, "block": training_block(order, df.columns, blocks) if known else F.lit(0)})
        cells = cut_lineage(pairs.groupBy("column_name", "value", "block").agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("s")))
        values = cells.groupBy("column_name", "value").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        sizes = {c: 0 for c in cols} | {r["column_name"]: r["size"] for r in values.groupBy("column_name").agg(F.count("*").alias("size")).collect()}
        wide = [c for c in cols if label and sizes[c] > self.getOrDefault(self.widest)]
        if wide and not known:
            raise ValueError(f"columns {wide} hold over {self.getOrDefault(self.widest)} categories: their statistics need the label column {label}")
        weight = self.getOrDefault(self.priorWeight)
        prior = (df.agg(F.avg(y)).first()[0] or 0.0) if wide else 0.0
        coded = _codes(values.where(~F.col("column_name").isin(wide))) if len(wide) < len(cols) else None
        stats = (values.where(F.col("column_name").isin(wide))
                 .select("column_name", "value", ((F.col("s") + weight * prior) / (F.col("n") + weight)).alias("number"))) if wide else None
        mapping, n = settle_map(coded if stats is None else stats if coded is None else coded.unionByName(stats))
        named = [c for c in cols if c not in wide and sizes[c] <= NAMED]
        names: dict[str, list[str]] = {c: [] for c in named}
        for r in mapping.where(F.col("column_name").isin(named)).orderBy("column_name", "number").collect() if named else ():
            names[r["column_name"]].append(r["value"])  # at most NAMED values a column
        model = CategoryCodesModel(cols, self.getOrDefault(self.outputCols),
                                   {"n_rows": n, "sizes": sizes, "wide": wide, "prior": prior, "names": names})
        model.mapping = mapping
        if not wide:
            return model, None, wide
        before = Window.partitionBy("column_name", "value").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # at most ``blocks`` rows
        earlier = (cells.where(F.col("column_name").isin(wide))
                   .withColumns({"n0": F.coalesce(F.sum("n").over(before), F.lit(0)), "s0": F.coalesce(F.sum("s").over(before), F.lit(0.0))})
                   .select("column_name", F.concat(F.col("block").cast("string"), F.lit(":"), "value").alias("value"),
                           ((F.col("s0") + weight * prior) / (F.col("n0") + weight)).alias("number")))
        return model, earlier, wide

    def fitTransform(self, df: DataFrame) -> tuple[CategoryCodesModel, DataFrame]:
        """The model and the training rows, whose statistics come from earlier blocks of the order."""
        model, earlier, wide = self._fitted(df)
        if earlier is None:
            return model, model.transform(df)
        order = self.getOrDefault(self.orderCol)
        block = training_block(order if order in df.columns else "", df.columns, self.getOrDefault(self.blocks)).cast("string")
        mapping, n = settle_map(earlier)
        out = lookup_all(df, mapping, n, {c: F.concat(block, F.lit(":"), F.col(c).cast("string")) for c in wide}, "number")
        outputs, prior = self.outputs(), model.state_of("prior")
        out = out.withColumns({outputs[c]: F.coalesce(F.col(f"__got_{c}"), F.lit(prior)) for c in wide}).drop(*[f"__got_{c}" for c in wide])
        return model, model.transform(out, [c for c in self.getInputCols() if c not in wide])


def _codes(values: DataFrame) -> DataFrame:
    """0-based codes in the order of the values, per column."""
    ranked = global_rank(values.select("column_name", "value"), ["value"], "number", partition_by=["column_name"])
    return ranked.select("column_name", "value", (F.col("number") - 1).cast("double").alias("number"))


class CategoryCodesModel(MapModel):
    outputCols = Param(Params._dummy(), "outputCols", "output columns", TypeConverters.toListString)

    def __init__(self, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None, state: dict | None = None):
        super().__init__()
        self._setDefault(inputCols=[], outputCols=[], state="{}")
        if inputCols is not None:
            self._set(inputCols=list(inputCols), outputCols=list(outputCols), state=json.dumps(state or {}))

    def state_of(self, key: str):
        return self._state()[key]

    def names_table(self) -> DataFrame:
        """(column_name, value, number) of every known value: names of any number of categories as a table."""
        return self.mapping

    def transform(self, dataset: DataFrame, params=None) -> DataFrame:
        if isinstance(params, list):  # only these columns
            return self._columns(dataset, params)
        return super().transform(dataset, params)

    def _transform(self, df: DataFrame) -> DataFrame:
        return self._columns(df, self.getInputCols())

    def _columns(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        if not cols:
            return df
        state = self._state()
        outputs = dict(zip(self.getInputCols(), self.getOrDefault(self.outputCols)))
        out = lookup_all(df, self.mapping, state["n_rows"], {c: F.col(c).cast("string") for c in cols}, "number")
        exprs = {}
        for c in cols:
            got = F.col(f"__got_{c}")
            if c in state["wide"]:
                exprs[outputs[c]] = F.coalesce(got, F.lit(float(state["prior"])))
                continue
            attr = {"type": "nominal", "name": outputs[c]}
            if c in state["names"]:
                attr["vals"] = [*state["names"][c], "__unknown"]
            else:
                attr["num_vals"] = state["sizes"][c] + 1
            exprs[outputs[c]] = F.coalesce(got, F.lit(float(state["sizes"][c]))).alias(outputs[c], metadata={"ml_attr": attr})
        out = out.select("*", *[e.alias(n) if n in [outputs[c] for c in state["wide"]] else e for n, e in exprs.items()])
        return out.drop(*[f"__got_{c}" for c in cols])


class OneHotVector(Estimator, _CategoryParams, DefaultParamsReadable, DefaultParamsWritable):
    """E2 at any width: one sparse vector column for each input; the slot of a value is its code, unseen values have
    no slot. Slot names of up to ``NAMED`` values are metadata; ``CategoryCodesModel.names_table`` holds all."""

    def __init__(self, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._setDefault(inputCols=[], outputCols=[])
        if inputCols is not None:
            self._set(inputCols=list(inputCols), outputCols=list(outputCols or [f"{c}__oh" for c in inputCols]))

    def stages(self) -> list:
        cols, outs = self.getInputCols(), self.getOrDefault(self.outputCols)
        codes = [f"{o}__idx" for o in outs]
        return [CategoryCodes(cols, codes), OneHotEncoder(inputCols=codes, outputCols=outs, dropLast=True, handleInvalid="error")]

    def _fit(self, df: DataFrame):
        return Pipeline(stages=self.stages()).fit(df)


def one_hot_slots(encoded: DataFrame, vector_col: str, id_cols: Sequence[str]) -> DataFrame:
    """(id, slot) of every 1 in a sparse one-hot column."""
    return encoded.select(*id_cols, F.explode(F.unwrap_udt(vector_col).getField("indices")).alias("slot"))

"""Shared pieces for fitted stages: JSON state params and map persistence."""

from __future__ import annotations

import json
import os

from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# A fitted map of at most MAP_BYTES (measured) becomes a local relation and is
# broadcast in the lookup join; a larger one stays distributed and is joined by
# a shuffle, which the adaptive planner may still turn into a broadcast.
MAP_BYTES = 8 << 20
BROADCAST_ROWS = 1_000_000  # rows noted for a map within MAP_BYTES never exceed this


class HasInputCols(Params):
    inputCols = Param(Params._dummy(), "inputCols", "input columns", TypeConverters.toListString)

    def getInputCols(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class HasState(Params):
    """Small fitted state (a few numbers per column) kept as a JSON param so the
    default param writer persists it."""

    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)

    def _state(self) -> dict:
        return json.loads(self.getOrDefault(self.state)) if self.isDefined(self.state) else {}


def small_rows(held: DataFrame) -> list | None:
    """The rows of a materialised frame if they measure at most MAP_BYTES, else None."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in held.schema.fields if f.dataType.simpleString() == "string"]
    width = sum(text, F.lit(16 * len(held.columns)))
    size = held.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]
    return held.collect() if size <= MAP_BYTES else None


def settle_map(mapping: DataFrame) -> tuple[DataFrame, int]:
    """Materialise a fitted map and note its rows: local if it measures at most MAP_BYTES, else distributed."""
    held = cut_lineage(mapping)
    rows = small_rows(held)
    if rows is not None:
        return mapping.sparkSession.createDataFrame(rows, mapping.schema), len(rows)
    return held, max(held.count(), BROADCAST_ROWS + 1)


def lookup(df: DataFrame, mapping: DataFrame, n_rows: int, on_left, on_right) -> DataFrame:
    """Left lookup join; broadcast only when the map was measured to be small at
    fit time, otherwise a regular shuffle join."""
    right = F.broadcast(mapping) if n_rows <= BROADCAST_ROWS else mapping
    return df.join(right, on_left == on_right, "left")


def lookup_all(df: DataFrame, mapping: DataFrame, n_rows: int, keys: dict[str, Column], value: str) -> DataFrame:
    """Left lookup of several columns in one map keyed by (column_name, value): adds ``__got_<name>`` for every entry
    of ``keys`` (name -> text expression), null where the map has no such value.

    A map that was measured to be small is broadcast: one hash probe a column inside one stage, no shuffle. A larger
    one is joined once for all columns: rows get a number and are settled, their (row, column, value) triples meet the
    map, and what was found comes back by the row's number. Null values take no part in that join, and a hot value is
    a run of slim triples, which the adaptive planner splits.
    """
    got = {c: f"__got_{c}" for c in keys}
    if n_rows <= BROADCAST_ROWS or df.isStreaming:
        out = df
        for c, key in keys.items():
            own = mapping.where(F.col("column_name") == c).select(F.col("value").alias("__value"), F.col(value).alias(got[c]))
            out = lookup(out, own, n_rows, key, F.col("__value")).drop("__value")
        return out
    held = cut_lineage(df.withColumn("__row", F.monotonically_increasing_id()))
    triples = held.select("__row", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), key.alias("value")) for c, key in keys.items()])).alias("kv"))
    found = (triples.select("__row", "kv.*").where(F.col("value").isNotNull())
             .join(mapping.select("column_name", "value", F.col(value).alias("__got")), ["column_name", "value"])
             .groupBy("__row").agg(*[F.max(F.when(F.col("column_name") == c, F.col("__got"))).alias(got[c]) for c in keys]))
    return held.join(found, "__row", "left").drop("__row")


def fit_stage(stage, df: DataFrame):
    """A fitted stage and its output on the rows it was fitted on. A stage with ``fitTransform`` gives its training rows
    other values than ``transform`` would (statistics that leave a row's own target out)."""
    if isinstance(stage, Transformer):
        return stage, stage.transform(df)
    if hasattr(stage, "fitTransform"):
        return stage.fitTransform(df)
    model = stage.fit(df)
    return model, model.transform(df)


def widest_nominal(df: DataFrame, features_col: str) -> int:
    """The largest number of values of a nominal slot of a vector column, from its metadata (no job)."""
    if features_col not in df.columns:
        return 0
    slots = df.schema[features_col].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
    return max([len(a["vals"]) if "vals" in a else int(a.get("num_vals", 0)) for a in slots], default=0)


def fit_learner(learner, df: DataFrame):
    """Fit the last stage; a tree gets as many bins as its widest native category needs."""
    if learner.hasParam("maxBins"):
        needed = widest_nominal(df, learner.getOrDefault("featuresCol"))
        if needed > learner.getOrDefault("maxBins"):
            learner = learner.copy({learner.getParam("maxBins"): needed})
    return learner.fit(df)


class CrossFitPipeline(Pipeline):
    """A Pipeline that trains on ``fitTransform`` where a stage has one and sizes tree bins by the fitted categories."""

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        fitted, stages = [], self.getStages()
        last = max((i for i, s in enumerate(stages) if not isinstance(s, Transformer)), default=-1)
        for i, stage in enumerate(stages):
            if i < last:
                model, dataset = fit_stage(stage, dataset)
            else:
                model = fit_learner(stage, dataset) if i == last else stage
            fitted.append(model)
        return PipelineModel(fitted)


class MapModelWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sc)
        self.instance.mapping.write.mode("overwrite").parquet(os.path.join(path, "data"))


class MapModelReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sc)
        inst = self.cls()
        inst._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(inst, metadata)
        inst.mapping = self.sparkSession.read.parquet(os.path.join(path, "data"))
        return inst


class MapModel(Model, HasInputCols, HasState, MLWritable, MLReadable):
    """A fitted stage whose state is a DataFrame map, saved under ``data/``."""

    mapping: DataFrame | None = None

    def write(self):
        return MapModelWriter(self)

    @classmethod
    def read(cls):
        return MapModelReader(cls)


__all__ = ["Estimator", "Model", "Transformer", "DefaultParamsReadable", "DefaultParamsWritable",
           "HasInputCols", "HasState", "MapModel", "settle_map", "lookup", "lookup_all", "fit_stage",
           "fit_learner", "CrossFitPipeline", "small_rows", "BROADCAST_ROWS", "MAP_BYTES"]

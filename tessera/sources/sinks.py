"""Sinks: tables (S7, S8), run log (S9, S14), model store."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Distributed write; the writer creates directories."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


RUN_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("experiment_name", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("model_params", T.MapType(T.StringType(), T.StringType())),
])


class RunLog:
    """Append-only experiment log (one JSON line per run).

    Appends are new files, so concurrent writers never rewrite each other's
    runs and a corrupt line only affects itself (PERMISSIVE read).
    """

    def __init__(self, path: str):
        self.path = path

    def append(self, spark: SparkSession, experiment_name: str, metrics: dict,
               model_params: dict | None = None) -> str:
        run_id = str(uuid.uuid4())
        clean_metrics = {k: float(v) for k, v in metrics.items() if _is_number(v)}
        params = {k: v if isinstance(v, str) else json.dumps(v, default=str)
                  for k, v in (model_params or {}).items()}
        row = spark.createDataFrame(
            [(run_id, experiment_name, clean_metrics, params)],
            "run_id string, experiment_name string, metrics map<string,double>, model_params map<string,string>",
        ).withColumn("timestamp", F.current_timestamp())
        row.select(*RUN_LOG_SCHEMA.fieldNames()).coalesce(1).write.mode("append").json(self.path)
        return run_id

    def read(self, spark: SparkSession) -> DataFrame:
        return (spark.read.schema(RUN_LOG_SCHEMA).option("mode", "PERMISSIVE").json(self.path)
                .where(F.col("run_id").isNotNull()).orderBy("timestamp", "run_id"))


def _is_number(v) -> bool:
    return isinstance(v, (int, float)) and not isinstance(v, bool)


def save_model(model: PipelineModel, path: str) -> None:
    """All fitted stages (fills, encoders, scaler, learner) in one place."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """S11."""
    return PipelineModel.load(path)


def model_family(model) -> str:
    """Family of the last stage, by class name."""
    from ..operators.classes import learner_stage
    stage = learner_stage(model)
    if type(stage).__name__ == "OneVsRestModel":
        stage = stage.models[0]
    name = type(stage).__name__.lower()
    for key, family in (("gbt", "gbt"), ("randomforest", "randomforest"), ("decisiontree", "decisiontree"),
                        ("linearregression", "linear"), ("logisticregression", "logistic"),
                        ("multilayerperceptron", "mlp"), ("mlp", "mlp")):
        if key in name:
            return family
    return "unknown"

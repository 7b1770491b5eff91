"""Streaming scoring: every fitted stage is a per-row map, so a PipelineModel
applies unchanged to a ``readStream`` frame (no state, no watermark)."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def stream_scores(spark: SparkSession, model: PipelineModel, source_dir: str, schema: StructType,
                  keep: list[str], fmt: str = "parquet", max_files_per_trigger: int = 1,
                  glob: str | None = None) -> DataFrame:
    """Score files as they land in ``source_dir`` (optionally only names
    matching ``glob``)."""
    reader = spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    stream = reader.load(source_dir)
    return model.transform(stream).select(*keep, F.col("prediction").alias("Predicted_Value"))


def stream_table_scores(spark: SparkSession, model: PipelineModel, path: str, schema: StructType, keep: list[str],
                        fmt: str = "parquet") -> DataFrame:
    """Score one table as a stream, stored as a folder of part files or as a single file."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        return stream_scores(spark, model, path, schema, keep, fmt)
    folder, name = path.rsplit("/", 1)
    return stream_scores(spark, model, folder, schema, keep, fmt, glob=name)


def run_to_files(scored: DataFrame, out: str, checkpoint: str) -> DataFrame:
    """Run the stream over all that has landed and read the file sink's result. Both folders must be shared by the
    executors; the checkpoint makes a restarted run go on where the last one stopped."""
    q = (scored.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return scored.sparkSession.read.schema(scored.schema).parquet(out)


def run_to_table(scored: DataFrame, table_name: str, checkpoint: str):
    """Drive the stream to completion into an in-memory table (tests)."""
    q = (scored.writeStream.format("memory").queryName(table_name).outputMode("append")
         .option("checkpointLocation", checkpoint).start())
    q.processAllAvailable()
    q.stop()
    return q

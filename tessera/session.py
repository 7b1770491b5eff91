"""Session helpers: one place that decides engine settings."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def get_spark(app: str = "tessera", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Return the active session, or build a local one for tests/bench.

    On a cluster the session comes from spark-submit and this only returns it.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.appName(app)
        .master(master or f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Unset is an error on a cluster: a machine-local folder would scatter the
    files over the executors. Only a local master gets a scratch folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    configured = tempfile.mkdtemp(prefix="tessera-ckpt-")
    spark.conf.set("spark.checkpoint.dir", configured)
    return configured


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the SparkContext at the shared checkpoint folder and return it."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return shared_dir(spark)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def kept(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` held on the executors (memory, then disk) while several jobs read it; rows the caller already holds stay
    the caller's. A frame made from it that is first run later computes its rows again."""
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        yield df
        return
    held = df.persist()
    try:
        yield held
    finally:
        held.unpersist()


def settle(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Unlike ``checkpoint`` the files are columnar and compressed, later scans
    prune columns, and joins on the table start from plain scans, which lets
    the adaptive planner split skewed keys.
    """
    path = f"{shared_dir(df.sparkSession)}/settled-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete settled tables that no later read needs."""
    for table in tables:
        for path in {f.rsplit("/settled-", 1)[0] + "/settled-" + f.rsplit("/settled-", 1)[1].split("/")[0]
                     for f in table.inputFiles() if "/settled-" in f}:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)

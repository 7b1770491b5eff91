"""Small helpers of the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, settle  # noqa: F401  (re-exported for the operators)


SLICE_BYTES = 4 << 20  # a function sees about so much of a batch at a time, which bounds its memory


WORKER_CACHES: list[dict] = []  # what a worker keeps from task to task of one stage
_STAGE = [""]


def enter_stage(stage: str) -> None:
    """Called by tasks first: a worker that comes from another stage drops what it kept there."""
    if _STAGE[0] != stage:
        _STAGE[0] = stage
        for cache in WORKER_CACHES:
            cache.clear()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads: ``doc_id`` and UTF-8 ``text`` bytes (null: empty)."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], dict], schema: str) -> DataFrame:
    """``mapInArrow`` for functions that turn one batch into named columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    names = [f.name for f in _parse_datatype_string(schema).fields]
    types = [f.type for f in to_arrow_schema(_parse_datatype_string(schema))]
    stage = uuid.uuid4().hex

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter_stage(stage)
        for whole in batches:
            step = max(1, whole.num_rows // (whole.nbytes // SLICE_BYTES + 1))
            for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                cols = fn(batch)
                yield pa.RecordBatch.from_arrays(
                    [cols[n] if isinstance(cols[n], pa.Array) else pa.array(cols[n], type=t)
                     for n, t in zip(names, types)], names=names)
        pa.default_memory_pool().release_unused()  # the worker lives on into other stages

    return df.mapInArrow(run, schema)


def sorted_runs(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Regroup sorted batches so that no run of equal ``key`` values spans two of them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        k = batch.column(key).to_numpy(zero_copy_only=False)
        cut = int(np.searchsorted(k, k[-1], side="left"))
        if cut:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        elif held and held[-1].column(key)[-1].as_py() != k[0]:
            yield pa.Table.from_batches(held)
            held = [batch]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)

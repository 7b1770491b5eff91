"""Connected components of a distributed edge list (large-star / small-star)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, settle


def _forest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replace a batch's edges by stars (node -> smallest node) of the same connectivity."""
    for batch in batches:
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.setdefault(x, x)) != x:
                root[x] = x = root.setdefault(up, up)
            return x

        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = find(a), find(b)
            if a != b:
                root[max(a, b)] = min(a, b)
        pairs = [(n, find(n)) for n in list(root)]
        pairs = [p for p in pairs if p[0] != p[1]]
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()),
                                          pa.array([p[1] for p in pairs], pa.int64())], names=["u", "v"])


def connected_components(edges: DataFrame) -> DataFrame:
    """Edges ``(u, v)`` of longs -> ``(node, component)`` for every node on an edge; component is its smallest node.

    Alternates the two star operations until the edge list no longer changes.
    Every step is a grouped minimum (combined map-side, so a hub is one partial
    row per task) and an equality join between settled tables. Repeated edges
    and loops are harmless; an empty list gives no rows.
    """
    spark = edges.sparkSession
    now = settle(edges.select(F.col("u").cast("long"), F.col("v").cast("long")).where("u <> v")
                 .mapInArrow(_forest, "u long, v long").distinct())
    state = None
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = settle(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")))
        large = settle(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .where("u <> v").distinct())
        low2 = settle(large.groupBy("u").agg(F.min("v").alias("m")))
        small = settle(large.join(low2, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                       .union(low2.select("u", F.col("m").alias("v"))).distinct())
        new = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(spark, now, low, large, low2)
        now = small
        if new == state:
            break
        state = new
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())

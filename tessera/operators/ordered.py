"""Distributed ordered prefix sums and ranks.

A global ``Window.orderBy`` without ``partitionBy`` (or one over a hot key)
pulls every row into one task. Here the rows are range-partitioned on
(partition keys, order keys) instead, so a hot key is spread over several
range partitions; each partition computes local prefixes, and a carry-in per
(range partition, key) adds the totals of earlier partitions. Only keys at a
partition's first or last position can span partitions, so the carry table
has at most 2 x P rows and is broadcast with that bound.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

_PID = "__pid"


PARTITION_BYTES = 128 << 20  # of the tables read
UNKNOWN_SIZE = 1 << 60  # what the planner gives for tables it cannot measure lies above


def read_bytes(df: DataFrame) -> int:
    """Bytes of the tables behind ``df``, as the planner measures its leaves (a leaf of unknown size counts nothing).

    The estimate of the whole plan is no use here: for joins it is a product."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    return sum(s for s in sizes if s < UNKNOWN_SIZE)


def _num_partitions(df: DataFrame, requested: int | None) -> int:
    """At least ``spark.sql.shuffle.partitions``, and so many more that a range holds about ``PARTITION_BYTES``."""
    if requested:
        return int(requested)
    least = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return max(least, read_bytes(df) // PARTITION_BYTES)


def ordered_prefix(df: DataFrame, order_by: Sequence[str], sums: Mapping[str, Column],
                   partition_by: Sequence[str] = (), inclusive: bool = True,
                   num_partitions: int | None = None) -> DataFrame:
    """Add one column per ``sums`` entry: the running sum of that expression
    over rows ordered by ``order_by`` within ``partition_by``.

    ``inclusive=False`` sums strictly earlier rows only (0 for the first).
    Ties in ``order_by`` are broken arbitrarily: pass a unique key last.
    """
    pcols, ocols = list(partition_by), list(order_by)
    names = list(sums)
    vals = {f"__v{i}": F.coalesce(e.cast("double"), F.lit(0.0)) for i, e in enumerate(sums.values())}
    p = _num_partitions(df, num_partitions)
    d = (df.withColumns(vals)
         .repartitionByRange(p, *[F.col(c).asc_nulls_first() for c in pcols + ocols])
         .withColumn(_PID, F.spark_partition_id()))
    # Pin the range-partition ids: later jobs must see the same assignment.
    d = cut_lineage(d)

    if pcols:
        key = F.struct(*[F.col(c) for c in pcols])
        edges = d.groupBy(_PID).agg(F.min(key).alias("__lo"), F.max(key).alias("__hi"))
        on_edge = d.join(F.broadcast(edges), _PID).where(
            F.col("__lo").eqNullSafe(key) | F.col("__hi").eqNullSafe(key))
        totals = on_edge.groupBy(_PID, *pcols).agg(*[F.sum(v).alias(v) for v in vals])
        carry_w = Window.partitionBy(*pcols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    else:
        totals = d.groupBy(_PID).agg(*[F.sum(v).alias(v) for v in vals])
        carry_w = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)  # <= P rows
    carry = totals.select(_PID, *pcols, *[F.coalesce(F.sum(v).over(carry_w), F.lit(0.0)).alias(f"__c{v}")
                                         for v in vals])

    cond = reduce(lambda a, b: a & b,
                  [d[_PID] == carry[_PID]] + [d[c].eqNullSafe(carry[c]) for c in pcols])
    joined = d.join(F.broadcast(carry), cond, "left").select(d["*"], *[carry[f"__c{v}"] for v in vals])
    frame = (Window.unboundedPreceding, 0) if inclusive else (Window.unboundedPreceding, -1)
    local_w = Window.partitionBy(_PID, *pcols).orderBy(*ocols).rowsBetween(*frame)
    out = joined.withColumns({
        name: F.coalesce(F.sum(v).over(local_w), F.lit(0.0)) + F.coalesce(F.col(f"__c{v}"), F.lit(0.0))
        for name, v in zip(names, vals)
    })
    return out.drop(_PID, *vals, *[f"__c{v}" for v in vals])


def global_rank(df: DataFrame, order_by: Sequence[str], name: str = "rank",
                partition_by: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """1-based ``row_number`` over ``order_by`` (within ``partition_by``), distributed."""
    out = ordered_prefix(df, order_by, {name: F.lit(1)}, partition_by, True, num_partitions)
    return out.withColumn(name, F.col(name).cast("long"))


def dense_codes(df: DataFrame, col: str, name: str = "code", num_partitions: int | None = None) -> DataFrame:
    """Distinct non-null values of ``col`` with 0-based codes in ascending order."""
    distinct = df.select(col).where(F.col(col).isNotNull()).distinct()
    ranked = global_rank(distinct, [col], name, num_partitions=num_partitions)
    return ranked.withColumn(name, F.col(name) - 1)

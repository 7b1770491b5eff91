"""Exact quantiles without a single-task value map.

Spark's exact ``percentile`` keeps a value->count map per group and merges it
in one task, so its memory grows with the number of distinct values. Here
each needed order statistic (0-based rank r of a column) is found by
bracketing instead:

1. One pass counts rows and (approximately) distinct values per column.
2. While a bracket may hold more than ``DISTINCT_LIMIT`` distinct values,
   ``percentile_approx`` over the rows inside it (rank error <= size/accuracy;
   ``when`` masks the rows, so one aggregate serves all targets) proposes a
   narrower bracket; one counting pass checks it (rows below, rows inside,
   distinct inside). A bracket that missed its rank is kept and the accuracy
   grows.
3. Final pass: (value, count) pairs inside each bracket, a running count
   within each bracket (a window partitioned by bracket, so one task holds at
   most one bracket's distinct values), and the value whose running count
   passes the rank. Only one value per target reaches the driver.

Quantiles interpolate linearly between order statistics (pandas, Spark
``percentile`` and DuckDB ``quantile_cont`` rule). Nulls and NaN are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DISTINCT_LIMIT = 2_000_000
APPROX_ACCURACY = 10_000


def _positions(n: int, p: float) -> tuple[int, int, float]:
    pos = (n - 1) * p
    lo = math.floor(pos)
    return lo, min(lo + 1, n - 1), pos


def _valid(x):
    return x.isNotNull() & ~F.isnan(x)


def order_statistics(df: DataFrame, cols: Sequence[str], ranks: dict[str, set[int]],
                     counts: dict[str, int], distinct: dict[str, int]) -> dict[tuple[str, int], float]:
    """Exact values at 0-based ``ranks`` (ascending order) of each column."""
    # per (column, rank): [lower bound, upper bound (inclusive), rows below, rows inside, distinct inside]
    state = {(c, r): [None, None, 0, counts[c], distinct[c]] for c in cols for r in ranks[c]}
    accuracy = APPROX_ACCURACY
    x = {c: F.col(c).cast("double") for c in cols}

    def inside(key):
        c, _ = key
        lo, hi = state[key][0], state[key][1]
        cond = _valid(x[c])
        if lo is not None:
            cond = cond & (x[c] >= F.lit(lo))
        if hi is not None:
            cond = cond & (x[c] <= F.lit(hi))
        return cond

    while True:  # narrower each round; once the accuracy passes the row count a proposal is exact
        wide = [k for k, st in state.items() if st[4] > DISTINCT_LIMIT and (st[0] is None or st[0] < st[1])]
        if not wide:
            break
        eps = 2.0 / accuracy
        aggs = []
        for i, key in enumerate(wide):
            c, r = key
            below, size = state[key][2], state[key][3]
            q = (r - below) / max(size - 1, 1)
            aggs.append(F.percentile_approx(F.when(inside(key), x[c]),
                                            [max(q - eps, 0.0), min(q + eps, 1.0)], accuracy).alias(f"b{i}"))
        bounds = df.agg(*aggs).first()
        cand = {key: bounds[f"b{i}"] for i, key in enumerate(wide)}
        checks = []
        for i, key in enumerate(wide):
            c, _ = key
            new_lo, new_hi = cand[key]
            cond, keep = inside(key), (x[c] >= F.lit(new_lo)) & (x[c] <= F.lit(new_hi))
            checks += [F.count_if(cond & (x[c] < F.lit(new_lo))).alias(f"below{i}"),
                       F.count_if(cond & keep).alias(f"size{i}"),
                       F.approx_count_distinct(F.when(cond & keep, x[c])).alias(f"d{i}")]
        got = df.agg(*checks).first()
        missed = False
        for i, key in enumerate(wide):
            _, r = key
            nb, ns = state[key][2] + got[f"below{i}"], got[f"size{i}"]
            if nb <= r < nb + ns:
                state[key] = [cand[key][0], cand[key][1], nb, ns, got[f"d{i}"]]
            else:
                missed = True
        if missed:
            accuracy *= 10

    # One exploded copy per distinct bracket (targets often share one).
    brackets: dict[tuple, int] = {}
    for key, st in state.items():
        brackets.setdefault((key[0], st[0], st[1], st[2]), len(brackets))
    spark = df.sparkSession
    targets = spark.createDataFrame(
        [(brackets[(key[0], st[0], st[1], st[2])], key[0], int(key[1])) for key, st in state.items()],
        "b int, c string, r long")
    first_key = {b: next(k for k, st in state.items() if (k[0], st[0], st[1], st[2]) == bk)
                 for bk, b in brackets.items()}
    pairs = [F.when(inside(first_key[b]), F.struct(F.lit(b).alias("b"), F.lit(bk[3]).cast("long").alias("below"),
                                                    x[bk[0]].alias("v")))
             for bk, b in brackets.items()]
    exploded = df.select(F.explode(F.array(*pairs)).alias("e")).where(F.col("e").isNotNull()).select("e.*")
    counted = exploded.groupBy("b", "below", "v").agg(F.count(F.lit(1)).alias("cnt"))
    w = Window.partitionBy("b").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    running = counted.withColumn("seen", F.col("below") + F.sum("cnt").over(w))
    # targets are few (a handful per column): broadcast, equi-join on bracket, range condition on the count.
    hit = running.join(F.broadcast(targets), (running.b == targets.b) & (running.seen > targets.r)
                       & (running.seen - running.cnt <= targets.r))
    return {(row["c"], row["r"]): row["v"] for row in hit.select("c", "r", "v").collect()}


def quantiles(df: DataFrame, cols: Iterable[str], probs: Sequence[float]) -> dict[str, list[float | None]]:
    """Exact linear-interpolated quantiles of each column (one count pass,
    a few bracketing passes only for big inputs, one bounded fetch)."""
    return quantiles_with(df, cols, probs)[0]


def quantiles_with(df: DataFrame, cols: Iterable[str], probs: Sequence[float], extra_aggs: Sequence = ()):
    """As ``quantiles``; ``extra_aggs`` (aliased aggregate Columns) ride along
    in the first counting pass and come back as a Row."""
    cols = list(cols)
    probs = [float(p) for p in probs]
    if not cols:
        return {}, (df.agg(*extra_aggs).first() if extra_aggs else None)
    x = {c: F.col(c).cast("double") for c in cols}
    row = df.agg(*[F.count_if(_valid(x[c])).alias(f"n_{c}") for c in cols],
                 *[F.approx_count_distinct(F.when(_valid(x[c]), x[c])).alias(f"d_{c}") for c in cols],
                 *extra_aggs).first()
    counts = {c: int(row[f"n_{c}"]) for c in cols}
    distinct = {c: int(row[f"d_{c}"]) for c in cols}
    ranks = {c: ({r for p in probs for r in _positions(counts[c], p)[:2]} if counts[c] else set()) for c in cols}
    live = [c for c in cols if counts[c]]
    stats = order_statistics(df, live, ranks, counts, distinct) if live else {}
    result: dict[str, list[float | None]] = {}
    for c in cols:
        n = counts[c]
        vals: list[float | None] = []
        for p in probs:
            if n == 0:
                vals.append(None)
                continue
            lo, hi, pos = _positions(n, p)
            a, b = stats[(c, lo)], stats[(c, hi)]
            vals.append(a if hi == lo or pos == lo else a + (pos - lo) * (b - a))
        result[c] = vals
    return result, row

"""Binning (A14-A16, A20) and polynomial terms."""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stats import quantiles


def cut(x: str | Column, edges: Sequence[float], labels: Sequence[str] | None = None,
        include_lowest: bool = False) -> Column:
    """Right-closed bins ``(e[i], e[i+1]]``; outside -> null.

    Without labels the 0-based bin index is returned. Bucketizer is not used:
    it is left-closed.
    """
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    edges = [float(e) for e in edges]
    out = [F.lit(labels[i]) if labels else F.lit(i) for i in range(len(edges) - 1)]
    lo = (x >= edges[0]) if include_lowest else (x > edges[0])
    expr = None
    for i in range(len(edges) - 1):
        cond = (x <= edges[i + 1]) & (lo if i == 0 else F.lit(True))
        expr = F.when(cond, out[i]) if expr is None else expr.when(cond, out[i])
    return F.when(x.isNull() | ~lo, F.lit(None)).otherwise(expr)


def equal_width_bins(df: DataFrame, col: str, n_bins: int, out: str = "bin",
                     right_closed: bool = True) -> DataFrame:
    """A15 (right-closed) and A20 (left-closed, clipped): bin index 0..n-1.

    min/max come from one global aggregate and are applied as literals.
    """
    x = F.col(col).cast("double")
    r = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).first()
    mn = F.lit(r["mn"]).cast("double")
    w = (F.lit(r["mx"]).cast("double") - mn) / F.lit(float(n_bins))
    if right_closed:
        raw = F.ceil((x - mn) / w) - 1
    else:
        raw = F.floor((x - mn) / w)
    idx = F.when(w == 0, F.lit(0)).otherwise(F.least(F.greatest(raw, F.lit(0)), F.lit(n_bins - 1)))
    return df.withColumns({out: F.when(x.isNull(), F.lit(None)).otherwise(idx.cast("int")),
                           f"{out}_width": w, f"{out}_min": mn})


def quantile_edges(df: DataFrame, col: str, q: int) -> list[float]:
    """Exact linear-interpolated edges (0, 1/q, ..., 1) as pandas.qcut uses."""
    probs = [i / q for i in range(q + 1)]
    return quantiles(df, [col], probs)[col]


def qcut(df: DataFrame, col: str, q: int, labels: Sequence[str] | None = None, out: str = "bin",
         edges: Sequence[float] | None = None) -> DataFrame:
    """Quantile bins; edges must be distinct (pandas raises otherwise)."""
    edges = list(edges) if edges is not None else quantile_edges(df, col, q)
    if len(set(edges)) != len(edges):
        raise ValueError(f"bin edges are not unique: {edges}")
    return df.withColumn(out, cut(col, edges, labels, include_lowest=True))


def poly_terms(cols: Sequence[str], degree: int = 2, interaction_only: bool = False,
               include_bias: bool = False) -> list[tuple[str, Column]]:
    """Polynomial terms in the usual order (by degree, then lexicographic
    combination) with names ``a``, ``a^2``, ``a b``."""
    terms: list[tuple[str, Column]] = []
    if include_bias:
        terms.append(("1", F.lit(1.0)))
    for d in range(1, degree + 1):
        combos = (itertools.combinations(range(len(cols)), d) if interaction_only
                  else itertools.combinations_with_replacement(range(len(cols)), d))
        for combo in combos:
            counts: dict[int, int] = {}
            for i in combo:
                counts[i] = counts.get(i, 0) + 1
            name = " ".join(cols[i] if k == 1 else f"{cols[i]}^{k}" for i, k in counts.items())
            expr = None
            for i in combo:
                term = F.col(cols[i]).cast("double")
                expr = term if expr is None else expr * term
            terms.append((name, expr))
    return terms


def polynomial_features(df: DataFrame, cols: Sequence[str], degree: int = 2,
                        interaction_only: bool = False, include_bias: bool = False,
                        keep: Sequence[str] = ()) -> DataFrame:
    """A18 as a projection: ``keep`` columns plus one column per term."""
    terms = poly_terms(cols, degree, interaction_only, include_bias)
    return df.select(*keep, *[e.alias(n) for n, e in terms])

"""Linear models from sums of products.

One pass over the rows sums, per group (fold), the number of rows, the means
and the centred products of the feature vector and the label. Groups merge
exactly, so the moments of any training side are those of its folds together,
and every strength of every fold is solved from them without another pass:
ridge in closed form, lasso and elastic net by coordinate descent on the
products. The squared error on a held-out fold follows from its own moments.

Partial sums are merged on the cluster, a few dozen partitions at a time, until
few are left; the driver then holds ``folds`` matrices of (features + 1)**2.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDEST = 512  # features up to which products are summed (2 MB a group)
FAN_IN = 32
SCHEMA = "grp int, n long, mean binary, prod binary"
NAMES = ["grp", "n", "mean", "prod"]


@dataclass
class Moments:
    """Rows, means and centred products of (features, label); the label comes last."""

    n: int
    mean: np.ndarray
    prod: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        if not self.n or not other.n:
            return self if self.n else other
        n, step = self.n + other.n, other.mean - self.mean
        return Moments(n, self.mean + step * (other.n / n), self.prod + other.prod + np.outer(step, step) * (self.n * other.n / n))

    @classmethod
    def of(cls, rows: np.ndarray) -> Moments:
        mean = rows.mean(axis=0)
        centred = rows - mean
        return cls(len(rows), mean, centred.T @ centred)

    @classmethod
    def none(cls, width: int) -> Moments:
        return cls(0, np.zeros(width), np.zeros((width, width)))


def _rows(found: dict[int, Moments]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.int32()), pa.array([m.n for m in found.values()], pa.int64()),
         pa.array([m.mean.tobytes() for m in found.values()], pa.binary()),
         pa.array([m.prod.tobytes() for m in found.values()], pa.binary())], names=NAMES)


def _read(group: int, n: int, mean: bytes, prod: bytes) -> Moments:
    mean = np.frombuffer(mean)
    return Moments(n, mean, np.frombuffer(prod).reshape(len(mean), len(mean)))


def _sum_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, Moments] = {}
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column("grp").to_numpy()
        flat = batch.column("x").flatten().to_numpy(zero_copy_only=False)
        x = np.column_stack([flat.reshape(batch.num_rows, -1), batch.column("y").to_numpy(zero_copy_only=False)])
        for g in np.unique(group).tolist():
            m = Moments.of(x[group == g])
            found[g] = found[g] + m if g in found else m
    yield _rows(found)


def _merge(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: dict[int, Moments] = {}
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in NAMES)):
            m = _read(*row)
            found[row[0]] = found[row[0]] + m if row[0] in found else m
    yield _rows(found)


def fold_moments(df: DataFrame, group: str, features: str = "features", label: str = "label") -> dict[int, Moments]:
    """Moments of every value of the integer column ``group``, in one pass."""
    slim = df.select(F.col(group).cast("int").alias("grp"), vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"))
    parts = slim.mapInArrow(_sum_rows, SCHEMA)
    left = parts.rdd.getNumPartitions()
    while left > FAN_IN:
        left = -(-left // FAN_IN)
        parts = parts.repartition(left).mapInArrow(_merge, SCHEMA)
    out: dict[int, Moments] = {}
    for r in parts.collect():  # at most FAN_IN rows a group
        m = _read(r.grp, r.n, r["mean"], r.prod)
        out[r.grp] = out[r.grp] + m if r.grp in out else m
    return out


@dataclass
class LinearFit:
    coef: np.ndarray
    intercept: float


def solve(m: Moments, kind: str, alpha: float = 0.0, l1_ratio: float = 0.5, tol: float = 1e-12, rounds: int = 100_000) -> LinearFit:
    """Least squares with a free intercept: ``linear``, ``ridge`` (alpha * |b|^2), ``lasso`` and ``elasticnet``
    (alpha times the mixed penalty, with the squared error divided by twice the rows)."""
    xx, xy = m.prod[:-1, :-1], m.prod[:-1, -1]
    if kind in ("linear", "ridge"):
        a = xx + (alpha if kind == "ridge" else 0.0) * np.eye(len(xy))
        scale = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))  # equilibrated; a singular system gets its least solution
        b = np.linalg.lstsq(a / np.outer(scale, scale), xy / scale, rcond=None)[0] / scale
    else:
        b = _coordinate_descent(xx / m.n, xy / m.n, alpha, 1.0 if kind == "lasso" else l1_ratio, tol, rounds)
    return LinearFit(b, float(m.mean[-1] - m.mean[:-1] @ b))


def _coordinate_descent(xx: np.ndarray, xy: np.ndarray, alpha: float, l1_ratio: float, tol: float, rounds: int) -> np.ndarray:
    b = np.zeros(len(xy))
    l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
    slack = xy.copy()  # xy - xx @ b
    for _ in range(rounds):
        largest = 0.0
        for j in range(len(b)):
            if xx[j, j] + l2 <= 0:
                continue
            r = slack[j] + xx[j, j] * b[j]
            new = np.sign(r) * max(abs(r) - l1, 0.0) / (xx[j, j] + l2)
            if new != b[j]:
                slack -= xx[:, j] * (new - b[j])
                largest = max(largest, abs(new - b[j]) * xx[j, j] ** 0.5)
                b[j] = new
        if largest <= tol * max(1.0, float(np.abs(xy).max(initial=0.0))):
            break
    return b


def squared_error(m: Moments, fit: LinearFit) -> float:
    """Sum of squared errors of ``fit`` on the rows behind ``m``."""
    v = np.append(-fit.coef, 1.0)
    offset = float(m.mean @ v) - fit.intercept
    return max(float(v @ m.prod @ v), 0.0) + m.n * offset * offset


def score(m: Moments, fit: LinearFit, metric: str) -> float:
    """``rmse``, ``mse`` or ``r2`` of ``fit`` on the rows behind ``m``."""
    sse = squared_error(m, fit)
    if metric == "r2":
        return float(1 - sse / m.prod[-1, -1]) if m.prod[-1, -1] else float("nan")
    return float(sse / m.n if metric == "mse" else (sse / m.n) ** 0.5) if m.n else float("nan")

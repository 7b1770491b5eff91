"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are scaled to length one and rotated by a seeded random rotation; the
signs of the rotated components are the code, packed to bits. With the
correction scalar of a vector (the inner product of its code's point with the
vector itself) the packed bits give an unbiased estimate of its inner product
with a query, and an error bound that holds with high probability. A vector is
reranked on its original components only if its upper bound reaches the k-th
best score certain so far.

Index rows and queries meet in blocks: both sides are dealt to (data block,
query block) groups of bounded size, each group returns its k best per query,
and the k best of all groups remain.

Defined results: null vectors, zero vectors, vectors holding null or non-finite
components and rows with a null id take no part; vectors meet only vectors of
their own dimension; ties go to the smaller id; a repeated row counts once and
a query never meets rows of its own id; an empty table gives no rows; columns
other than the id and the vector are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, settle, table

EPSILON = 4.0  # half width of the error bound in standard deviations
DATA_BLOCK = 8192
QUERY_BLOCK = 2048
SEED = 4


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed + dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def encode(x: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign codes and correction scalars of unit vectors."""
    y = x @ rotation(x.shape[1], seed)
    return np.packbits(y > 0, axis=1), np.abs(y).sum(axis=1) / np.sqrt(x.shape[1])


def estimate(codes: np.ndarray, scalar: np.ndarray, queries: np.ndarray, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """Estimated inner products (rows: vectors, columns: unit queries) and each vector's error bound.

    A byte of a code selects the sum of its eight signed query components from a table of 256.
    """
    dim = queries.shape[1]
    y = queries @ rotation(dim, seed)
    y = np.pad(y, ((0, 0), (0, -dim % 8))).reshape(len(y), -1, 8)
    signs = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1
    tables = np.einsum("qjb,vb->jvq", y.astype(np.float32), signs)
    total = np.zeros((len(codes), len(y)), np.float32)
    for j in range(codes.shape[1]):
        total += tables[j][codes[:, j]]
    bound = EPSILON * np.sqrt(np.maximum(1 - scalar ** 2, 0)) / scalar / np.sqrt(max(dim - 1, 1))
    return total / np.sqrt(dim) / scalar[:, None].astype(np.float32), bound


def build_index(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", seed: int = SEED) -> DataFrame:
    """``(vec_id, dim, vector, code, scalar)`` of every usable row; ``vector`` holds the original components as doubles."""
    v = F.col("v")
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
            .where(~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))))
            .where(F.exists(v, lambda x: x != 0)).withColumn("dim", F.size(v)))

    def run(batch: pa.RecordBatch) -> dict:
        dims = batch.column("dim").to_numpy()
        lists = batch.column("v")
        flat, ends = lists.flatten().to_numpy(), np.cumsum(dims)
        vector, code, scalar = [None] * len(dims), [None] * len(dims), np.zeros(len(dims))
        for d in np.unique(dims).tolist():
            at = np.flatnonzero(dims == d)
            x = flat[(ends[at] - d)[:, None] + np.arange(d)]
            unit = x / np.abs(x).max(axis=1, keepdims=True)
            c, s = encode(unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True)), seed)
            scalar[at] = s
            for k, i in enumerate(at.tolist()):
                vector[i], code[i] = x[k].tobytes(), c[k].tobytes()
        return {"vec_id": batch.column("vec_id"), "dim": batch.column("dim"), "vector": vector, "code": code, "scalar": scalar}

    return arrow_map(rows, run, "vec_id long, dim int, vector binary, code binary, scalar double").dropDuplicates(["vec_id", "vector"])


def _matrix(column: pa.ChunkedArray, dtype: str, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(n, -1)


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision; scaled first so that squares neither overflow nor vanish."""
    a = a / np.abs(a).max(axis=1, keepdims=True)
    b = b / np.abs(b).max(axis=1, keepdims=True)
    return (a * b).sum(axis=1) / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))


def _search(k: int, seed: int):
    def run(data: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        n, m = data.num_rows, queries.num_rows
        if n and m:
            ids, qids = data.column("vec_id").to_numpy(), queries.column("vec_id").to_numpy()
            x, q = _matrix(data.column("vector"), "<f8", n), _matrix(queries.column("vector"), "<f8", m)
            codes, scalar = _matrix(data.column("code"), "u1", n), data.column("scalar").to_numpy()
            unit = q / np.abs(q).max(axis=1, keepdims=True)
            unit /= np.sqrt((unit * unit).sum(axis=1, keepdims=True))
            for b in range(0, m, 64):
                est, bound = estimate(codes, scalar, unit[b:b + 64], seed)
                for j in range(est.shape[1]):
                    other = np.flatnonzero(ids != qids[b + j])
                    if not len(other):
                        continue
                    e, w = est[other, j], bound[other]
                    lead = other[np.argpartition(-e, min(4 * k, len(e) - 1))[:4 * k]]
                    sure = np.sort(cosine(x[lead], q[b + j:b + j + 1]))[::-1]
                    least = sure[k - 1] if len(sure) >= k else -np.inf
                    near = other[e + w >= least - 1e-4]
                    score = cosine(x[near], q[b + j:b + j + 1])
                    best = np.lexsort((ids[near], -score))[:k]
                    out.append((np.full(len(best), qids[b + j]), ids[near][best], score[best]))
        cols = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0)] * 3
        return pa.table({name: pa.array(c, t) for name, c, t in
                         zip(("query_id", "vec_id", "score"), cols, (pa.int64(), pa.int64(), pa.float64()))})

    return run


def nearest(index: DataFrame, queries: DataFrame, k: int = 5, seed: int = SEED) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest cosine for every query (both in index form)."""
    n, m = index.count(), queries.count()
    blocks, asked = max(1, -(-n // DATA_BLOCK)), max(1, -(-m // QUERY_BLOCK))
    data = (index.withColumn("g", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
            .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(asked - 1)))))
    ask = (queries.withColumn("b", F.pmod(F.xxhash64("vec_id"), F.lit(asked)).cast("int"))
           .withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long")))))
    key = ["dim", "g", "b"]
    found = (data.groupBy(*key).cogroup(ask.groupBy(*key))
             .applyInArrow(_search(k, seed), "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op4_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = settle(build_index(table(spark, sf_dir, "embeddings")))
    return nearest(index, index.where("vec_id % 50 = 0"))


ORACLE = """
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(v.e, q.e) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY list_cosine_similarity(v.e, q.e) DESC, v.vec_id) AS rank
  FROM (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE vec_id % 50 = 0) q
  JOIN (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings) v ON v.vec_id <> q.vec_id)
WHERE rank <= 5
"""

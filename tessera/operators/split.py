"""Deterministic splits and folds.

Order is md5('seed:id'), the same in Spark and any SQL engine; a null id
hashes as the empty string. Splits and training folds of exact sizes need only
a few order statistics of the hash (``hash_cuts``); rows that share an id
follow each other in an order of their own (a hash of the whole row), so sizes
stay exact when ids are null or repeat. Only rows equal in all columns cannot
be told apart and fall on one side. Folds defined by a rank sort distinct
(id, hash) pairs alone: the rows of an id share its fold, those without an id
count as one more id, and no row is lost. ``hash_split`` and ``hash_folds``
have expected sizes only.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .boosting import hash_order_key, row_tie
from .ordered import global_rank


FULL = 48  # hex digits of a hash with its tie


def _hash_and_tie(df: DataFrame, id_col: str, seed: int) -> F.Column:
    return F.concat(hash_order_key(id_col, seed), row_tie(df))


def hash_cuts(hashed: DataFrame, ranks_of) -> tuple[int, dict[int, str]]:
    """Exact order statistics of the hash column ``__h`` (up to ``FULL`` hex digits) without sorting rows.

    ``ranks_of(n)`` lists 1-based ranks. Each pass counts rows per hash prefix
    (three hex digits more each time, at most 4096 rows back per open rank)
    until a rank's prefix holds few rows, which are then fetched.
    """
    width, few = 3, 4096
    counts = {r["p"]: r["n"] for r in hashed.groupBy(F.substring("__h", 1, width).alias("p")).agg(F.count("*").alias("n")).collect()}
    n = sum(counts.values())
    ranks = [r for r in dict.fromkeys(ranks_of(n)) if 1 <= r <= n]
    place = {r: ("", 0, n) for r in ranks}  # rank -> prefix, rows before it, rows in it
    found: dict[int, str] = {}
    while True:
        for r, (prefix, before, size) in place.items():
            for p in sorted(k for k in counts if k.startswith(prefix)):
                if before + counts[p] >= r:
                    place[r] = (p, before, counts[p])
                    break
                before += counts[p]
        found |= {r: p for r, (p, _, _) in place.items() if len(p) >= FULL}
        wide = {p for r, (p, _, size) in place.items() if size > few and r not in found}
        if not wide:
            break
        width += 3
        inside = hashed.where(F.substring("__h", 1, width - 3).isin(sorted(wide)))
        counts = {p: size for p, _, size in place.values() if p not in wide} | {
            r["p"]: r["n"] for r in inside.groupBy(F.substring("__h", 1, width).alias("p")).agg(F.count("*").alias("n")).collect()}
    for p in {p for r, (p, _, _) in place.items() if r not in found}:
        rows = sorted(r["__h"] for r in hashed.where(F.col("__h").startswith(p)).select("__h").collect())
        found |= {r: rows[r - before - 1] for r, (q, before, _) in place.items() if q == p}
    return n, found


def train_valid_split(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42,
                      out: str = "split") -> DataFrame:
    """The ceil(n * test_size) rows first in hash order are 'valid'.

    Only one number is needed, the hash of the last valid row; the split is
    then a map-side comparison (no shuffle of rows, nothing kept in memory)."""
    h = _hash_and_tie(df, id_col, seed)
    _, cuts = hash_cuts(df.select(h.alias("__h")), lambda n: [math.ceil(n * test_size)])
    valid = h <= F.lit(next(iter(cuts.values()))) if cuts else F.lit(False)
    return df.withColumn(out, F.when(valid, F.lit("valid")).otherwise(F.lit("train")))


def cut_folds(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """T2 for training: shuffled folds of exact sizes (the first n mod k hold one row more), each a range
    of the hash order between two exact cuts. No shuffle of rows."""
    h = _hash_and_tie(df, id_col, seed)

    def ends(n: int) -> list[int]:
        return [sum(n // k + (j < n % k) for j in range(i + 1)) for i in range(k - 1)]

    n, cuts = hash_cuts(df.select(h.alias("__h")), ends)
    above = [(h > F.lit(cuts[e])).cast("int") if e in cuts else F.lit(1) for e in ends(n)]
    fold = F.lit(0)
    for a in above:
        fold = fold + a
    return df.withColumn(out, fold.cast("int"))


def hash_split(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42, out: str = "split") -> DataFrame:
    """Rank-free split: first 15 hex digits of the hash as a uniform number."""
    u = F.conv(F.substring(hash_order_key(id_col, seed), 1, 15), 16, 10).cast("double") / F.lit(16.0 ** 15)
    return df.withColumn(out, F.when(u < F.lit(float(test_size)), F.lit("valid")).otherwise(F.lit("train")))


def _with_rank(df: DataFrame, id_col: str, order: F.Column, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``__r``, the 1-based rank by ``order`` (within ``partition_by``) of the row's id.

    Only distinct (id, keys) pairs are sorted, then joined back. Rows with a null id or key, however many, take no part
    in the join: their few ranks come as literals."""
    keys = [id_col, *partition_by]
    slim = df.select(*keys, order.alias("__h")).distinct()
    ranks = global_rank(slim, ["__h"], "__r", partition_by=partition_by).select(*[F.col(c).alias(f"__k_{c}") for c in keys], "__r")
    null_key = reduce(lambda a, b: a | b, [F.col(f"__k_{c}").isNull() for c in keys])
    cond = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"__k_{c}") for c in keys])
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys])
    known = df.where(whole).join(ranks.where(~null_key), cond)
    rest = ranks.where(null_key)
    if partition_by:  # a null id in any class, or any id in the null class
        spread = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__k_{c}")) for c in keys])
        lost = df.where(~whole).join(rest, spread)
    else:
        of_null = rest.select("__r").first()
        lost = df.where(~whole).withColumn("__r", F.lit(of_null[0] if of_null else None).cast("long"))
    return known.select(*df.columns, "__r").unionByName(lost.select(*df.columns, "__r"))


def kfold(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Shuffled k-fold: (rank of the id in hash order - 1) mod k."""
    ranked = _with_rank(df, id_col, hash_order_key(id_col, seed))
    return ranked.withColumn(out, ((F.col("__r") - 1) % k).cast("int")).drop("__r")


def contiguous_folds(df: DataFrame, id_col: str, k: int = 5, out: str = "fold") -> DataFrame:
    """T2b (regressors): unshuffled folds, contiguous in id order (null first); the first n mod k of the n distinct ids'
    folds hold one id more. Only the last id of each fold is fetched; no row moves."""
    ids = df.select(id_col).distinct()
    ranks = cut_lineage(global_rank(ids, [id_col], "__r"))
    n = ranks.count()
    q, rem = divmod(n, k)
    ends = [sum(q + (j < rem) for j in range(i + 1)) for i in range(k - 1)]
    last = {r["__r"]: r[id_col] for r in ranks.where(F.col("__r").isin([e for e in ends if e])).collect()}
    kind = df.schema[id_col].dataType
    fold = F.lit(0)
    for e in ends:
        if e == 0:
            above = F.lit(1)
        elif last[e] is None:  # the null id is the first of all
            above = F.col(id_col).isNotNull().cast("int")
        else:
            above = F.coalesce((F.col(id_col) > F.lit(last[e]).cast(kind)).cast("int"), F.lit(0))
        fold = fold + above
    return df.withColumn(out, fold.cast("int"))


def stratified_folds(df: DataFrame, id_col: str, label: str, k: int = 5, seed: int = 42,
                     out: str = "fold") -> DataFrame:
    """T2b (classifiers): within each class (null is one), (rank of the id in hash order - 1) mod k."""
    ranked = _with_rank(df, id_col, hash_order_key(id_col, seed), (label,))
    return ranked.withColumn(out, ((F.col("__r") - 1) % k).cast("int")).drop("__r")


def hash_folds(df: DataFrame, id_col: str, k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Rank-free folds: pmod(xxhash64(seed, id), k). No shuffle; fold sizes
    are expected values only (use at scales where an exact global rank is
    not worth a range shuffle)."""
    return df.withColumn(out, F.pmod(F.xxhash64(F.lit(seed), F.col(id_col)), F.lit(k)).cast("int"))

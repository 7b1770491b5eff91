"""Target-aware encoders (E7a/b, E8a/b/c, E9/W1)."""

from __future__ import annotations

import json
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.bins import cut
from ..functions.stats import quantiles
from .base import DefaultParamsReadable, DefaultParamsWritable, Estimator, HasInputCols, MapModel, lookup_all, settle_map
from .boosting import row_tie
from .ordered import ordered_prefix

# Tier labels, low to high, and the default for unseen values.
TIER_LABELS = ["Tier_3", "Tier_2", "Tier_1"]
TIER_DEFAULT = "Tier_2"
# Means and edges are compared at this many decimals so ties are stable.
TIE_DECIMALS = 9


def _unpivot(df: DataFrame, cols: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    return df.select(*extra, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols
    ])).alias("kv")).select("kv.column_name", "kv.value", *extra)


# --- E7: rare categories --------------------------------------------------------

class RareCategoryGrouper(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """E7a (version 1): values whose share (nulls out of the denominator) is
    below ``minFrequency`` become ``otherLabel``; unseen and null keep theirs.
    E7b (version 2): only common values are kept; anything else, unseen and
    null included, becomes ``otherLabel``."""

    minFrequency = Param(Params._dummy(), "minFrequency", "share threshold", TypeConverters.toFloat)
    version = Param(Params._dummy(), "version", "1 or 2", TypeConverters.toInt)
    otherLabel = Param(Params._dummy(), "otherLabel", "replacement label", TypeConverters.toString)

    # Default share thresholds of the two versions.
    DEFAULT_MIN_FREQUENCY = {1: 0.03, 2: 0.3}

    def __init__(self, inputCols: Sequence[str] | None = None, minFrequency: float | None = None, version: int = 1,
                 otherLabel: str = "Other"):
        super().__init__()
        self._setDefault(inputCols=[])
        if minFrequency is None:
            minFrequency = self.DEFAULT_MIN_FREQUENCY[version]
        self._set(minFrequency=float(minFrequency), version=version, otherLabel=otherLabel)
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def _fit(self, df: DataFrame) -> RareCategoryModel:
        cols = self.getInputCols()
        counts = (_unpivot(df, cols).where(F.col("value").isNotNull())
                  .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("cnt")))
        totals = counts.groupBy("column_name").agg(F.sum("cnt").alias("total"))
        shares = counts.join(F.broadcast(totals), "column_name").select(
            "column_name", "value", (F.col("cnt") / F.col("total") < F.lit(self.getOrDefault(self.minFrequency)))
            .alias("rare"))
        mapping, n = settle_map(shares)
        model = RareCategoryModel(cols, n, self.getOrDefault(self.version), self.getOrDefault(self.otherLabel))
        model.mapping = mapping
        return model


class RareCategoryModel(MapModel):
    version = Param(Params._dummy(), "version", "1 or 2", TypeConverters.toInt)
    otherLabel = Param(Params._dummy(), "otherLabel", "replacement label", TypeConverters.toString)

    def __init__(self, inputCols: Sequence[str] | None = None, n_rows: int = 0, version: int = 1,
                 otherLabel: str = "Other"):
        super().__init__()
        self._setDefault(inputCols=[], state="{}", version=1, otherLabel="Other")
        if inputCols is not None:
            self._set(inputCols=list(inputCols), state=json.dumps({"n_rows": n_rows}), version=version,
                      otherLabel=otherLabel)

    def _transform(self, df: DataFrame) -> DataFrame:
        other = F.lit(self.getOrDefault(self.otherLabel))
        cols = self.getInputCols()
        out = lookup_all(df, self.mapping, self._state().get("n_rows", 0), {c: F.col(c).cast("string") for c in cols}, "rare")
        exprs = {}
        for c in cols:
            rare, own = F.col(f"__got_{c}"), F.col(c).cast("string")
            if self.getOrDefault(self.version) == 2:
                exprs[c] = F.when(rare == F.lit(False), own).otherwise(other)
            else:
                exprs[c] = F.when(F.coalesce(rare, F.lit(False)), other).otherwise(own)
        return out.withColumns(exprs).drop(*[f"__got_{c}" for c in cols])


# --- E8: target tiers -----------------------------------------------------------

class TargetTierGrouper(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Mean target per value -> tertiles of those means -> Tier_3 (low),
    Tier_2, Tier_1 (high). ``smoothing`` m > 0 shrinks each mean towards the
    global mean: (n*mean + m*global)/(n + m) (E8b). Duplicate tertile edges
    send every value to Tier_2 (E8c). Transform adds ``{col}_Tier`` (unseen or
    null -> Tier_2) and drops the source column."""

    labelCol = Param(Params._dummy(), "labelCol", "target column", TypeConverters.toString)
    smoothing = Param(Params._dummy(), "smoothing", "prior weight m (0 = plain)", TypeConverters.toFloat)

    def __init__(self, inputCols: Sequence[str] | None = None, labelCol: str = "label", smoothing: float = 0.0):
        super().__init__()
        self._setDefault(inputCols=[])
        self._set(labelCol=labelCol, smoothing=float(smoothing))
        if inputCols is not None:
            self._set(inputCols=list(inputCols))

    def category_means(self, df: DataFrame) -> DataFrame:
        """(column_name, value, n, mean) with mean smoothed when m > 0.

        One grouped pass: groups keep the null value so the global prior
        (mean of all non-null targets) is the count-weighted mean of each
        column's groups; null values are dropped afterwards (pandas groupby).
        ``n`` counts non-null targets, as pandas ``agg('count')``.
        """
        y = self.getOrDefault(self.labelCol)
        m = self.getOrDefault(self.smoothing)
        long = _unpivot(df, self.getInputCols(), [y])
        target = F.col(y).cast("double")
        groups = long.groupBy("column_name", "value").agg(F.count(target).alias("n"), F.sum(target).alias("__s"),
                                                           F.avg(target).alias("mean"))
        if m > 0:
            prior = groups.groupBy("column_name").agg((F.sum("__s") / F.sum("n")).alias("__prior"))
            groups = groups.join(F.broadcast(prior), "column_name").withColumn(
                "mean", (F.col("n") * F.col("mean") + F.lit(m) * F.col("__prior")) / (F.col("n") + F.lit(m)))
        return groups.where(F.col("value").isNotNull()).select("column_name", "value", "n", "mean")

    def _fit(self, df: DataFrame) -> TargetTierModel:
        # One pass over the rows; the quantile passes below then read the
        # small per-category table (local or checkpointed), not ``df``.
        stats, _ = settle_map(self.category_means(df))
        parts, edges_by_col = [], {}
        for c in self.getInputCols():
            sc = stats.where(F.col("column_name") == c)
            edges = [round(e, TIE_DECIMALS) if e is not None else None
                     for e in quantiles(sc, ["mean"], [0, 1 / 3, 2 / 3, 1])["mean"]]
            edges_by_col[c] = edges
            if None in edges or len(set(edges)) < len(edges):
                tier = F.lit(TIER_DEFAULT)
            else:
                tier = cut(F.round("mean", TIE_DECIMALS), edges, TIER_LABELS, include_lowest=True)
            parts.append(sc.select("column_name", "value", tier.alias("tier")))
        mapping, n = settle_map(reduce(DataFrame.unionByName, parts))
        model = TargetTierModel(self.getInputCols(), n, edges_by_col)
        model.mapping = mapping
        return model


class TargetTierModel(MapModel):
    def __init__(self, inputCols: Sequence[str] | None = None, n_rows: int = 0, edges: dict | None = None):
        super().__init__()
        self._setDefault(inputCols=[], state="{}")
        if inputCols is not None:
            self._set(inputCols=list(inputCols), state=json.dumps({"n_rows": n_rows, "edges": edges or {}}))

    def _transform(self, df: DataFrame) -> DataFrame:
        cols = self.getInputCols()
        out = lookup_all(df, self.mapping, self._state().get("n_rows", 0), {c: F.col(c).cast("string") for c in cols}, "tier")
        tiers = {f"{c}_Tier": F.coalesce(F.col(f"__got_{c}"), F.lit(TIER_DEFAULT)) for c in cols}
        return out.withColumns(tiers).drop(*cols, *[f"__got_{c}" for c in cols])


# --- E9/W1: ordered target encoding ---------------------------------------------

def ordered_target_encode(df: DataFrame, cat: str, label: str, order_col: str, out: str,
                          prior_weight: float = 1.0, prior: float | None = None) -> DataFrame:
    """Each row's value is (sum of earlier targets in its category +
    w*prior) / (count of earlier rows + w), earlier by ``order_col``.

    The prefix statistics are distributed (range-partitioned prefix sums), so
    a hot category is split across tasks. Rows travel whole, once, and nothing
    is joined back: null order keys (first) and repeated ones lose or multiply
    no row. Rows of one key follow each other in an order of their own (a hash
    of the row); null targets count as rows of value 0.
    """
    if prior is None:
        prior = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    w = float(prior_weight)
    pre = ordered_prefix(df.drop(out).withColumn("__tie", row_tie(df)), [order_col, "__tie"], {"__sum": F.col(label), "__cnt": F.lit(1)},
                         partition_by=[cat], inclusive=False)
    coded = pre.withColumn(out, (F.col("__sum") + F.lit(w * prior)) / (F.col("__cnt") + F.lit(w)))
    return coded.select(*[c for c in df.columns if c != out], out)

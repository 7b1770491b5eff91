"""Column profiles (M7, G1-G8, G20-G23): each is one or two aggregate passes.

Many columns are profiled in a single ``agg`` and unpivoted afterwards, never
one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ops import row_sum
from ..functions.stats import quantiles, quantiles_with


def null_report(df: DataFrame, cols: Sequence[str] | None = None, warn_pct: float = 5.0) -> DataFrame:
    """M7: columns with nulls: count, percent, warning flag (> warn_pct)."""
    cols = list(cols or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    stacked = counts.select(
        "__n", F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
                                   for c in cols])).alias("s"))
    return (stacked.select("s.column_name", F.col("s.null_count").cast("long").alias("null_count"),
                           F.round(F.col("s.null_count") * 100.0 / F.col("__n"), 4).alias("null_pct"))
            .where(F.col("null_count") > 0)
            .withColumn("warn", F.col("null_pct") > F.lit(warn_pct)))


def describe(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (exact), max per column."""
    cols = list(cols)
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    # the moments ride along in the quantiles' first counting pass
    q, st = quantiles_with(df, cols, [0.25, 0.5, 0.75], aggs)
    rows = [(c, st[f"{c}__count"], st[f"{c}__mean"], st[f"{c}__std"], st[f"{c}__min"], q[c][0], q[c][1], q[c][2],
             st[f"{c}__max"]) for c in cols]
    return df.sparkSession.createDataFrame(
        rows, "column_name string, count long, mean double, std double, min double, p25 double, p50 double, "
              "p75 double, max double")


def value_shares(df: DataFrame, col: str) -> DataFrame:
    """Normalised value counts; nulls are left out of the denominator."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("cnt"))
    total = df.agg(F.count(col)).first()[0]  # non-null rows, one scalar
    return counts.select(col, "cnt", (F.col("cnt") / F.lit(float(total))).alias("share"))


def grouped_mean(df: DataFrame, key: str, value: str, name: str = "mean") -> DataFrame:
    """Mean by key, null keys dropped (pandas groupby)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(F.col(value).cast("double")).alias(name))


def grouped_count_mean(df: DataFrame, key: str, value: str) -> DataFrame:
    """Count and mean of value by key."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(value).alias("count"), F.avg(F.col(value).cast("double")).alias("mean")))


def prediction_summary(df: DataFrame, col: str) -> DataFrame:
    """G1: min, max, mean and population std of a prediction column."""
    x = F.col(col).cast("double")
    return df.agg(F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
                  F.stddev_pop(x).alias("std"))


def target_profile(df: DataFrame, col: str) -> DataFrame:
    """Mean, median, sample std, min, max, range and bias-corrected skew /
    excess kurtosis (pandas definitions) in one pass."""
    x = F.col(col).cast("double")
    aggs = [F.count(x).alias("n"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"),
            F.max(x).alias("max"), F.skewness(x).alias("g1"), F.kurtosis(x).alias("g2")]
    q, st = quantiles_with(df, [col], [0.5], aggs)  # exact median; moments in the same first pass
    n = float(st["n"])
    skew = st["g1"] * (n * (n - 1)) ** 0.5 / (n - 2) if st["g1"] is not None and n > 2 else None
    kurt = ((n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * st["g2"] + 6)) if st["g2"] is not None and n > 3 else None
    rng = (st["max"] - st["min"]) if st["max"] is not None else None
    return df.sparkSession.createDataFrame(
        [(st["n"], st["mean"], q[col][0], st["std"], st["min"], st["max"], rng, skew, kurt)],
        "n long, mean double, median double, std double, min double, max double, range double, skew double, "
        "kurtosis double")


def iqr_outliers(df: DataFrame, col: str, k: float = 1.5) -> DataFrame:
    """Q1, Q3, fences at k*IQR; count, percent, min and max of outliers."""
    q1, q3 = quantiles(df, [col], [0.25, 0.75])[col]
    iqr = q3 - q1
    lo, hi = q1 - k * iqr, q3 + k * iqr
    x = F.col(col).cast("double")
    out = (x < lo) | (x > hi)
    return df.agg(
        F.lit(q1).alias("q1"), F.lit(q3).alias("q3"), F.lit(iqr).alias("iqr"),
        F.lit(lo).alias("lower_fence"), F.lit(hi).alias("upper_fence"),
        F.count_if(out).cast("long").alias("n_outliers"),
        (F.count_if(out) * 100.0 / F.count(x)).alias("pct_outliers"),
        F.min(F.when(out, x)).alias("min_outlier"), F.max(F.when(out, x)).alias("max_outlier"))


def histogram(df: DataFrame, col: str, n_bins: int = 30) -> DataFrame:
    """Equal-width histogram (left-closed, last bin closed), empty bins kept."""
    x = F.col(col).cast("double")
    r = df.agg(F.min(x).alias("mn"), F.max(x).alias("mx")).first()
    mn = F.lit(r["mn"]).cast("double")
    w = (F.lit(r["mx"]).cast("double") - mn) / F.lit(float(n_bins))
    binned = df.select(
        F.when(w == 0, F.lit(0)).otherwise(
            F.least(F.floor((x - mn) / w), F.lit(n_bins - 1))).cast("int").alias("bin"))
    counts = binned.where(F.col("bin").isNotNull()).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    all_bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(counts, "bin", "left")
            .select("bin", F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                    (mn + F.col("bin") * w).alias("lower"),
                    (mn + (F.col("bin") + 1) * w).alias("upper")))


def flag_exclusivity(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    """Share of rows with at most one active flag; mean active flags."""
    s = row_sum(flags)
    return df.agg(F.avg((s <= 1).cast("double")).alias("exclusivity_rate"),
                  F.avg(s).alias("mean_active"), F.count(F.lit(1)).alias("n_rows"))


def flag_bundle(df: DataFrame, flags: Sequence[str], none_label: str = "none") -> DataFrame:
    """Fold exclusive flags into one categorical (first active flag);
    count rows per bundle value and rows where more than one flag was set."""
    expr = None
    for f in flags:
        cond = F.coalesce(F.col(f) == 1, F.lit(False))
        expr = F.when(cond, F.lit(f)) if expr is None else expr.when(cond, F.lit(f))
    bundled = df.select(expr.otherwise(F.lit(none_label)).alias("bundle"), (row_sum(flags) > 1).alias("__c"))
    return bundled.groupBy("bundle").agg(F.count(F.lit(1)).alias("n"),
                                         F.count_if("__c").cast("long").alias("n_conflict"))


def mutual_info(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """G22 (discrete): MI(feature; label) in nats for each feature, ranked.

    Features are unpivoted once and one contingency aggregation serves all.
    """
    long = df.select(label, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features
    ])).alias("kv")).select("kv.feature", "kv.value", label).where(F.col(label).isNotNull())
    cells = long.groupBy("feature", "value", label).agg(F.count(F.lit(1)).alias("nxy"))
    nx = cells.groupBy("feature", "value").agg(F.sum("nxy").alias("nx"))
    ny = cells.groupBy("feature", label).agg(F.sum("nxy").alias("ny"))
    n = cells.groupBy("feature").agg(F.sum("nxy").alias("n"))
    joined = (cells.join(nx, ["feature", "value"]).join(ny, ["feature", label]).join(F.broadcast(n), "feature"))
    term = (F.col("nxy") / F.col("n")) * F.log((F.col("nxy") * F.col("n")) / (F.col("nx") * F.col("ny")))
    return joined.groupBy("feature").agg(F.sum(term).alias("mi"))


def coef_stats(coefs: DataFrame, coef_col: str = "coef", tol: float = 1e-10) -> DataFrame:
    """Non-zero count, max |c|, mean |c| of a (feature, coef) table."""
    a = F.abs(F.col(coef_col))
    return coefs.agg(F.count_if(a > tol).cast("long").alias("n_nonzero"),
                     F.max(a).alias("max_abs"), F.avg(a).alias("mean_abs"))

"""Boosting statistics as aggregations and windows (A19, A20, G9, G10, G24,
W2-W5, T24).

Split search runs on aggregated tables (one row per histogram bin, or per
distinct feature value), never on raw rows in one task. Gains take squared
gradient sums: gain = 1/2 [GL^2/(HL+l) + GR^2/(HR+l) - G^2/(H+l)].
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .ordered import global_rank, ordered_prefix


def _sq(c: Column) -> Column:
    return c * c


def gain_expr(gl: Column, hl: Column, g: Column, h: Column, lam: float) -> Column:
    gr, hr = g - gl, h - hl
    lam_c = F.lit(float(lam))
    return F.lit(0.5) * (_sq(gl) / (hl + lam_c) + _sq(gr) / (hr + lam_c) - _sq(g) / (h + lam_c))


def leaf_weight_expr(g: Column, h: Column, lam: float) -> Column:
    """-G / (H + lambda)."""
    return -g / (h + F.lit(float(lam)))


def with_base_score(df: DataFrame, label: str, name: str = "f0") -> DataFrame:
    """Attach the global mean of ``label`` (one-row aggregate, applied as a literal)."""
    f0 = df.agg(F.avg(F.col(label).cast("double"))).first()[0]
    return df.withColumn(name, F.lit(f0).cast("double"))


def grad_hess(df: DataFrame, label: str, pred: str | None = None) -> DataFrame:
    """Squared-loss gradient g = -2 (y - F) and hessian h = 2, where F is
    ``pred`` or, if absent, the global mean (F0)."""
    base = df if pred else with_base_score(df, label, "__f")
    f = F.col(pred) if pred else F.col("__f")
    out = base.withColumns({"g": F.lit(-2.0) * (F.col(label).cast("double") - f), "h": F.lit(2.0)})
    return out.drop("__f") if not pred else out


def squared_loss_groups(df: DataFrame, keys: list[str], label: str, f0: float) -> DataFrame:
    """Per-group G and H for squared loss from count and sum of y:
    G = 2 (n F0 - sum y), H = 2 n. Same numbers as summing g row by row, but
    exact whenever y sums exactly (integer targets)."""
    agg = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"), F.sum(F.col(label).cast("double")).alias("sum_y"))
    return agg.withColumns({"G": F.lit(2.0) * (F.col("count") * F.lit(f0) - F.col("sum_y")),
                            "H": F.lit(2.0) * F.col("count")})


def histogram_bins(df: DataFrame, x: str, n_bins: int) -> tuple[DataFrame, DataFrame]:
    """Equal-width left-closed bin id 0..n-1 (max clipped into the last).
    Returns (rows with ``bin``, one-row (mn, width) table)."""
    r = df.agg(F.min(F.col(x).cast("double")).alias("mn"), F.max(F.col(x).cast("double")).alias("mx")).first()
    mn, width = r["mn"], ((r["mx"] - r["mn"]) / float(n_bins) if r["mn"] is not None else None)
    st = df.sparkSession.createDataFrame([(mn, width)], "mn double, width double")
    b = F.when(F.lit(width) == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col(x).cast("double") - F.lit(mn)) / F.lit(width)), F.lit(n_bins - 1))).cast("int")
    return df.withColumn("bin", b), st


def gradient_histogram(df: DataFrame, x: str, n_bins: int, g: str = "g", h: str = "h") -> DataFrame:
    """Count, sum g and sum h per bin; empty bins are kept with zeros."""
    binned, st = histogram_bins(df, x, n_bins)
    mn, width = st.first()
    agg = binned.groupBy("bin").agg(F.count(F.lit(1)).alias("count"), F.sum(g).alias("G"), F.sum(h).alias("H"))
    all_bins = df.sparkSession.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    return (all_bins.join(agg, "bin", "left")
            .select("bin", F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                    F.coalesce("G", F.lit(0.0)).alias("G"), F.coalesce("H", F.lit(0.0)).alias("H"),
                    (F.lit(mn) + F.col("bin") * F.lit(width)).alias("lower")))


def _gh_from(prefix: str, f0: float | None) -> tuple[Column, Column]:
    """G and H of a side: from prefix sums of G/H, or for squared loss from
    exact prefix sums of count and y: G = 2 (n F0 - sum y), H = 2 n."""
    if f0 is None:
        return F.col(f"{prefix}G"), F.col(f"{prefix}H")
    n, sy = F.col(f"{prefix}count"), F.col(f"{prefix}sum_y")
    return F.lit(2.0) * (n * F.lit(float(f0)) - sy), F.lit(2.0) * n


def _additive(f0: float | None) -> list[str]:
    return ["G", "H"] if f0 is None else ["count", "sum_y"]


def _gain_columns(f0: float | None, lam: float) -> list[Column]:
    gl, hl = _gh_from("L_", f0)
    g, h = _gh_from("T_", f0)
    return [gl.alias("GL"), hl.alias("HL"), gain_expr(gl, hl, g, h, lam).alias("gain"),
            leaf_weight_expr(gl, hl, lam).alias("w_left"), leaf_weight_expr(g - gl, h - hl, lam).alias("w_right")]


def histogram_split_gains(hist: DataFrame, lam: float = 1.0, f0: float | None = None) -> DataFrame:
    """For each candidate bin b >= 1 (left = bins < b, threshold = lower
    edge of b): GL, HL, gain and both leaf weights. ``hist`` has G/H per bin,
    or count/sum_y with ``f0`` for squared loss. The window runs over the bin
    table only (n_bins rows per feature)."""
    cols = _additive(f0)
    w = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    tot = Window.partitionBy(F.lit(1))
    h2 = hist.select("bin", "lower",
                     *[F.coalesce(F.sum(c).over(w), F.lit(0.0)).alias(f"L_{c}") for c in cols],
                     *[F.sum(c).over(tot).alias(f"T_{c}") for c in cols])
    return h2.where(F.col("bin") >= 1).select("bin", F.col("lower").alias("threshold"), *_gain_columns(f0, lam))


def exact_split_candidates(stats: DataFrame, x: str, lam: float = 1.0, f0: float | None = None) -> DataFrame:
    """Candidates between consecutive distinct values of ``x`` (threshold
    = midpoint; rows with x <= left_max go left).

    ``stats`` holds one row per distinct x with G and H (or count and sum_y
    with ``f0``). Prefix sums and the next distinct value come from
    distributed ranks (no single-partition window).
    """
    cols = _additive(f0)
    # One range pass gives the rank (a running count) and the prefix sums.
    pre = ordered_prefix(stats, [x], {"__r": F.lit(1), **{f"L_{c}": F.col(c) for c in cols}})
    pre = pre.withColumn("__r", F.col("__r").cast("long"))
    totals = stats.agg(*[F.sum(c).alias(f"T_{c}") for c in cols]).first()
    nxt = pre.select((F.col("__r") - 1).alias("__r"), F.col(x).alias("__next"))
    cands = pre.join(nxt, "__r").withColumns({f"T_{c}": F.lit(float(totals[f"T_{c}"])) for c in cols})
    return cands.select(F.col(x).alias("left_max"), ((F.col(x) + F.col("__next")) / F.lit(2.0)).alias("threshold"),
                        *_gain_columns(f0, lam))


def best_split(cands: DataFrame) -> DataFrame:
    """Arg-max of gain (ties -> smallest threshold)."""
    return cands.orderBy(F.desc("gain"), F.asc("threshold")).limit(1)


def leaf_weights(df: DataFrame, x: str, threshold: float, g: str = "g", h: str = "h", lam: float = 1.0) -> DataFrame:
    """Rows with x < threshold go left; G, H and weight per side."""
    side = F.when(F.col(x) < F.lit(float(threshold)), F.lit("left")).otherwise(F.lit("right"))
    agg = df.groupBy(side.alias("side")).agg(F.count(F.lit(1)).alias("count"), F.sum(g).alias("G"), F.sum(h).alias("H"))
    return agg.withColumn("weight", leaf_weight_expr(F.col("G"), F.col("H"), lam))


def boost_step(df: DataFrame, x: str, threshold: float, w_left: float, w_right: float, f0: float,
               eta: float = 0.3, out: str = "pred") -> DataFrame:
    """F0 + eta * leaf weight of the row's side."""
    leaf = F.when(F.col(x) < F.lit(float(threshold)), F.lit(float(w_left))).otherwise(F.lit(float(w_right)))
    return df.withColumn(out, F.lit(float(f0)) + F.lit(float(eta)) * leaf)


def mse_before_after(df: DataFrame, label: str, before: str, after: str) -> DataFrame:
    """MSE of two prediction columns and the improvement in percent."""
    y = F.col(label).cast("double")
    agg = df.agg(F.avg(_sq(y - F.col(before))).alias("mse_before"), F.avg(_sq(y - F.col(after))).alias("mse_after"))
    return agg.withColumn("improvement_pct",
                          (F.col("mse_before") - F.col("mse_after")) / F.col("mse_before") * F.lit(100.0))


def hash_order_key(id_col: str, seed: int) -> Column:
    """Seeded, engine-independent pseudo-random order: md5('seed:id'); a null id hashes as the empty string."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def row_tie(df: DataFrame) -> Column:
    """16 hex digits that tell rows of one id apart (the same for rows that agree in every column)."""
    return F.lpad(F.hex(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])), 16, "0")


def goss_sample(df: DataFrame, id_col: str, g: str = "g", top_ratio: float = 0.2, bottom_ratio: float = 0.1,
                seed: int = 42) -> DataFrame:
    """Keep the top ``top_ratio`` rows by |g| (ties by id), plus a seeded
    ``bottom_ratio`` share of all rows drawn from the rest; drawn rows weigh
    (n - top_n) / bottom_n. Returns the selected rows with ``weight`` and
    ``part`` (top / sampled).

    Only two order statistics are needed, the last key of either part; the
    choice is then a map-side comparison, so repeated ids multiply nothing.
    Null gradients rank last; rows of one id and gradient are told apart by
    their other columns, and rows equal in all columns stand or fall together."""
    n = df.count()
    top_n, bottom_n = int(n * top_ratio), int(n * bottom_ratio)
    g0 = F.coalesce(F.abs(F.col(g).cast("double")), F.lit(-1.0))
    key = F.struct((-g0).alias("__neg"), F.col(id_col).isNull().alias("__none"), F.col(id_col).alias("__id"), row_tie(df).alias("__tie"))
    marked = df.withColumn("__key", key)
    names = ["__neg", "__none", "__id", "__tie"]
    last = None
    if top_n:
        ranked = global_rank(marked.select("__key.*"), names, "__rank")
        last = ranked.where(F.col("__rank") == top_n).select(*names).first()
    types = {f.name: f.dataType for f in marked.schema["__key"].dataType.fields}
    is_top = F.lit(False) if last is None else F.col("__key") <= F.struct(*[F.lit(last[c]).cast(types[c]).alias(c) for c in names])
    marked = marked.withColumn("__top", is_top).withColumn("__h", F.concat(hash_order_key(id_col, seed), F.col("__key.__tie")))
    from .split import hash_cuts  # which builds on this module
    _, cuts = hash_cuts(marked.where(~F.col("__top")), lambda _: [bottom_n])
    drawn = ~F.col("__top") & (F.col("__h") <= F.lit(next(iter(cuts.values())))) if cuts else F.lit(False)
    weight = F.when(F.col("__top"), F.lit(1.0)).otherwise(F.lit((n - top_n) / bottom_n if bottom_n else 0.0))
    part = F.when(F.col("__top"), F.lit("top")).otherwise(F.lit("sampled"))
    return marked.where(F.col("__top") | drawn).select(*df.columns, weight.alias("weight"), part.alias("part"))


def ordered_leaf_weight(df: DataFrame, id_col: str, x: str, threshold: float, g: str = "g", h: str = "h",
                        lam: float = 1.0) -> DataFrame:
    """Each row's leaf output at a given split, from strictly earlier rows
    (by ``id_col``) on the same side only (ordered boosting). Rows of one id follow each other in a fixed order."""
    side = F.when(F.col(x) < F.lit(float(threshold)), F.lit("left")).otherwise(F.lit("right"))
    pre = ordered_prefix(df.withColumn("side", side).withColumn("__tie", row_tie(df)), [id_col, "__tie"], {"__G": F.col(g), "__H": F.col(h)},
                         partition_by=["side"], inclusive=False)
    return pre.withColumn("ordered_weight", leaf_weight_expr(F.col("__G"), F.col("__H"), lam)).drop("__G", "__H", "__tie")

"""Evaluation metrics as single aggregate passes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import small_rows
from .ordered import ordered_prefix

EPS = 2.220446049250313e-16  # float64 machine epsilon (MAPE floor, sklearn rule)


def _err(label: str, pred: str):
    return F.col(label).cast("double") - F.col(pred).cast("double")


def regression_metrics(df: DataFrame, label: str, pred: str) -> DataFrame:
    """MAE, MSE, RMSE, R^2 (R^2 = 1 - MSE / population variance of y)."""
    e = _err(label, pred)
    agg = df.agg(F.avg(F.abs(e)).alias("mae"), F.avg(e * e).alias("mse"),
                 F.var_pop(F.col(label).cast("double")).alias("__var"), F.count(F.lit(1)).alias("n"))
    return agg.select("n", "mae", "mse", F.sqrt("mse").alias("rmse"),
                      (F.lit(1.0) - F.col("mse") / F.col("__var")).alias("r2"))


def mape(df: DataFrame, label: str, pred: str) -> DataFrame:
    """MAPE in percent, two rules: |y| floored at eps, and raw (y = 0 -> inf)."""
    y = F.col(label).cast("double")
    ae = F.abs(_err(label, pred))
    raw = F.when(y == 0, F.when(ae == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf")))).otherwise(ae / F.abs(y))
    return df.agg((F.avg(ae / F.greatest(F.abs(y), F.lit(EPS))) * 100.0).alias("mape"),
                  (F.avg(raw) * 100.0).alias("mape_raw"))


def baseline_comparison(train: DataFrame, valid: DataFrame, label: str, pred: str) -> DataFrame:
    """Model vs the train-mean baseline on the valid rows (float mean)."""
    base = train.agg(F.avg(F.col(label).cast("double"))).first()[0]
    v = valid.withColumn("__base", F.lit(base).cast("double"))
    y = F.col(label).cast("double")
    e, eb = y - F.col(pred).cast("double"), y - F.col("__base")
    agg = v.agg(F.avg(F.abs(e)).alias("mae"), F.avg(F.abs(eb)).alias("baseline_mae"),
                F.avg(eb * eb).alias("__bmse"), F.var_pop(y).alias("__var"), F.first("__base").alias("baseline"))
    return agg.select("mae", "baseline_mae", F.sqrt("__bmse").alias("baseline_rmse"),
                      (F.lit(1.0) - F.col("__bmse") / F.col("__var")).alias("baseline_r2"),
                      ((F.col("baseline_mae") - F.col("mae")) / F.col("baseline_mae") * 100.0).alias("improvement_pct"),
                      "baseline")


def residual_stats(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Residual mean, sample and population std, max, min."""
    e = _err(label, pred)
    return df.agg(F.avg(e).alias("mean"), F.stddev_samp(e).alias("std"), F.stddev_pop(e).alias("std_pop"),
                  F.max(e).alias("max"), F.min(e).alias("min"))


def confusion_matrix(df: DataFrame, label: str, pred: str, classes: Sequence) -> DataFrame:
    """One row per true class, one column per predicted class."""
    m = df.groupBy(label).pivot(pred, list(classes)).agg(F.count(F.lit(1)))
    return m.select(label, *[F.coalesce(F.col(str(c)), F.lit(0)).cast("long").alias(f"pred_{c}") for c in classes])


def _per_class(df: DataFrame, label: str, pred: str) -> DataFrame:
    """tp, predicted count and support per class from one (label, pred) count:
    each cell is unpivoted into its true class and its predicted class and
    summed once more (no joins)."""
    cells = df.groupBy(label, pred).agg(F.count(F.lit(1)).alias("c"))
    both = cells.select(F.explode(F.array(
        F.struct(F.col(label).alias("cls"), F.col("c").alias("support"), F.lit(0).cast("long").alias("predicted"),
                 F.when(F.col(label) == F.col(pred), F.col("c")).otherwise(F.lit(0)).cast("long").alias("tp")),
        F.struct(F.col(pred).alias("cls"), F.lit(0).cast("long").alias("support"), F.col("c").alias("predicted"),
                 F.lit(0).cast("long").alias("tp")))).alias("e")).select("e.*")
    per = both.groupBy("cls").agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"),
                                  F.sum("tp").alias("tp"))
    precision = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    recall = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                F.lit(2.0) * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))
                ).otherwise(F.lit(0.0))
    return per.withColumn("precision", precision).withColumn("recall", recall).withColumn("f1", f1)


def classification_report(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Precision, recall, F1, support per class, then accuracy, macro and
    weighted averages (accuracy row: precision = recall = f1 = accuracy)."""
    per = _per_class(df, label, pred)
    tot = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("tp"), F.avg("precision").alias("mp"),
                  F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                  F.sum(F.col("precision") * F.col("support")).alias("wp"),
                  F.sum(F.col("recall") * F.col("support")).alias("wr"),
                  F.sum(F.col("f1") * F.col("support")).alias("wf"))
    rows = per.select(F.col("cls").cast("string").alias("class"), "precision", "recall", "f1",
                      F.col("support").cast("long").alias("support"))
    acc = F.col("tp") / F.col("n")
    summary = tot.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("class"), acc.alias("precision"), acc.alias("recall"), acc.alias("f1"),
                 F.col("n").cast("long").alias("support")),
        F.struct(F.lit("macro avg").alias("class"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").cast("long").alias("support")),
        F.struct(F.lit("weighted avg").alias("class"), (F.col("wp") / F.col("n")).alias("precision"),
                 (F.col("wr") / F.col("n")).alias("recall"), (F.col("wf") / F.col("n")).alias("f1"),
                 F.col("n").cast("long").alias("support")))).alias("r")).select("r.*")
    return rows.unionByName(summary)


def classification_scores(df: DataFrame, label: str, pred: str) -> DataFrame:
    """Accuracy, balanced accuracy (mean recall), macro F1."""
    per = _per_class(df, label, pred)
    return per.agg((F.sum("tp") / F.sum("support")).alias("accuracy"), F.avg("recall").alias("balanced_accuracy"),
                   F.avg("f1").alias("macro_f1"))


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    """Exact AUC with ties counted one half (average ranks).

    Rows collapse to one row per distinct score; the count of negatives below
    each score is a distributed prefix sum, so no task sees all scores.
    """
    pos = (F.col(label).cast("double") == 1)
    by_score = df.groupBy(score).agg(F.count_if(pos).alias("p"), F.count_if(~pos).alias("q"))
    pre = ordered_prefix(by_score, [score], {"neg_below": F.col("q")}, inclusive=False)
    agg = pre.agg(F.sum(F.col("p") * (F.col("neg_below") + F.lit(0.5) * F.col("q"))).alias("u"),
                  F.sum("p").alias("P"), F.sum("q").alias("N"))
    return agg.select((F.col("u") / (F.col("P") * F.col("N"))).alias("auc"),
                      F.col("P").cast("long").alias("n_pos"), F.col("N").cast("long").alias("n_neg"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (k * n_c)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_c"))
    tot = counts.agg(F.sum("n_c").alias("n"), F.count(F.lit(1)).alias("k")).first()  # one row
    return counts.select(label, "n_c", (F.lit(float(tot["n"])) / (F.lit(float(tot["k"])) * F.col("n_c")))
                         .alias("weight"))


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach balanced weights as a ``weightCol``; the class table is broadcast only when it measures small."""
    w = cut_lineage(class_weights(df, label).select(label, F.col("weight").alias(out)))
    rows = small_rows(w)
    return df.join(w if rows is None else F.broadcast(df.sparkSession.createDataFrame(rows, w.schema)), label, "left")


def cv_summary(scores: DataFrame, score: str = "score") -> DataFrame:
    """Mean, population std and mean +- 2 std of fold scores."""
    agg = scores.agg(F.avg(score).alias("mean"), F.stddev_pop(score).alias("std"), F.count(F.lit(1)).alias("folds"))
    return agg.withColumns({"low": F.col("mean") - 2 * F.col("std"), "high": F.col("mean") + 2 * F.col("std")})


def cv_test_gap(cv: float, test: float, share: float = 0.1) -> dict:
    """The distance between the cross-validated and the test metric; too far apart beyond ``share`` of the former."""
    gap = abs(cv - test)
    return {"cv": float(cv), "test": float(test), "gap": float(gap), "too_far": bool(gap > share * abs(cv))}


def overfit_gap(train_r2: DataFrame, test_r2: DataFrame) -> DataFrame:
    """Train R^2 - test R^2 with bands (< 0.1 ok, < 0.2 mild, else severe)."""
    tr, te = train_r2.first()["r2"], test_r2.first()["r2"]
    j = train_r2.sparkSession.createDataFrame([(tr, te)], "train_r2 double, test_r2 double")
    gap = F.col("train_r2") - F.col("test_r2")
    return j.withColumn("gap", gap).withColumn(
        "band", F.when(gap < 0.1, F.lit("ok")).when(gap < 0.2, F.lit("mild")).otherwise(F.lit("severe")))

import random

from tessera.operators import metrics, profile


def test_regression_and_baseline(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    r = metrics.regression_metrics(df, "y", "p").first()
    assert abs(r.mae - 0.5) < 1e-12 and abs(r.mse - (0.25 + 1) / 3) < 1e-12
    var = sum((v - 7 / 3) ** 2 for v in [1, 2, 4]) / 3
    assert abs(r.r2 - (1 - r.mse / var)) < 1e-12
    m = metrics.mape(spark.createDataFrame([(0.0, 1.0), (2.0, 1.0)], "y double, p double"), "y", "p").first()
    assert m.mape_raw == float("inf") and m.mape > 1e15


def test_auc_matches_pairs(spark):
    rng = random.Random(3)
    rows = [(rng.randint(0, 1), float(rng.randint(0, 9))) for _ in range(400)]
    got = metrics.roc_auc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first().auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-12


def test_class_report(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)]
    df = spark.createDataFrame(rows, "y int, p int")
    rep = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rep["1"].precision == 2 / 3 and rep["1"].recall == 1.0 and rep["2"].f1 == 0.0
    assert rep["accuracy"].precision == 0.6 and rep["macro avg"].support == 5
    s = metrics.classification_scores(df, "y", "p").first()
    assert abs(s.balanced_accuracy - (0.5 + 1 + 0) / 3) < 1e-12
    cm = {r.y: (r.pred_0, r.pred_1) for r in metrics.confusion_matrix(df, "y", "p", [0, 1]).collect()}
    assert cm == {0: (1, 1), 1: (0, 2), 2: (1, 0)}
    w = {r.y: r.weight for r in metrics.class_weights(df, "y").collect()}
    assert w == {0: 5 / 6, 1: 5 / 6, 2: 5 / 3}


def test_mutual_info_independent_is_zero(spark):
    rows = [(a, b) for a in range(3) for b in range(2)] * 5
    mi = profile.mutual_info(spark.createDataFrame(rows, "x int, y int"), ["x"], "y").first().mi
    assert abs(mi) < 1e-12


def test_describe_and_profile(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 10]], "x double")
    d = profile.describe(df, ["x"]).first()
    assert (d["count"], d.p25, d.p50, d.p75) == (5, 2.0, 3.0, 4.0)
    t = profile.target_profile(df, "x").first()
    assert abs(t.skew - 1.697056274847714) < 1e-12  # pandas Series.skew()
    assert abs(t.kurtosis - 3.152) < 1e-9  # pandas Series.kurt()
    h = profile.histogram(df, "x", 3).orderBy("bin").collect()
    assert [r["count"] for r in h] == [3, 1, 1]

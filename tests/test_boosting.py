import pytest
from pyspark.sql import functions as F

from tessera.operators import boosting, profile

JV = [100000, 200000, 150000, 250000, 180000, 120000, 220000, 300000, 130000, 280000]
SV = [10000, 15000, 12000, 18000, 14000, 11000, 16000, 20000, 11500, 19000]


@pytest.fixture()
def f8(spark):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(zip(JV, SV))],
                                 "id int, Job_Value double, Savings double")


def test_gradient_step_f7(spark):
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(JV[:5], SV[:5])], "x double, y double")
    gh = boosting.grad_hess(df, "y")
    lw = {r.side: r.weight for r in boosting.leaf_weights(gh, "x", 170000.0).collect()}
    assert lw == {"left": -2240.0, "right": 1600.0}
    stepped = boosting.boost_step(df.withColumn("f0", F.lit(13800.0)), "x", 170000.0, lw["left"], lw["right"], 13800.0)
    assert sorted({r.pred for r in stepped.collect()}) == [13128.0, 14280.0]
    m = boosting.mse_before_after(stepped, "y", "f0", "pred").first()
    assert m.mse_before == 7360000.0 and round(m.mse_after, 1) == 5098393.6


def test_histogram_and_split_f8(spark, f8):
    gh = boosting.grad_hess(f8, "Savings")
    hist = boosting.gradient_histogram(gh, "Job_Value", 5).orderBy("bin").collect()
    assert [(r["count"], round(r.G), r.H) for r in hist] == [
        (3, 22900, 6.0), (1, 5300, 2.0), (2, 600, 4.0), (2, -9400, 4.0), (2, -19400, 4.0)]
    gains = boosting.histogram_split_gains(boosting.gradient_histogram(gh, "Job_Value", 5)).orderBy("bin").collect()
    assert [round(r.gain, 2) for r in gains] == [54938190.48, 74766153.85, 77981538.46, 48705411.76]
    best = max(gains, key=lambda r: r.gain)
    assert best.threshold == 220000.0 and round(best.w_left, 4) == -2215.3846 and best.w_right == 3200.0


def test_exact_split_f8(spark, f8):
    gh = boosting.grad_hess(f8, "Savings")
    stats = gh.groupBy("Job_Value").agg(F.sum("g").alias("G"), F.sum("h").alias("H"))
    best = boosting.best_split(boosting.exact_split_candidates(stats, "Job_Value")).first()
    assert best.threshold == 190000.0 and round(best.gain, 2) == 79113636.36
    # squared-loss route from count / sum of y gives the same split
    st2 = f8.groupBy("Job_Value").agg(F.count(F.lit(1)).alias("count"), F.sum("Savings").alias("sum_y"))
    best2 = boosting.best_split(boosting.exact_split_candidates(st2, "Job_Value", f0=14650.0)).first()
    assert best2.threshold == 190000.0 and round(best2.gain, 2) == 79113636.36


def test_goss_sizes_and_weights(spark, f8):
    gh = boosting.grad_hess(f8, "Savings")
    s = boosting.goss_sample(gh, "id", "g", 0.2, 0.1).collect()
    top = [r for r in s if r.part == "top"]
    drawn = [r for r in s if r.part == "sampled"]
    assert len(top) == 2 and len(drawn) == 1 and drawn[0].weight == 8.0
    top_abs = sorted(abs(r.g) for r in top)
    rest_abs = [abs(r.g) for r in gh.collect() if r.id not in {t.id for t in top}]
    assert min(top_abs) >= max(rest_abs)


def test_ordered_leaf_weight_uses_earlier_rows_only(spark, f8):
    gh = boosting.grad_hess(f8, "Savings")
    out = {r.id: r.ordered_weight for r in boosting.ordered_leaf_weight(gh, "id", "Job_Value", 170000.0).collect()}
    rows = sorted(gh.collect(), key=lambda r: r.id)
    for r in rows:
        side = r.Job_Value < 170000.0
        prev = [p for p in rows if p.id < r.id and (p.Job_Value < 170000.0) == side]
        want = -sum(p.g for p in prev) / (sum(p.h for p in prev) + 1.0)
        assert abs(out[r.id] - want) < 1e-9


def test_flag_exclusivity_f8(spark):
    df = spark.createDataFrame([(1, 0, 0), (0, 1, 0), (0, 0, 1), (1, 0, 0)], "a int, b int, c int")
    r = profile.flag_exclusivity(df, ["a", "b", "c"]).first()
    assert r.exclusivity_rate == 1.0 and r.mean_active == 1.0

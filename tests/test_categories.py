"""Categories of any width: codes, fold-wise target statistics, one-hot vectors, lookups in one join."""

import hashlib

import pytest
from pyspark.ml.util import DefaultParamsReader  # noqa: F401  (the saved stages are read through it)
from pyspark.sql import functions as F

from tessera.operators import base, categories, prep
from tessera.plans import learners, score, train
from tessera.plans.features import plan_features
from tessera.sources.sinks import load_model, save_model


def block(order, blocks=16, seed=42):
    text = f"{seed}:{'' if order is None else order}"
    return int(hashlib.md5(text.encode()).hexdigest()[:7], 16) % blocks


def rows_of(spark, n, width):
    return spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("x"),
                                 F.format_string("c%06d", F.col("id") * 7919 % width).alias("c"),
                                 (F.col("id") % 7 + F.col("id") * 7919 % width % 5).cast("double").alias("label"))


def test_training_statistics_leave_later_rows_out(spark):
    rows = [(k, f"v{k % 3}", float(k)) for k in range(60)] + [(None, "v1", 7.0), (3, "v0", 5.0), (3, "v0", 5.0), (70, None, 2.0)]
    df = spark.createDataFrame(rows, "k long, c string, label double")
    model, out = categories.CategoryCodes(["c"], ["o"], "label", "k", widest=2).fitTransform(df)
    prior = sum(r[2] for r in rows) / len(rows)
    want = []
    for k, c, y in rows:
        earlier = [y2 for k2, c2, y2 in rows if c is not None and c2 == c and block(k2) < block(k)]
        want.append((k, c, y, round((sum(earlier) + prior) / (len(earlier) + 1), 9)))
    got = [(r.k, r.c, r.label, round(r.o, 9)) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    own = {c: [y2 for _, c2, y2 in rows if c2 == c] for c in ("v0", "v1", "v2")}
    new = model.transform(spark.createDataFrame([("v0",), ("zz",), (None,)], "c string"))
    assert [round(r.o, 9) for r in new.collect()] == [round((sum(own["v0"]) + prior) / (len(own["v0"]) + 1), 9), round(prior, 9), round(prior, 9)]


def test_codes_and_unseen(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "x")], "c string, d string")
    model = categories.CategoryCodes(["c", "d"], ["ci", "di"]).fit(df)
    out = model.transform(spark.createDataFrame([("a", "y"), ("zz", None)], "c string, d string"))
    assert [(r.ci, r.di) for r in out.collect()] == [(0.0, 1.0), (2.0, 2.0)]
    assert out.schema["ci"].metadata["ml_attr"]["vals"] == ["a", "b", "__unknown"]
    assert sorted((r.column_name, r.value, r.number) for r in model.names_table().collect()) == [
        ("c", "a", 0.0), ("c", "b", 1.0), ("d", "x", 0.0), ("d", "y", 1.0)]


@pytest.mark.parametrize("width", [60, 100_000])
def test_catboost_trains_saves_and_scores(spark, tmp_dir, width):
    """60 categories go to the trees (with as many bins), 100,000 as statistics; both survive a save and unseen values."""
    df = rows_of(spark, 120_000 if width > 1000 else 3000, width).withColumnRenamed("label", "y")
    cfg = {"data": {"target_column": "y", "feature_columns": ["x", "c"]}, "feature_engineering": {"preprocessing": {}},
           "model": {"type": "decisiontree", "params": {"max_depth": 3}}, "cv_folds": 2}
    if width == 60:
        cfg["model"] = {"type": "catboost", "params": {"iterations": 2, "depth": 3}}
    else:  # the same encoding with one tree, which is quicker
        cfg["model"]["type"] = "catboost"
        cfg["model"]["params"] = {"iterations": 1, "depth": 3}
    res = train.train(spark, df, cfg, "k")
    assert set(res.feature_cols) == {"x", "c"} and res.metrics["R2"] > 0.3
    save_model(res.model, tmp_dir + "/m")
    new = spark.createDataFrame([(1, 3.0, "c000001"), (2, 3.0, "never met"), (3, None, None)], "k long, x double, c string")
    scored = score.score(load_model(tmp_dir + "/m"), new, cfg["data"])
    assert all(r.Predicted_y is not None for r in scored.collect())


def test_bins_follow_the_categories(spark):
    plan = plan_features(rows_of(spark, 500, 60).drop("label"), {"data": {"target_column": "label", "feature_columns": ["x", "c"]},
                                                                 "model": {"type": "catboost"}}, id_col="k")
    learner = learners.create_learner({"type": "decisiontree"})
    model = plan.pipeline(learner).fit(rows_of(spark, 500, 60))
    assert learner.getMaxBins() == 32 and model.stages[-1].getMaxBins() == 61


def test_statistics_need_the_label(spark):
    with pytest.raises(ValueError, match="label"):
        categories.CategoryCodes(["c"], ["o"], "label", widest=10).fit(rows_of(spark, 100, 60).drop("label"))


def test_one_hot_of_100k_categories(spark):
    df = rows_of(spark, 100_000, 100_000)
    model = prep.OneHotWide(["c"]).fit(df)
    out = model.transform(df)
    assert "c_onehot" in out.columns and "c" not in out.columns
    slots = categories.one_hot_slots(out, "c_onehot", ["k"])
    want = df.select("k", F.substring("c", 2, 6).cast("int").alias("slot"))
    assert slots.count() == 100_000 and slots.exceptAll(want).count() == 0
    unseen = model.transform(spark.createDataFrame([(1, 1.0, "other")], "k long, x double, c string"))
    assert categories.one_hot_slots(unseen, "c_onehot", ["k"]).count() == 0


def test_narrow_and_wide_one_hot_together(spark):
    df = spark.createDataFrame([("a", "p"), ("b", "q"), (None, "r")], "c string, d string")
    out = prep.OneHotWide(["c", "d"], maxCategories=2).fit(df.where("c is not null or d = 'r'")).transform(df)
    assert set(out.columns) == {"c_onehot", "d_onehot"}
    out = prep.OneHotWide(["c", "d"], maxCategories=3).fit(df).transform(df)
    assert set(out.columns) == {"c_Unknown", "c_a", "c_b", "d_p", "d_q", "d_r"}


COLS = [f"c{i}" for i in range(7)]


def wide_rows(spark):
    """Seven text columns, a third of their values null and a third one hot value."""
    value = lambda i: F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit(f"v{i}_"), F.col("id") % 50))
    return spark.range(600).select("id", *[value(i).alias(c) for i, c in enumerate(COLS)])


def test_seven_columns_in_one_join(spark, monkeypatch):
    df = wide_rows(spark)
    small = prep.LabelEncoder(COLS).fit(df)
    want = sorted(map(tuple, small.transform(df).collect()))
    large = prep.LabelEncoderModel(COLS, base.BROADCAST_ROWS + 1)
    large.mapping = small.mapping
    out = large.transform(df)
    assert sorted(map(tuple, out.collect())) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 2  # the map for all columns, and the way back by row
    small_plan = small.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in small_plan.split("Initial Plan")[0]

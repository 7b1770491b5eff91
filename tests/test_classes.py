"""Targets that are names: codes inside, class names in predictions, reports and saved models."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import classes
from tessera.plans import score, train
from tessera.sources.sinks import load_model, model_family, save_model


def flowers(spark, names=("iris", "rose", "Tulip")):
    """The class follows x; one row in ten has no class."""
    return spark.createDataFrame([(i, float(i % 30), "z", None if i % 10 == 9 else names[i % 30 * len(names) // 30]) for i in range(600)],
                                 "id long, x double, c string, kind string")


def cfg(model, params=None):
    return {"data": {"target_column": "kind", "feature_columns": ["x", "c"]}, "cv_folds": 2,
            "model": {"type": model, "task": "classification", "params": params or {}, "hyperparameter_search": {"scoring": "accuracy"}}}


@pytest.mark.parametrize("model, params", [("decisiontree", {"max_depth": 3}), ("randomforest", {"n_estimators": 5, "max_depth": 3}),
                                           ("catboost", {"iterations": 2, "depth": 2}), ("logistic", {"max_iter": 20, "C": 100.0})])
def test_text_classes(spark, tmp_dir, model, params):
    res = train.train(spark, flowers(spark), cfg(model, params), "id")
    assert res.classes == ["Tulip", "iris", "rose"]
    report = {r["class"]: r for r in res.report.collect()}
    assert set(report) == {"Tulip", "iris", "rose", "accuracy", "macro avg", "weighted avg"}
    assert report["accuracy"].support == 108 and res.metrics["accuracy"] > 0.85
    save_model(res.model, tmp_dir + "/m")
    loaded = load_model(tmp_dir + "/m")
    out = score.score(loaded, spark.createDataFrame([(1.0, "z"), (15.0, "z"), (29.0, "new")], "x double, c string"), cfg(model)["data"],
                      with_probability=True)
    assert [r.Predicted_kind for r in out.collect()] == ["iris", "rose", "Tulip"]
    assert model_family(loaded) != "unknown"
    if "Probability" in out.columns:
        assert all(0 <= r.Probability <= 1 for r in out.collect())


def test_two_named_classes_and_booleans(spark):
    two = flowers(spark, ("no", "yes"))
    res = train.train(spark, two, cfg("lightgbm", {"n_estimators": 2, "max_depth": 2}), "id")
    assert res.classes == ["no", "yes"] and res.importance.count() == 2
    flags = two.withColumn("kind", F.col("kind") == "yes")
    res = train.train(spark, flags, cfg("decisiontree"), "id")
    assert res.classes == ["false", "true"] and res.metrics["accuracy"] > 0.95


def test_numbers_stay_numbers(spark):
    df = flowers(spark, ("a", "b")).withColumn("kind", (F.col("kind") == "b").cast("int"))
    res = train.train(spark, df, cfg("decisiontree"), "id")
    assert res.classes is None and {"0.0", "1.0"} <= {r["class"] for r in res.report.collect()}


def test_too_many_classes(spark):
    df = spark.range(2000).select(F.concat(F.lit("k"), "id").alias("y"))
    with pytest.raises(ValueError, match="classes"):
        classes.class_names(df, "y")


def test_gap_rule():
    from tessera.operators.metrics import cv_test_gap
    assert cv_test_gap(100.0, 111.0) == {"cv": 100.0, "test": 111.0, "gap": 11.0, "too_far": True}
    assert not cv_test_gap(100.0, 91.0)["too_far"]


def test_weights_of_many_classes(spark):
    from tessera.operators.metrics import with_class_weights
    df = spark.createDataFrame([("a",)] * 3 + [("b",), (None,)], "y string")
    assert sorted((r.y, r.weight) for r in with_class_weights(df, "y").where("y is not null").collect())[0] == ("a", 5 / 9)

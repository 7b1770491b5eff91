from pyspark.sql import functions as F

from tessera.plans import learners, score, train
from tessera.plans.tables import order_jobs
from tessera.sources.sinks import load_model, save_model

from conftest import SF_SMALL


def _cfg(model_type, **params):
    return {"random_state": 42, "val_size": 0.2, "cv_folds": 2,
            "data": {"target_column": "saving", "categorical_features": ["o_orderpriority", "c_mktsegment"]},
            "feature_engineering": {"operations": [{"operation": "divide", "inputs": ["o_totalprice", "quantity"],
                                                    "output": "per_unit"}], "preprocessing": {}},
            "model": {"type": model_type, "task": "regression", "params": params}}


def test_factory_types(spark):
    assert type(learners.create_learner({"type": "catboost", "params": {"iterations": 5, "depth": 3}})).__name__ == \
        "GBTRegressor"
    assert type(learners.create_learner({"type": "randomforest", "task": "classification"})).__name__ == \
        "RandomForestClassifier"
    try:
        learners.create_learner({"type": "nope"})
        raise AssertionError("expected ValueError")
    except ValueError:
        pass
    assert learners.encoding_for("nn") == "onehot" and learners.encoding_for("catboost") == "native"


def test_train_save_score(spark, tmp_dir):
    df = order_jobs(spark, SF_SMALL).select("o_orderkey", "o_totalprice", "quantity", "n_lines", "o_orderpriority",
                                            "c_mktsegment", "saving")
    res = train.train(spark, df, _cfg("decisiontree", max_depth=3), "o_orderkey")
    assert {"MAE", "RMSE", "R2", "Baseline_MAE"} <= set(res.metrics) and res.metrics["MAE"] > 0
    assert res.importance.count() >= 4
    save_model(res.model, tmp_dir + "/m")
    scored = score.score(load_model(tmp_dir + "/m"), df.drop("saving"), keep=["o_orderkey"])
    assert scored.count() == df.count() and scored.where(F.col("Predicted_Value").isNull()).count() == 0
    assert set(scored.select("Model_Type").distinct().toPandas()["Model_Type"]) == {"decisiontree"}


def test_fit_on_all_parity_mode(spark):
    df = order_jobs(spark, SF_SMALL).select("o_orderkey", "o_totalprice", "quantity", "n_lines", "o_orderpriority",
                                            "c_mktsegment", "saving")
    res = train.train(spark, df, _cfg("linear"), "o_orderkey", fit_on="all")
    assert res.metrics["RMSE"] > 0 and res.importance.count() >= 4


def test_score_literal_rows_and_text_guard(spark, tmp_dir):
    """A saved model scores hand-written rows; P10: text left before a
    numeric learner is rejected."""
    import pytest
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from tessera.operators import prep

    train_rows = spark.createDataFrame([(float(x), float(2 * x + 1)) for x in range(20)], "x double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                             learners.create_learner({"type": "linear"})]).fit(train_rows)
    save_model(model, tmp_dir + "/lin")
    literal = spark.createDataFrame([(100.0,)], "x double")
    out = score.score(load_model(tmp_dir + "/lin"), literal).first()
    assert abs(out.Predicted_Value - 201.0) < 1e-6 and out.Model_Type == "linear"
    with pytest.raises(ValueError, match="text"):
        prep.assert_numeric(spark.createDataFrame([("a", 1.0)], "c string, x double"), ["c", "x"])


def test_plan_accepts_shipped_config_shape(spark):
    """A config shaped like the reference's neural-network config (with its
    inert handle_missing key and a categorical_handling block) plans fine;
    a misspelled key is rejected."""
    import pytest

    from tessera.plans.features import plan_features
    df = spark.createDataFrame([(1, 10.0, "a", 1.0)], "Job_Number long, Job_Value double, Estimator string, y double")
    cfg = {"data": {"target_column": "y", "categorical_features": ["Estimator"]},
           "feature_engineering": {"preprocessing": {"scale_features": True, "scaling_method": "standard",
                                                     "categorical_encoding": "onehot", "handle_missing": True,
                                                     "missing_strategy": "mean"},
                                   "categorical_handling": {"fillna": "Unknown", "encoding": "onehot"}},
           "model": {"type": "neuralnetwork"}}
    plan = plan_features(df.drop("y"), cfg)
    assert plan.summary["encoding_method"] == "onehot"
    cfg["feature_engineering"]["preprocessing"]["scaling_methd"] = "minmax"
    with pytest.raises(ValueError, match="unknown preprocessing keys"):
        plan_features(df.drop("y"), cfg)


def _typed_rows(spark):
    return spark.createDataFrame([(i, float(i % 7), "c%02d" % (i % 60), float(i % 7) * 2 + i % 60) for i in range(600)],
                                 "id long, x double, c string, y double")


def test_native_categories_keep_nominal_metadata(spark):
    """60 categories reach the trees as a nominal attribute, not as alphabetical numbers."""
    from tessera.plans.features import plan_features
    cfg = {"data": {"target_column": "y", "feature_columns": ["x", "c"]}, "feature_engineering": {"preprocessing": {}},
           "model": {"type": "catboost"}}
    df = _typed_rows(spark)
    plan = plan_features(df, cfg, id_col="id")
    out = plan.pipeline().fit(df).transform(df)
    attrs = out.schema["features"].metadata["ml_attr"]["attrs"]
    assert [a["name"] for a in attrs["nominal"]] == ["c__idx"] and len(attrs["nominal"][0]["vals"]) >= 60
    assert plan.feature_cols == ["x", "c"] and out.select("x", "c").schema == df.select("x", "c").schema


def test_scored_sources_are_untouched(spark):
    from tessera.plans.features import plan_features, prepare_rows
    cfg = {"data": {"target_column": "My Target", "feature_columns": ["x", "c"]},
           "feature_engineering": {"preprocessing": {"scale_features": True}}, "model": {"type": "decisiontree"}}
    df = _typed_rows(spark).withColumnRenamed("y", "My Target")
    res = train.train(spark, df, cfg, "id")
    assert res.feature_cols == ["x", "c"] and {r.feature for r in res.importance.collect()} == {"x", "c"}
    new = spark.createDataFrame([(1, None, None, "k"), (2, float("nan"), "zz", "k")], "id long, x double, c string, extra string")
    out = score.score(res.model, new, cfg["data"])
    assert out.columns == ["id", "x", "c", "extra", "Predicted_My_Target", "Prediction_Timestamp", "Model_Type"]
    assert out.select(*new.columns).schema == new.schema
    assert [(r.id, r.c, r.extra) for r in out.orderBy("id").collect()] == [(1, None, "k"), (2, "zz", "k")]


def test_saved_operations_raise_when_scoring(spark):
    import pytest
    cfg = {"data": {"target_column": "y", "feature_columns": ["x"]},
           "feature_engineering": {"operations": [{"operation": "divide", "inputs": ["y z", "x"], "output": "skipped"},
                                                  {"operation": "divide", "inputs": ["id", "x"], "output": "per x"}]},
           "model": {"type": "linear"}}
    res = train.train(spark, _typed_rows(spark), cfg, "id")
    assert res.feature_cols == ["x", "per_x"]
    with pytest.raises(ValueError, match="missing inputs"):
        score.score(res.model, spark.createDataFrame([(1.0,)], "x double"))


def test_nothing_stays_cached(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    train.train(spark, _typed_rows(spark), {"data": {"target_column": "y", "feature_columns": ["x"]}, "model": {"type": "linear"}}, "id")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_split_moves_no_rows(spark):
    from tessera.operators.split import cut_folds, train_valid_split
    df = spark.range(1003).withColumnRenamed("id", "k")
    plan = train_valid_split(df, "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    sizes = sorted(r["count"] for r in cut_folds(df, "k", 5).groupBy("fold").count().collect())
    assert sizes == [200, 200, 201, 201, 201]


def test_unknown_parameters_raise(spark):
    import pytest
    with pytest.raises(ValueError, match="reg_lambda"):
        learners.create_learner({"type": "xgboost", "params": {"reg_lambda": 1.0}})
    kept = learners.create_learner({"type": "xgboost", "params": {"reg_lambda": 1.0, "min_child_weight": 3, "n_jobs": -1},
                                    "ignore_params": ["reg_lambda"]})
    assert kept.getMinInstancesPerNode() == 3
    assert learners.create_learner({"type": "randomforest", "params": {"max_features": None}}).getFeatureSubsetStrategy() == "all"


def test_logistic_strength_and_hidden_layers(spark):
    from pyspark.ml.feature import VectorAssembler
    rows = spark.createDataFrame([(float(i % 10), float(i % 3), float(i % 10 > 4)) for i in range(200)], "a double, b double, label double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)
    model = learners.create_learner({"type": "logistic", "task": "classification", "params": {"C": 0.5}}).fit(df)
    assert abs(model.getRegParam() - 1 / (0.5 * 200)) < 1e-12
    mlp = learners.create_learner({"type": "mlp", "task": "classification", "params": {"hidden_layer_sizes": [5], "max_iter": 30}}).fit(df)
    assert list(mlp.getLayers()) == [2, 5, 2]


def test_text_and_missing_columns_raise_before_the_learner(spark):
    """Scoring names the columns that are missing or still text; the plan counts columns by kind."""
    import pytest
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler

    from tessera.plans.features import plan_features
    rows = spark.createDataFrame([(float(i), 2.0 * i) for i in range(20)], "x double, label double")
    model = Pipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), learners.create_learner({"type": "linear"})]).fit(rows)
    with pytest.raises(ValueError, match="text.*x"):
        score.score(model, spark.createDataFrame([("a",)], "x string"))
    with pytest.raises(ValueError, match="missing required columns.*z"):
        score.score(model, rows, {"feature_columns": ["x", "z"], "target_column": "label"})
    df = spark.createDataFrame([(1, 1.0, "a", 1, 0.0)], "id long, x double, c string, is_new int, y double")
    plan = plan_features(df, {"data": {"target_column": "y", "feature_columns": ["x", "c", "is_new"]}, "model": {"type": "linear"}}, id_col="id")
    assert plan.summary["columns"] == {"numeric": 1, "text": 1, "flag": 1}
    assert plan.summary["transformations"][0] == "columns: 1 numeric, 1 text, 1 flag"


def test_learning_rates_mean_what_the_reference_libraries_mean(spark):
    """Two depth-one rounds at rate r give the first leaf mean plus r times the mean residual."""
    from pyspark.ml.feature import VectorAssembler

    from tessera.plans import search
    rows = spark.createDataFrame([(0.0, 0.0), (0.0, 4.0), (1.0, 10.0), (2.0, 16.0)], "x double, label double")
    df = VectorAssembler(inputCols=["x"], outputCol="features").transform(rows)
    learner = learners.create_learner({"type": "xgboost", "params": {"n_estimators": 2, "max_depth": 1, "learning_rate": 0.5}})
    got = {r.x: r.prediction for r in learner.fit(df).transform(df).collect()}
    # first: x = 0 -> 2, x > 0 -> 13; the residuals of x = 0, 1 and of x = 2 are then cut apart: -1 and 3
    assert {k: round(v, 9) for k, v in got.items()} == {0.0: 1.5, 1.0: 12.5, 2.0: 14.5}
    absolute = learners.create_learner({"type": "catboost", "params": {"learning_rate": 0.5, "loss_function": "MAE"}})
    assert (learner.getStepSize(), absolute.getStepSize()) == (0.25, 0.5)
    assert [list(m.values()) for m in search.grid(learner, {"learning_rate": [0.1, 0.2]})] == [[0.05], [0.1]]

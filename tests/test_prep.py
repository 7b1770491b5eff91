import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tessera.operators import prep
from tessera.sources.readers import clean_column_names


@pytest.fixture()
def missing(spark):
    """F4."""
    return spark.createDataFrame([(0, 1.0, "x", 10), (1, 2.0, None, 20), (2, None, "z", 30), (3, 4.0, "w", 40)],
                                 "i int, A double, B string, y long")


def test_mean_impute_and_unknown_f4(spark, missing):
    m = prep.NumericImputer(["A"], "mean").fit(missing)
    out = prep.CategoricalBaseline(["B"]).transform(m.transform(missing)).orderBy("i").collect()
    assert round(out[2].A, 4) == 2.3333
    assert [r.B for r in out] == ["x", "Unknown", "z", "w"]
    assert round(m.fills["A"], 4) == 2.3333


def test_median_exact_and_constant(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 5, 6]] + [(None,)], "x double")
    assert prep.NumericImputer(["x"], "median").fit(df).fills["x"] == 3.5
    assert prep.NumericImputer(["x"], "constant").fit(df).fills["x"] == 0.0


def test_final_sweep(spark, missing):
    out = prep.FillMissing().transform(missing).orderBy("i").collect()
    assert out[2].A == 0.0 and out[1].B == "Unknown"


def test_label_codes_f1_and_unseen(spark, jobs):
    df = clean_column_names(jobs)
    model = prep.LabelEncoder(["Estimator"]).fit(df)
    codes = {r.Estimator: r.code for r in model.mapping.select(F.col("value").alias("Estimator"), "code").collect()}
    assert codes == {"Bob": 0, "Jane": 1, "John": 2}
    new = spark.createDataFrame([("Jane",), ("Zed",), (None,)], "Estimator string")
    assert [r.Estimator for r in model.transform(new).collect()] == [1, -1, -1]


def test_onehot_wide_unseen_all_zero(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "c string")
    model = prep.OneHotWide(["c"]).fit(df)
    assert model.feature_names() == ["c_a", "c_b"]
    out = model.transform(spark.createDataFrame([("a",), ("zz",)], "c string")).collect()
    assert [tuple(r) for r in out] == [(1.0, 0.0), (0.0, 0.0)]


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (4.0, 5.0)], "x double, k double")
    std = prep.Scaler(["x", "k"], "standard").fit(df)
    mean, sd = std.stats["x"]
    assert mean == 2.5 and abs(sd - 1.118033988749895) < 1e-12  # population std
    assert std.stats["k"][1] == 1.0  # constant column -> divide by 1
    mm = prep.Scaler(["x", "k"], "minmax").fit(df).transform(df).collect()
    assert [r.x for r in mm] == [0.0, 1 / 3, 2 / 3, 1.0] and {r.k for r in mm} == {0.0}
    rb = prep.Scaler(["x"], "robust").fit(df)
    assert rb.stats["x"] == [2.5, 1.5]
    assert prep.Scaler(["x"], "weird").getOrDefault("method") == "standard"


def test_stage_roundtrip(spark, jobs, tmp_dir):
    df = clean_column_names(jobs)
    pipe = Pipeline(stages=[prep.CategoricalBaseline(["Estimator"]), prep.NumericImputer(["Job_Value"], "median"),
                            prep.LabelEncoder(["Estimator", "Suburb"]), prep.Scaler(["Job_Value"], "minmax"),
                            prep.FeatureOperations([{"operation": "subtract", "inputs": ["Total_Claimed", "Total_Cost"],
                                                     "output": "Profit"}])])
    model = pipe.fit(df)
    model.write().overwrite().save(tmp_dir + "/m")
    again = PipelineModel.load(tmp_dir + "/m")
    a = model.transform(df).orderBy("Job_Number").collect()
    b = again.transform(df).orderBy("Job_Number").collect()
    assert a == b


def test_label_codes_distributed_path(spark, monkeypatch):
    """Above the local bound the codes come from the distributed rank and the
    map is joined without broadcast; results are the same."""
    from tessera.operators import base
    monkeypatch.setattr(base, "MAP_BYTES", 2)
    monkeypatch.setattr(base, "BROADCAST_ROWS", 2)
    df = spark.createDataFrame([(v,) for v in ["d", "b", "a", "c", "b"]], "x string")
    model = prep.LabelEncoder(["x"]).fit(df)
    got = [r.x for r in model.transform(spark.createDataFrame([("a",), ("d",), ("zz",)], "x string")).collect()]
    assert sorted(got) == [-1, 0, 3]


def test_nan_is_missing(spark):
    """NaN counts as a missing value for every fill and is no part of a mean or median."""
    df = spark.createDataFrame([(float("nan"),), (2.0,), (4.0,), (None,)], "x double")
    for strategy, fill in (("mean", 3.0), ("median", 3.0), ("constant", 0.0)):
        got = sorted(r.x for r in prep.NumericImputer(["x"], strategy).fit(df).transform(df).collect())
        assert got == sorted([fill, fill, 2.0, 4.0]), strategy
    assert sorted(r.x for r in prep.FillMissing().transform(df).collect()) == [0.0, 0.0, 2.0, 4.0]

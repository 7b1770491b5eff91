from pyspark.sql import functions as F

from tessera.operators import target

EST = ["John", "Jane", "John", "Bob", "Jane", "John", "Bob", "Jane", "John", "Bob"]
SAV = [10000, 15000, 12000, 18000, 14000, 11000, 16000, 20000, 11500, 19000]


def _f9(spark):
    return spark.createDataFrame([(i + 1, e, float(s)) for i, (e, s) in enumerate(zip(EST, SAV))],
                                 "Job_ID int, Estimator string, Savings double")


def test_ordered_target_encoding_f9(spark):
    out = target.ordered_target_encode(_f9(spark), "Estimator", "Savings", "Job_ID", "enc").orderBy("Job_ID")
    got = [round(r.enc, 4) for r in out.collect()]
    assert got == [14650.0, 14650.0, 12325.0, 14650.0, 14825.0, 12216.6667, 16325.0, 14550.0, 11912.5, 16216.6667]


def test_smoothed_tiers_f9(spark):
    df = _f9(spark)
    est = target.TargetTierGrouper(["Estimator"], "Savings", smoothing=10)
    means = {r.value: round(r.mean, 4) for r in est.category_means(df).collect()}
    assert means == {"Bob": 15346.1538, "Jane": 15038.4615, "John": 13642.8571}
    model = est.fit(df)
    new = spark.createDataFrame([("Bob",), ("Jane",), ("John",), ("Newbie",), (None,)], "Estimator string")
    assert [r.Estimator_Tier for r in model.transform(new).collect()] == ["Tier_1", "Tier_2", "Tier_3", "Tier_2", "Tier_2"]
    assert "Estimator" not in model.transform(new).columns


def test_tier_fallback_on_duplicate_edges(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 2.0)], "k string, y double")
    model = target.TargetTierGrouper(["k"], "y").fit(df)
    assert {r.k_Tier for r in model.transform(df).collect()} == {"Tier_2"}


def test_rare_grouper_versions(spark):
    fit = spark.createDataFrame([("a",)] * 8 + [("b",)] * 1 + [("c",)] * 1 + [(None,)] * 5, "c string")
    new = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "c string")
    v1 = target.RareCategoryGrouper(["c"], 0.2, version=1).fit(fit).transform(new).collect()
    v2 = target.RareCategoryGrouper(["c"], 0.2, version=2, otherLabel="Other").fit(fit).transform(new).collect()
    assert [r.c for r in v1] == ["a", "Other", "zz", None]
    assert [r.c for r in v2] == ["a", "Other", "Other", "Other"]
    assert F is not None

from pyspark.sql import functions as F

from tessera.functions import bins


def test_cut_labels_f10(spark):
    df = spark.createDataFrame([(x,) for x in [18, 22, 25, 40, 45, 60, 85, 0]], "age int")
    out = df.select(bins.cut("age", [0, 25, 50, 100], ["Youth", "Middle-Aged", "Senior"]).alias("g")).collect()
    assert [r.g for r in out] == ["Youth"] * 3 + ["Middle-Aged"] * 2 + ["Senior"] * 2 + [None]


def test_equal_width_f10(spark):
    df = spark.createDataFrame([(x,) for x in [18, 22, 25, 40, 45, 60, 85]], "age int")
    out = bins.equal_width_bins(df, "age", 3).groupBy("bin").count().orderBy("bin").collect()
    assert [(r.bin, r["count"]) for r in out] == [(0, 4), (1, 2), (2, 1)]


def test_qcut_f10(spark):
    vals = [1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 2.5]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(vals)], "i int, s double")
    assert bins.quantile_edges(df, "s", 4) == [1.0, 2.75, 5.0, 7.5, 10.0]
    out = bins.qcut(df, "s", 3, ["Bronze", "Silver", "Gold"], out="t").orderBy("i").collect()
    assert [r.t for r in out] == ["Bronze"] * 3 + ["Silver"] * 3 + ["Gold"] * 4 + ["Bronze"]


def test_poly_terms_order():
    names = [n for n, _ in bins.poly_terms(["a", "b"], 2)]
    assert names == ["a", "b", "a^2", "a b", "b^2"]
    names = [n for n, _ in bins.poly_terms(["a", "b", "c"], 3, interaction_only=True, include_bias=True)]
    assert names == ["1", "a", "b", "c", "a b", "a c", "b c", "a b c"]


def test_poly_values(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    row = bins.polynomial_features(df, ["a", "b"], 2).first()
    assert list(row) == [2.0, 3.0, 4.0, 6.0, 9.0]
    assert F is not None

import math

from pyspark.sql import functions as F

from tessera.operators import split


def test_split_exact_sizes_and_deterministic(spark):
    df = spark.range(1001).withColumnRenamed("id", "k")
    s1 = split.train_valid_split(df, "k", 0.2, seed=42)
    counts = {r.split: r["count"] for r in s1.groupBy("split").count().collect()}
    assert counts == {"valid": math.ceil(1001 * 0.2), "train": 1001 - math.ceil(1001 * 0.2)}
    s2 = split.train_valid_split(df.repartition(5), "k", 0.2, seed=42)
    assert sorted(s1.collect()) == sorted(s2.collect())


def test_kfold_disjoint_balanced(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    f = split.kfold(df, "k", 5)
    sizes = sorted(r["count"] for r in f.groupBy("fold").count().collect())
    assert sizes == [20, 20, 21, 21, 21] and f.select("k").distinct().count() == 103


def test_contiguous_and_stratified(spark):
    df = spark.range(10).withColumnRenamed("id", "k").withColumn("y", (F.col("k") % 2).cast("int"))
    c = {r.k: r.fold for r in split.contiguous_folds(df, "k", 3).collect()}
    assert [c[i] for i in range(10)] == [0, 0, 0, 0, 1, 1, 1, 2, 2, 2]
    s = split.stratified_folds(df, "k", "y", 5).groupBy("fold", "y").count().collect()
    assert all(r["count"] == 1 for r in s)


def test_hash_split_close(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    share = split.hash_split(df, "k", 0.2).where("split = 'valid'").count() / 20000
    assert abs(share - 0.2) < 0.02


def test_hash_folds_cover_all(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    f = split.hash_folds(df, "k", 5)
    sizes = {r.fold: r["count"] for r in f.groupBy("fold").count().collect()}
    assert set(sizes) == set(range(5)) and all(abs(v - 1000) < 150 for v in sizes.values())

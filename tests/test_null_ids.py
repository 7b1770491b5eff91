"""Null and repeated ids lose or multiply no row in splits, folds, samples and ordered statistics."""

import math

import pytest
from pyspark.sql import functions as F

from tessera.operators import boosting, split, target
from tessera.plans import train


@pytest.fixture(scope="module")
def odd(spark):
    """90 rows with ids (every id of 30 three times) and 10 without, all rows different."""
    rows = [(i % 30, f"c{i % 4}", float(i), "ab"[i % 2]) for i in range(90)] + [(None, "c1", 1000.0 + i, None if i < 5 else "a") for i in range(10)]
    return spark.createDataFrame(rows, "id long, c string, y double, label string").repartition(4).cache()


def values(df):
    return sorted(r.y for r in df.collect())


def test_exact_split_sizes(odd):
    for size in (0.2, 0.33, 0.5):
        out = split.train_valid_split(odd, "id", size)
        assert values(out) == values(odd)
        assert out.where("split = 'valid'").count() == math.ceil(100 * size)


def test_exact_training_folds(odd):
    out = split.cut_folds(odd, "id", 3)
    assert values(out) == values(odd)
    assert sorted(r["count"] for r in out.groupBy("fold").count().collect()) == [33, 33, 34]


def test_rank_folds_keep_every_row(odd):
    for out in (split.kfold(odd, "id", 3), split.contiguous_folds(odd, "id", 3), split.stratified_folds(odd, "id", "label", 3)):
        assert values(out) == values(odd)
        assert {r.fold for r in out.select("fold").distinct().collect()} == {0, 1, 2}
    for out in (split.kfold(odd, "id", 3), split.contiguous_folds(odd, "id", 3)):
        assert out.groupBy("id").agg(F.count_distinct("fold").alias("n")).where("n > 1").count() == 0
    sizes = split.contiguous_folds(odd, "id", 4).select("id", "fold").distinct().groupBy("fold").count().orderBy("fold").collect()
    assert [r["count"] for r in sizes] == [8, 8, 8, 7]  # 30 ids and the null one, null first
    assert split.contiguous_folds(odd, "id", 4).where("id is null and fold <> 0").count() == 0


def test_fewer_ids_than_folds(spark):
    df = spark.createDataFrame([(None, 1.0), (1, 2.0), (1, 3.0)], "id long, y double")
    for out in (split.kfold(df, "id", 5), split.contiguous_folds(df, "id", 5)):
        assert values(out) == [1.0, 2.0, 3.0]


def test_all_ids_null(spark):
    df = spark.range(50).select(F.lit(None).cast("long").alias("id"), F.col("id").cast("double").alias("y"))
    assert split.train_valid_split(df, "id", 0.2).where("split = 'valid'").count() == 10
    assert values(split.kfold(df, "id", 3)) == values(df)


def test_goss_sizes(odd):
    df = odd.withColumn("g", F.col("y") - 45.0)
    out = boosting.goss_sample(df, "id", "g", 0.2, 0.1)
    top = sorted((abs(r.g) for r in out.where("part = 'top'").collect()), reverse=True)
    assert top == sorted((abs(r.g) for r in df.collect()), reverse=True)[:20]
    assert out.where("part = 'sampled'").count() == 10 and out.select("y").distinct().count() == 30
    assert {round(r.weight, 9) for r in out.where("part = 'sampled'").select("weight").collect()} == {8.0}
    assert boosting.goss_sample(df, "id", "g", 0.0, 0.0).count() == 0


def test_ordered_encoding_keeps_every_row(odd):
    out = target.ordered_target_encode(odd, "c", "y", "id", "enc")
    assert values(out) == values(odd) and out.columns == ["id", "c", "y", "label", "enc"]
    prior = sum(values(odd)) / 100
    for cat, rows in {c: [r for r in out.collect() if r.c == c] for c in ("c0", "c1", "c2", "c3")}.items():
        # whatever the order within an id, the first row has the prior alone and each value is a mean of earlier ones
        assert min(abs(r.enc - prior) for r in rows) < 1e-9
        by_id = sorted({(r.id is not None, r.id or 0) for r in rows})
        done, total = 0, 0.0
        for key in by_id:
            own = [r for r in rows if (r.id is not None, r.id or 0) == key]
            first = [r for r in own if abs(r.enc - (total + prior) / (done + 1)) < 1e-6]
            assert first
            done, total = done + len(own), total + sum(r.y for r in own)


def test_training_with_null_ids(odd):
    cfg = {"data": {"target_column": "y", "feature_columns": ["c"]}, "model": {"type": "decisiontree", "params": {"max_depth": 2}}, "cv_folds": 3}
    for model in ({"type": "linear"}, cfg["model"]):
        res = train.train(odd.sparkSession, odd, {**cfg, "model": model}, "id")
        assert res.metrics["RMSE"] > 0 and res.cv.count() == 1


def test_ranges_follow_the_input(spark):
    from tessera.operators.ordered import PARTITION_BYTES, _num_partitions
    small = spark.range(100)
    assert _num_partitions(small, None) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    big = spark.range(PARTITION_BYTES * 10)  # 8 bytes a row, never run
    assert _num_partitions(big, None) == 80

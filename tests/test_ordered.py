"""The distributed prefix sum must equal a plain sequential scan, also when
one key holds a third of all rows and under different partition counts."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators.ordered import dense_codes, global_rank, ordered_prefix


def _data(n=600, seed=7):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        rows.append((i, key, float(rng.randint(-5, 20))))
    return rows


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_prefix_matches_brute_force(spark, parts):
    rows = _data()
    df = spark.createDataFrame(rows, "id int, k string, v double")
    out = ordered_prefix(df, ["id"], {"s": F.col("v"), "c": F.lit(1)}, partition_by=["k"], inclusive=False,
                         num_partitions=parts)
    got = {r.id: (r.s, r.c) for r in out.collect()}
    acc: dict = {}
    for i, k, v in rows:
        s, c = acc.get(k, (0.0, 0))
        assert got[i] == (s, c)
        acc[k] = (s + v, c + 1)


@pytest.mark.parametrize("parts", [1, 5])
def test_global_rank_is_row_number(spark, parts):
    rows = _data(300)
    df = spark.createDataFrame(rows, "id int, k string, v double")
    got = {r.id: r.rank for r in global_rank(df, ["v", "id"], num_partitions=parts).collect()}
    want = {row[0]: i + 1 for i, row in enumerate(sorted(rows, key=lambda r: (r[2], r[0])))}
    assert got == want


def test_dense_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "x string")
    assert {r.x: r.code for r in dense_codes(df, "x").collect()} == {"a": 0, "b": 1, "c": 2}

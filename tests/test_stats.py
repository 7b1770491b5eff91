import random

import pytest
from pyspark.sql import functions as F

from tessera.functions import stats

PROBS = [0.0, 0.1, 1 / 3, 0.5, 2 / 3, 0.75, 1.0]


@pytest.mark.parametrize("limit", [2_000_000, 5])
def test_exact_quantiles_match_spark_percentile(spark, monkeypatch, limit):
    """Both the direct path and the bracketing path (tiny distinct limit), with
    one value holding a third of the rows, nulls and NaN."""
    monkeypatch.setattr(stats, "DISTINCT_LIMIT", limit)
    rng = random.Random(11)
    rows = [(7.0,) if i % 3 == 0 else (round(rng.uniform(-50, 50), 2),) for i in range(3000)]
    rows += [(None,), (float("nan"),)]
    df = spark.createDataFrame(rows, "x double")
    got = stats.quantiles(df, ["x"], PROBS)["x"]
    clean = df.where(~F.isnan("x"))
    want = clean.agg(F.percentile("x", F.array(*[F.lit(p) for p in PROBS]))).first()[0]
    assert got == pytest.approx(want, abs=1e-9)


def test_empty_and_constant(spark):
    df = spark.createDataFrame([(None, 3.0), (None, 3.0)], "a double, b double")
    q = stats.quantiles(df, ["a", "b"], [0.5])
    assert q == {"a": [None], "b": [3.0]}

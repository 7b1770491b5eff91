"""Property tests (hypothesis) against plain-Python definitions."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.functions import bins, stats

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))

values = st.lists(st.one_of(st.integers(-20, 20).map(float), st.floats(-1e3, 1e3, allow_nan=False), st.none()),
                  min_size=1, max_size=60)


@SETTINGS
@given(values, st.sampled_from([2_000_000, 3]))
def test_quantiles_match_numpy(spark, xs, limit):
    old = stats.DISTINCT_LIMIT
    stats.DISTINCT_LIMIT = limit  # 3 forces the bracketing path
    try:
        df = spark.createDataFrame([(x,) for x in xs] + [(float("nan"),)], "x double")
        probs = [0.0, 0.2, 1 / 3, 0.5, 0.9, 1.0]
        got = stats.quantiles(df, ["x"], probs)["x"]
    finally:
        stats.DISTINCT_LIMIT = old
    clean = [x for x in xs if x is not None]
    if not clean:
        assert got == [None] * len(probs)
    else:
        want = np.percentile(np.array(clean), [p * 100 for p in probs], method="linear")
        assert np.allclose(got, want, rtol=1e-12, atol=1e-9)


@SETTINGS
@given(st.lists(st.floats(-100, 100, allow_nan=False), min_size=1, max_size=40),
       st.lists(st.floats(-50, 50, allow_nan=False), min_size=2, max_size=5, unique=True))
def test_cut_right_closed(spark, xs, edges):
    edges = sorted(edges)
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xs)], "i int, x double")
    got = [r.b for r in df.select("i", bins.cut("x", edges).alias("b")).orderBy("i").collect()]
    want = []
    for x in xs:
        idx = None
        for j in range(len(edges) - 1):
            if edges[j] < x <= edges[j + 1]:
                idx = j
                break
        want.append(idx)
    assert got == want

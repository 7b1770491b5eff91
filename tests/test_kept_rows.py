"""The job table is computed once for each training query: every row of it passes a counter once. Budgets are small here."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.plans import q_extra, q_train, search
from tessera.plans.q_train import _one_cfg
from tessera.session import kept

from conftest import SF_SMALL

TREE = _one_cfg("decisiontree", {"max_depth": 2})
TRAINING = {"experiment_log": TREE, "mlp_regressor": _one_cfg("mlp", {"max_iter": 2}), "train_gbt": TREE, "adaptive_search": None,
            "random_search": None, "train_forest": TREE, "training_history": _one_cfg("lightgbm", {"n_estimators": 2, "max_depth": 2}),
            "tree_stats": TREE, "cv_test_gap": None, "prediction_summary": None}


@pytest.mark.parametrize("name", TRAINING)
def test_job_table_is_computed_once(spark, monkeypatch, name):
    seen, jobs, adaptive = spark.sparkContext.accumulator(0), q_train.order_jobs, search.adaptive_search
    n = jobs(spark, SF_SMALL).count()

    def passed(v):
        seen.add(1)
        return v

    counter = F.udf(passed, "double").asNondeterministic()
    monkeypatch.setattr(q_train, "order_jobs", lambda s, d: jobs(s, d).withColumn("saving", counter("saving")))
    monkeypatch.setattr(search, "adaptive_search", lambda *a, **k: adaptive(*a, **k | {"n_trials": 2}))
    if TRAINING[name]:
        for module in (q_train, q_extra):
            monkeypatch.setattr(module, "_cfg", lambda *a, **k: dict(TRAINING[name]))
    assert entry.queries()[name](spark, SF_SMALL).count() > 0
    assert seen.value == n


def test_kept_rows_are_released_and_a_callers_are_not(spark):
    df = spark.range(10).persist()
    with kept(df) as held:
        assert held is df
    assert df.storageLevel.useMemory
    df.unpersist()
    with pytest.raises(ValueError), kept(spark.range(11)) as held:
        assert held.storageLevel.useMemory
        raise ValueError
    assert not held.storageLevel.useMemory

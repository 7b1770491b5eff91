import __spark_entry__ as entry

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1 and df.columns == ["c_mktsegment", "avg_profit", "n_rows"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_some_queries_on_smallest_sf(spark):
    qs = entry.queries()
    for name in ["describe_numeric", "tier_smoothed", "split_exact", "roc_auc", "ordered_target_encoding"]:
        assert qs[name](spark, SF_SMALL).count() >= 1


def test_prediction_summary_trains_and_scores(spark):
    """The name stands for the trained model's predictions of every order; group means of a quantity never exceed 50."""
    qs = entry.queries()
    row = qs["prediction_summary"](spark, SF_SMALL).first()
    assert row.max > 50 and row == qs["predicted_value_summary"](spark, SF_SMALL).first()
    assert qs["group_mean_summary"](spark, SF_SMALL).first().max <= 50

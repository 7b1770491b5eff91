import pytest

from tessera.sources import readers
from tessera.sources.sinks import RunLog, write_table


def test_read_errors(spark, tmp_dir):
    with pytest.raises(FileNotFoundError):
        readers.read_table(spark, tmp_dir + "/nope.parquet")
    with pytest.raises(ValueError, match="excel"):
        readers.read_table(spark, "jobs.xlsx")
    with pytest.raises(ValueError, match="Unsupported"):
        readers.read_table(spark, "x", file_type="feather")


def test_csv_roundtrip_and_projection(spark, tmp_dir, jobs):
    clean = readers.clean_column_names(jobs)
    clean.write.option("header", True).csv(tmp_dir + "/jobs")
    back = readers.read_table(spark, "jobs", file_type="csv", columns=["Job_Number", "Estimator"], base_dir=tmp_dir)
    assert back.columns == ["Job_Number", "Estimator"] and back.count() == 5


def test_required_columns():
    assert readers.required_feature_columns({"columns_needed": ["a b", "t"], "target_column": "t"}) == ["a_b"]
    with pytest.raises(ValueError):
        readers.required_feature_columns({})


def test_run_log_appends_in_order_f6(spark, tmp_dir):
    log = RunLog(tmp_dir + "/log")
    log.append(spark, "exp1", {"MAE": 1.0}, {"maxDepth": 3})
    log.append(spark, "exp2", {"MAE": 2.0, "note": "x"}, {})
    rows = log.read(spark).collect()
    assert [r.experiment_name for r in rows] == ["exp1", "exp2"]
    assert rows[0].metrics == {"MAE": 1.0} and rows[0].model_params == {"maxDepth": "3"}


def test_load_config(tmp_dir):
    path = tmp_dir + "/job.yaml"
    for text, want in (("a: {b: [1, x]}", {"a": {"b": [1, "x"]}}), ("", {})):
        with open(path, "w") as fh:
            fh.write(text)
        assert readers.load_config(path) == want
    with open(path, "w") as fh:
        fh.write("- a list")
    with pytest.raises(ValueError, match="mapping"):
        readers.load_config(path)


@pytest.mark.parametrize("fmt", ["parquet", "csv", "json", "orc"])
def test_write_table(spark, tmp_dir, fmt):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None), (3, "c, \"d\"", -0.5)], "k long, t string, v double")
    for rows in (df, df.where("k > 1"), df.limit(0)):  # a second write takes the place of the first
        write_table(rows, f"{tmp_dir}/deep/er/{fmt}", fmt)
        back = readers.read_table(spark, f"{tmp_dir}/deep/er/{fmt}", fmt, schema=df.schema)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))
    write_table(df, f"{tmp_dir}/parts/{fmt}", fmt, partition_by=["k"])
    assert readers.read_table(spark, f"{tmp_dir}/parts/{fmt}", fmt).where("k = 3").count() == 1


def test_scores_of_unknown_names():
    from tessera.plans.search import evaluator_for
    with pytest.raises(ValueError, match="unknown scoring"):
        evaluator_for("charm")


def test_unknown_search_method(spark):
    from tessera.plans import train
    df = spark.createDataFrame([(i, float(i), float(i % 7)) for i in range(60)], "id long, x double, y double")
    cfg = {"data": {"target_column": "y", "feature_columns": ["x"]},
           "model": {"type": "ridge", "hyperparameter_search": {"enabled": True, "method": "astrology", "param_distributions": {"alpha": [1.0]}}}}
    with pytest.raises(ValueError, match="Unsupported search method"):
        train.train(spark, df, cfg, "id")
    cfg["model"]["hyperparameter_search"]["enabled"] = False  # a search that is off is not looked at
    assert train.train(spark, df, cfg, "id").best_params is None


def test_register_operation(spark):
    from pyspark.sql import functions as F
    from tessera.functions import ops
    ops.register_operation("twice", lambda inputs: inputs[0] * 2)
    try:
        df, _ = ops.apply_operations(spark.range(3), [{"name": "d", "operation": "twice", "inputs": ["id"], "output": "d"}], "raise")
        assert [r.d for r in df.orderBy("id").collect()] == [0, 2, 4] and ops.get_operation("twice")([F.lit(1)]) is not None
    finally:
        ops.OPERATIONS.pop("twice")
    with pytest.raises(ValueError, match="not found"):
        ops.get_operation("twice")

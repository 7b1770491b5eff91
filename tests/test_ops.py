import pytest
from pyspark.sql import functions as F

from tessera.functions import ops
from tessera.sources.readers import clean_column_names


def _col(df, c="C"):
    return [r[0] for r in df.select(c).collect()]


def _frame(spark, a, b):
    rows = [(float(x), float(y)) for x, y in zip(a, b)]
    return spark.createDataFrame(rows, "A double, B double").withColumn("i", F.monotonically_increasing_id())


@pytest.mark.parametrize("op,a,b,expected", [
    ("subtract", [10, 20, 30], [3, 5, 7], [7, 15, 23]),
    ("add", [1, 2, 3], [4, 5, 6], [5, 7, 9]),
    ("multiply", [2, 3, 4], [5, 6, 7], [10, 18, 28]),
    ("divide", [10, 20, 30], [2, 4, 6], [5, 5, 5]),
    ("divide", [10, 20], [0, 5], [None, 4]),
    ("divide_percent", [10, 20], [100, 200], [10, 10]),
])
def test_operations_f3(spark, op, a, b, expected):
    df = _frame(spark, a, b)
    out, applied = ops.apply_operations(df, [{"operation": op, "inputs": ["A", "B"], "output": "C"}])
    assert _col(out.orderBy("i")) == expected
    assert applied[0]["output"] == "C"


def test_registry_unknown_raises():
    with pytest.raises(ValueError, match="not found"):
        ops.get_operation("nope")


def test_log_is_log1p(spark):
    df = _frame(spark, [0.0, 1.0], [0.0, 0.0])
    out, _ = ops.apply_operations(df, [{"operation": "log", "inputs": ["A"], "output": "C"}])
    vals = _col(out.orderBy("i"))
    assert vals[0] == 0.0 and abs(vals[1] - 0.6931471805599453) < 1e-12


def test_chain_and_invalid_op_skipped(spark, jobs):
    df = clean_column_names(jobs)
    out, applied = ops.apply_operations(df, [
        {"name": "profit", "operation": "subtract", "inputs": ["Total_Claimed", "Total_Cost"], "output": "Profit"},
        {"name": "margin", "type": "divide_percent", "inputs": ["Profit", "Job_Value"], "output": "Margin"},
        {"name": "bad", "operation": "invalid_op", "inputs": ["A"], "output": "X"},
        {"name": "missing", "operation": "add", "inputs": ["nope", "Job_Value"], "output": "Y"},
        {"inputs": ["Job_Value"], "output": "Z"},
    ])
    rows = out.orderBy("Job_Number").select("Profit", "Margin").collect()
    assert [r[0] for r in rows] == [200, 500, 500, 800, 1000]
    assert [round(r[1], 4) for r in rows] == [4.0, 6.25, 5.0, 6.6667, 6.6667]
    assert [a["output"] for a in applied] == ["Profit", "Margin"]
    assert "X" not in out.columns and "Y" not in out.columns and "Z" not in out.columns
    with pytest.raises(ValueError):
        ops.apply_operations(df, [{"operation": "invalid_op", "inputs": ["A"], "output": "X"}], on_error="raise")


def test_ratio_flags_scores(spark):
    df = spark.createDataFrame([(1.0, 0.0, 1, None), (4.0, 2.0, 0, 1), (None, 2.0, None, 0)],
                               "a double, b double, f1 int, f2 int")
    r = df.select(ops.ratio("a", "b", "zero").alias("z"), ops.ratio("a", "b", "null").alias("n"),
                  ops.ratio("a", "b", "fill0").alias("f"), ops.flag_or("f1", "f2").alias("o"),
                  ops.flag_and(F.col("f1") == 1, F.col("f2") == 1).alias("an"),
                  ops.weighted_score({"f1": 3, "f2": 2}).alias("w"), ops.row_sum(["f1", "f2"]).alias("s")).collect()
    assert [x.z for x in r] == [0.0, 2.0, None]
    assert [x.n for x in r] == [None, 2.0, None]
    assert [x.f for x in r] == [0.0, 2.0, 0.0]
    assert [x.o for x in r] == [1, 1, 0]
    assert [x.an for x in r] == [0, 0, 0]
    assert [x.w for x in r] == [3.0, 2.0, 0.0]
    assert [x.s for x in r] == [1.0, 1.0, 0.0]


def test_symlog_roundtrip(spark):
    df = spark.createDataFrame([(-1000.5,), (0.0,), (3.25,)], "x double")
    back = df.select(ops.symexp(ops.symlog("x")).alias("y"), "x").collect()
    assert all(abs(r.y - r.x) < 1e-9 for r in back)


def test_clean_names_collision(spark):
    df = spark.createDataFrame([(1, 2)], ["a b", "a_b"])
    with pytest.raises(ValueError, match="collide"):
        clean_column_names(df)

"""Registered queries: configs, file formats, fills and scalers by their rules, literal rows, operations and scores by name."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ..functions.ops import OPERATIONS, apply_operations, register_operation
from ..operators.base import CrossFitPipeline
from ..operators.prep import FillMissing, Scaler, assert_numeric, column_kinds
from ..session import shared_dir
from ..sources.readers import clean_column_names, clean_name, load_config, read_table, required_feature_columns, validate_columns
from ..sources.sinks import write_table
from . import learners, score, search
from .q_native import TREE_SQL
from .tables import table

Q, O = {}, {}


def q(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            O[name] = sql
        return fn
    return deco


FORMATS = (("parquet", None), ("csv", None), ("json", None), ("orc", None), ("parquet", ["status"]))

_FORMAT_SQL = """SELECT '{name}' AS format, count(*) AS n_rows, count(nullif(o_orderstatus, 'P')) AS n_status, round(sum(o_totalprice), 2) AS total,
CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day FROM orders"""


@q("table_formats", " UNION ALL ".join(_FORMAT_SQL.format(name=f + (" by " + p[0] if p else "")) for f, p in FORMATS))
def table_formats(spark, sf):
    """Orders with missing statuses written in every format, one table by partitions, and read back."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"), "o_totalprice",
                                               F.to_date("o_orderdate").alias("day"))
    out = None
    for fmt, by in FORMATS:
        path = f"{shared_dir(spark)}/formats-{uuid.uuid4().hex}"
        write_table(orders, path, fmt, partition_by=by)
        schema = None if by else orders.schema
        back = read_table(spark, path, fmt, columns=["status", "o_totalprice", "day"], schema=schema)
        part = back.agg(F.count("*").alias("n_rows"), F.count("status").alias("n_status"), F.round(F.sum("o_totalprice"), 2).alias("total"),
                        F.min("day").alias("first_day"), F.max("day").alias("last_day"))
        part = part.select(F.lit(fmt + (" by " + by[0] if by else "")).alias("format"), "*")
        out = part if out is None else out.unionByName(part)
    return out


JOB_YAML = """
experiment_name: read orders
data:
  file_path: orders.parquet
  file_type: parquet
  columns_needed: [o_custkey, o_totalprice, o_orderstatus]
  target_column: o_totalprice
"""


@q("config_read", """SELECT o_orderstatus, count(*) AS n_rows, count(DISTINCT o_custkey) AS customers, 'o_custkey,o_orderstatus' AS columns
FROM orders GROUP BY o_orderstatus""")
def config_read(spark, sf):
    """A YAML job names a table relative to its folder; its features come out in the config's order."""
    with tempfile.TemporaryDirectory() as folder:  # read on the driver only
        path = os.path.join(folder, "job.yaml")
        with open(path, "w", encoding="utf-8") as fh:
            fh.write(JOB_YAML)
        data = load_config(path)["data"]
    rows = read_table(spark, data["file_path"], data["file_type"], base_dir=sf)
    rows = validate_columns(clean_column_names(rows), required_feature_columns(data))
    return rows.groupBy("o_orderstatus").agg(F.count("*").alias("n_rows"), F.count_distinct("o_custkey").alias("customers")).withColumn(
        "columns", F.lit(",".join(rows.columns)))


@q("column_report", """SELECT kind, CAST(count(*) AS INTEGER) AS columns, string_agg(column_name, ',' ORDER BY column_name) AS names
FROM (SELECT column_name, CASE WHEN column_type = 'VARCHAR' THEN 'text' WHEN column_type IN ('BOOLEAN') THEN 'flag' ELSE 'numeric' END AS kind
      FROM (DESCRIBE SELECT l_orderkey, l_quantity, l_tax, l_returnflag, l_linestatus, l_quantity > 25 AS is_bulk, l_tax > 0.04 AS is_taxed FROM lineitem))
GROUP BY kind UNION ALL SELECT 'guarded', 2, 'l_linestatus,l_returnflag'""")
def column_report(spark, sf):
    """Columns by kind from the schema, and those that the guard of numeric learners names."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_quantity", "l_tax", "l_returnflag", "l_linestatus",
                                               (F.col("l_quantity") > 25).alias("is_bulk"), (F.col("l_tax") > 0.04).alias("is_taxed"))
    kinds = {k: sorted(v) for k, v in column_kinds(rows).items()}
    kinds["guarded"] = []
    for c in sorted(rows.columns):
        try:
            assert_numeric(rows, [c])
        except ValueError:
            kinds["guarded"].append(c)
    return spark.createDataFrame([(k, len(v), ",".join(v)) for k, v in kinds.items()], "kind string, columns int, names string")


@q("fill_stateless", """SELECT coalesce(nullif(l_returnflag, 'N'), 'missing') AS flag, CAST(sum(coalesce(nullif(CAST(l_tax > 0.04 AS INTEGER), 1), 0)) AS BIGINT) AS taxed,
round(sum(coalesce(nullif(l_quantity, 25), 0)), 2) AS quantity, count(*) AS n_rows FROM lineitem GROUP BY 1""")
def fill_stateless(spark, sf):
    """M6: missing numbers and flags become 0, missing text 'missing', without a fit."""
    rows = table(spark, sf, "lineitem").select(
        F.nullif("l_returnflag", F.lit("N")).alias("flag"), F.nullif((F.col("l_tax") > 0.04).cast("int"), F.lit(1)).alias("taxed"),
        F.when(F.col("l_quantity") == 25, F.lit(float("nan"))).otherwise(F.col("l_quantity").cast("double")).alias("quantity"))
    return FillMissing(0.0, "missing").transform(rows).groupBy("flag").agg(
        F.sum("taxed").alias("taxed"), F.round(F.sum("quantity"), 2).alias("quantity"), F.count("*").alias("n_rows"))


@q("scale_unknown_method", """WITH m AS (SELECT avg(l_quantity) AS a, stddev_pop(l_quantity) AS s FROM lineitem)
SELECT l_returnflag, round(avg((l_quantity - a) / s), 6) AS mean, round(max((l_quantity - a) / s), 6) AS top, 'standard' AS method
FROM lineitem, m GROUP BY l_returnflag""")
def scale_unknown_method(spark, sf):
    """SC4: a method that is not known scales like the standard one."""
    rows = table(spark, sf, "lineitem").select("l_returnflag", F.col("l_quantity").cast("double").alias("x"))
    scaler = Scaler(["x"], method="quantum")
    return scaler.fit(rows).transform(rows).groupBy("l_returnflag").agg(F.round(F.avg("x"), 6).alias("mean"), F.round(F.max("x"), 6).alias("top")).withColumn(
        "method", F.lit(scaler.getOrDefault("method")))


@q("registered_operation", """SELECT l_returnflag, round(avg(sqrt(l_quantity * l_extendedprice)), 4) AS mean_size FROM lineitem GROUP BY l_returnflag""")
def registered_operation(spark, sf):
    """An operation of the user's own, registered by name and used from a config's list."""
    def build(inputs):
        return F.sqrt(inputs[0].cast("double") * inputs[1])

    register_operation("geometric_mean", build)
    try:
        rows, _ = apply_operations(table(spark, sf, "lineitem").select("l_returnflag", "l_quantity", "l_extendedprice"), [
            {"name": "size", "operation": "geometric_mean", "inputs": ["l_quantity", "l_extendedprice"], "output": "size"}], "raise")
    finally:
        OPERATIONS.pop("geometric_mean")
    return rows.groupBy("l_returnflag").agg(F.round(F.avg("size"), 4).alias("mean_size"))


@q("scores_by_name", """WITH p AS (SELECT l_returnflag = 'R' AS y, l_quantity > 25 AS p FROM lineitem),
c AS (SELECT count(*) FILTER (WHERE y AND p) AS tp, count(*) FILTER (WHERE NOT y AND p) AS fp, count(*) FILTER (WHERE y AND NOT p) AS fn,
      count(*) FILTER (WHERE NOT y AND NOT p) AS tn FROM p)
SELECT 'balanced_accuracy' AS scoring, round((tp / (tp + fn) + tn / (tn + fp)) / 2, 6) AS value, true AS larger_is_better FROM c
UNION ALL SELECT 'f1_macro', round((2 * tp / (2 * tp + fp + fn) + 2 * tn / (2 * tn + fp + fn)) / 2, 6), true FROM c
UNION ALL SELECT 'accuracy', round((tp + tn) / (tp + fp + fn + tn), 6), true FROM c
UNION ALL SELECT 'neg_root_mean_squared_error', round(sqrt((fp + fn) / (tp + fp + fn + tn)), 6), false FROM c""")
def scores_by_name(spark, sf):
    """Evaluators by the name of a score, on a rule's predictions."""
    rows = table(spark, sf, "lineitem").select((F.col("l_returnflag") == "R").cast("double").alias("label"),
                                               (F.col("l_quantity") > 25).cast("double").alias("prediction"))
    names = ("balanced_accuracy", "f1_macro", "accuracy", "neg_root_mean_squared_error")
    found = [(n, search.evaluator_for(n)) for n in names]
    return spark.createDataFrame([(n, round(e.evaluate(rows), 6), e.isLargerBetter()) for n, e in found],
                                 "scoring string, value double, larger_is_better boolean")


@q("score_literal_rows", """WITH f AS (SELECT regr_slope(o_custkey, o_totalprice) AS b, regr_intercept(o_custkey, o_totalprice) AS a FROM orders)
SELECT name, round(a + b * x, 3) AS "Predicted_o_custkey", true AS stamped, 'linear' AS "Model_Type"
FROM f, (VALUES ('small', 1000.0), ('large', 250000.0), ('none', 0.0)) v(name, x)""")
def score_literal_rows(spark, sf):
    """S6, T25 and the time stamp: a fitted model on rows written down in the program."""
    rows = table(spark, sf, "orders").select("o_totalprice", F.col("o_custkey").cast("double").alias("label"))
    model = CrossFitPipeline(stages=[VectorAssembler(inputCols=["o_totalprice"], outputCol="features"),
                                     learners.create_learner({"type": "linear"})]).fit(rows)
    own = spark.createDataFrame([("small", 1000.0), ("large", 250000.0), ("none", 0.0)], "name string, o_totalprice double")
    data = {"target_column": "o_custkey", "feature_columns": ["o_totalprice"]}
    stamp = F.abs(F.unix_timestamp("Prediction_Timestamp") - F.unix_timestamp(F.current_timestamp())) < 3600
    scored = score.score(model, own, data, keep=["name"])
    return scored.select("name", F.round(f"Predicted_{clean_name('o_custkey')}", 3).alias("Predicted_o_custkey"), stamp.alias("stamped"), "Model_Type")


@q("forest_by_value", TREE_SQL)
def forest_by_value(spark, sf):
    """L XGBoost forest by value: one tree on all rows, as no sample is drawn: the ranges, rows and means of its leaves."""
    rows = table(spark, sf, "lineitem").select(F.col("l_quantity").alias("x"), F.col("l_extendedprice").alias("label"))
    params = {"n_estimators": 1, "max_depth": 2, "border_count": 64, "bootstrap": False}
    model = CrossFitPipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"),
                                     learners.create_learner({"type": "xgboost_rf", "params": params})]).fit(rows)
    return model.transform(rows).groupBy("prediction").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("*").alias("rows")).select(
        "lo", "hi", "rows", F.round("prediction", 4).alias("prediction"))


@q("mlp_separable", """SELECT CAST(l_quantity > 25 AS INTEGER) AS predicted, count(*) AS n_rows, min(l_quantity) AS lo, max(l_quantity) AS hi
FROM lineitem WHERE l_quantity NOT BETWEEN 15 AND 35 GROUP BY 1""")
def mlp_separable(spark, sf):
    """L MLP classifier: classes with a gap between them are told apart on every row."""
    rows = table(spark, sf, "lineitem").where("l_quantity not between 15 and 35").select(
        "l_quantity", (F.col("l_quantity") / 50 - 0.5).alias("x"), (F.col("l_quantity") > 25).cast("double").alias("label"))
    learner = learners.create_learner({"type": "mlp", "task": "classification", "params": {"hidden_layer_sizes": [4], "max_iter": 60}})
    model = CrossFitPipeline(stages=[VectorAssembler(inputCols=["x"], outputCol="features"), learner]).fit(rows)
    return model.transform(rows).groupBy(F.col("prediction").cast("int").alias("predicted")).agg(
        F.count("*").alias("n_rows"), F.min("l_quantity").alias("lo"), F.max("l_quantity").alias("hi"))

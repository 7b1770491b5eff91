"""Physical-plan regression checks: pruning, pushdown, aggregation before
joins, no single-partition exchange in the distributed ordered operators."""

import re

import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL


def _plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def static_plans(spark):
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", old)


def test_flagship_prunes_and_aggregates_before_join(spark, static_plans):
    plan = _plan(spark, "profit_by_segment")
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan
    lines = plan.splitlines()
    scan = next(i for i, ln in enumerate(lines) if "lineitem.parquet" in ln)
    join = max(i for i, ln in enumerate(lines[:scan]) if "Join" in ln)
    assert any("partial_sum" in ln for ln in lines[join:scan])  # partial aggregation below the join


@pytest.mark.parametrize("name", ["op_chain", "weighted_score", "poly_degree2", "symlog_roundtrip", "onehot_wide"])
def test_scalar_operators_are_one_stage(spark, static_plans, name):
    plan = _plan(spark, name)
    assert "Exchange" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["ordered_target_encoding", "ordered_leaf_weight"])
def test_ordered_operators_have_no_single_partition_exchange_over_rows(spark, static_plans, name):
    plan = _plan(spark, name)
    # partitioned windows only; the global (unpartitioned) window runs on the carry table
    assert "Exchange SinglePartition" not in plan
    assert re.search(r"Window \[.*\], \[__pid", plan)


def test_goss_chooses_rows_by_comparison(spark, static_plans):
    """Two order statistics are fetched first; the rows themselves are neither ranked nor joined."""
    plan = _plan(spark, "goss_sample")
    assert "Window" not in plan and "Join" not in plan and "Exchange rangepartitioning" not in plan


def test_lookup_maps_are_broadcast(spark, static_plans):
    for name in ["label_encode_unseen", "rare_group_v1", "tier_plain"]:
        assert "BroadcastHashJoin" in _plan(spark, name)

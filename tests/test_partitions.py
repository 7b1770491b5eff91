"""SURVEY 5(e): results do not depend on the number of shuffle partitions."""

import pytest

import __spark_entry__ as entry

from conftest import SF_SMALL

NAMES = ["ordered_target_encoding", "train_valid_split", "kfold_sizes", "roc_auc", "split_exact", "goss_sample",
         "label_encode_unseen", "tier_smoothed", "qcut_quartiles", "stratified_folds"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_1_and_8_partitions(spark, name):
    fn = entry.queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1")
        one = sorted(tuple(r) for r in fn(spark, SF_SMALL).collect())
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        eight = sorted(tuple(r) for r in fn(spark, SF_SMALL).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert one == eight

"""What the optimizer must make of the queries."""

import re

import pytest

import __spark_entry__ as entry

Q = entry.queries()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_two_columns_and_pushes_the_filter(spark, sf_dir):
    p = plan(Q["filtered_scan"](spark, sf_dir))
    assert "GreaterThan(l_extendedprice,50000.0)" in p
    assert re.search(r"ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_extendedprice:double>", p)


def test_timestamps_are_pushed(spark, sf_dir):
    assert "GreaterThanOrEqual(ts" in plan(Q["lookback_filter"](spark, sf_dir))


def test_partition_filters(spark, sf_dir):
    assert re.search(r"PartitionFilters: \[[^\]]*event_type[^\]]*click", plan(Q["partitioned_artifact"](spark, sf_dir)))


def test_small_dimensions_are_broadcast(spark, sf_dir):
    p = plan(Q["broadcast_enrich"](spark, sf_dir))
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_outer_join_that_is_inner(spark, sf_dir):
    assert "LeftOuter" not in plan(Q["left_join_not_null"](spark, sf_dir))


def test_top_k_is_limited_before_the_shuffle(spark, sf_dir):
    assert "WindowGroupLimit" in plan(Q["topk_per_group"](spark, sf_dir))


@pytest.mark.parametrize("name", [
    "inner_equi_join", "asof_join", "range_join_region", "left_join_null_safe_ratio", "bm25_topk", "tanimoto_topk", "knn_join",
    "age_years", "zscore_normalize", "outlier_summary", "drift_report", "roc_auc", "class_weights", "date_shift_validation",
    "vocabulary_lookup", "safe_ratio", "pair_list_join"])
def test_no_nested_loops(spark, sf_dir, name):
    p = plan(Q[name](spark, sf_dir))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p

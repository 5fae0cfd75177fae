"""Properties of physical plans that matter at scale."""

import pytest

from forumlens.plans import load_all
from forumlens.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"
load_all()

# Global orderings that are the feature (a top-k report) or a handful of rows per bucket, cluster or topic.
WITHOUT_PAIRING = sorted(set(QUERIES) - {"g8_greedy_communities", "g8_mutual_communities", "g10_community_crosstab",
                                         "m14_parameter_sweep", "flow_fit_topics", "x1_incremental_stream"})


def plan_of(spark, key):
    return QUERIES[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", WITHOUT_PAIRING)
def test_no_cartesian_or_nested_loop_join(spark, key):
    plan = plan_of(spark, key)
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_columns_and_filters_reach_the_scan(spark):
    plan = plan_of(spark, "a2_posts_per_year")
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz,o_orderpriority:string>" in plan
    plan = plan_of(spark, "g12_mann_whitney_large")
    assert "lineitem" not in plan  # ranks start from the stored value counts
    plan = plan_of(spark, "p3_cutoff")
    assert "ReadSchema: struct<doc_id:bigint>" in plan


def test_dedup_is_a_combined_aggregate(spark):
    plan = plan_of(spark, "u2_merge_posts")
    assert "partial_min_by" in plan and "Window" not in plan


def test_counts_need_one_shuffle(spark):
    plan = plan_of(spark, "m1_ngram_counts")
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan

"""Shape of the physical plans: pushed filters, pruned columns, no cross joins, no window over a whole table."""

import re

import pytest

from larder.plans import catalog

ROOT = "/root/testdata/sf0.001"


def plan(spark, name):
    return catalog.QUERIES[name](spark, ROOT)._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(spark, "term_lookup")
    assert "EqualTo(o_orderpriority,3-MEDIUM)" in text and "o_totalprice" not in text and "Exchange" not in text
    text = plan(spark, "score_min_max")
    assert "l_shipdate" not in text and "o_custkey" not in text


@pytest.mark.parametrize(
    "name",
    [
        "score_food", "named_aggs", "feature_rows", "update_by_key", "pair_compare", "split_label", "describe_scores",
        "rank_categories", "assign_category", "ks_drift", "drift_report", "quality", "top_errors", "last_n_window", "errors_over_order",
    ],
)
def test_no_cross_join_and_no_global_window(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    # a window without partition columns would put all rows into one task; the drift flag has one row per column
    if name != "ks_drift":
        assert not re.search(r"Window \[[^\n]*windowspecdefinition\((?:[a-z_]+#\d+ (?:ASC|DESC))", text)


def test_aggregates_combine_before_the_shuffle(spark):
    text = plan(spark, "token_counts")
    assert text.count("partial_count") >= 1 and "partial_max" in plan(spark, "score_food")

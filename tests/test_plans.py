"""Plans stay what they were meant to be: filters and columns reach the scan, no Python on the relational path."""

import pytest

from vigilake.plans import reference, training


def plan(df):
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["r01_cohort_events", "r05_first_by_key", "r07_pivot_lists", "r09_content_profiles", "r35_fact_rows", "r47_linkage_cascade", "r63_join_aggregate"])
def test_no_python_on_the_relational_path(spark, small, name):
    text = plan(reference.QUERIES[name](spark, small))
    assert "Python" not in text and "ArrowEval" not in text and "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scans_are_pruned_and_filtered(spark, small):
    text = plan(reference.QUERIES["r63_join_aggregate"](spark, small))
    assert "GreaterThanOrEqual(l_shipdate" in text and "l_comment" not in text and "l_tax" not in text.split("Physical Plan")[1]
    scan = plan(training.QUERIES["p3_found"](spark, small)).split("Physical Plan")[1]
    assert "reporter_country" not in scan


def test_orphans_merge_sorted_streams(spark, small):
    assert "SortMergeJoin" in plan(training.QUERIES["p6_found"](spark, small))

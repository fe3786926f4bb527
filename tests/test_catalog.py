"""Every catalog query against its SQL, and the shape of the plans."""

import os

import pytest
from compare import compare, connect

from billstream.plans.registry import load_catalog

SMALL, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables not here")

PYTHON_ALLOWED = {
    "composite_score",
    "semantic_tags",
    "semantic_tags_fallback",
    "example_max_similarity",
}
#: Queries that run their streams and stores while they are built.
STREAMS = {
    "log_stream", "stream_dedup_guid", "daily_activity", "stream_tagging", "orphan_state_store", "event_pending_store",
    "incremental_bills_table", "tag_store_bills", "tag_store_files", "tag_store_lines", "tag_job_semantic",
}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


@pytest.mark.parametrize("name", list(load_catalog()))
def test_matches_sql(spark, con, name):
    ok, note = compare(spark, con, SMALL, name)
    if "EMPTY" in note:  # too few rows there to show anything
        ok, note = compare(spark, connect(LARGER), LARGER, name)
    assert ok, note


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in load_catalog() if n not in STREAMS])
def test_no_python_and_no_cross_join(spark, name):
    plan = plan_of(load_catalog()[name](spark, SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    if name not in PYTHON_ALLOWED:
        assert "Python" not in plan and "ArrowEval" not in plan


def test_every_query_has_a_check():
    assert [n for n, q in load_catalog().items() if q.sql is None] == []


def test_rankings_limit_groups_before_the_shuffle(spark):
    for name in ("per_repo_limit", "dedup_guid", "best_link", "last_write_wins", "sample_per_type", "link_event_bill"):
        assert "WindowGroupLimit" in plan_of(load_catalog()[name](spark, SMALL)), name


def test_top_k_needs_no_full_sort(spark):
    for name in ("top_k_logs", "feed_top_n"):
        assert "TakeOrdered" in plan_of(load_catalog()[name](spark, SMALL)), name


def test_a_feed_cuts_bills_down_and_stays_in_order(spark):
    df = load_catalog()["feed_latest_activity"](spark, SMALL)
    assert "LeftSemi" in plan_of(df)
    stamps = [r.timestamp or "" for r in df.collect()]
    assert stamps == sorted(stamps, reverse=True) and len(stamps) > 1


def test_scans_are_narrow_and_filters_reach_them(spark):
    plan = plan_of(load_catalog()["failure_report"](spark, SMALL))
    assert "EqualTo(event_type,error)" in plan
    plan = plan_of(load_catalog()["count_by_bill"](spark, SMALL))
    assert "l_shipdate" not in plan and "Window" not in plan


def test_routine_filter_is_one_broadcast_anti_join(spark):
    plan = plan_of(load_catalog()["routine_filter"](spark, SMALL))
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    assert plan.count("Exchange hashpartitioning") == 0

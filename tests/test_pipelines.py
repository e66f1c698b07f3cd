"""Pipelines (C24-C26) on the driver's smallest data: empty selections and output columns."""

import os

import pytest

from cohortline.plans import invitations as inv
from cohortline.sources import load_sources

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def src(spark):
    if not os.path.exists(SF):
        pytest.skip("test data not present")
    return load_sources(spark, SF)


def test_nobody_selected(src):
    single = inv.invitation_list(src, "2024-01-21", 300, "bo_turnover_usd", 5, 1e12, False)
    assert single.count() == 0
    assert single.columns == ["actor_id", "first_name", "last_name", "email"]
    multi = inv.multi_metric_invitations(src, "2024-01-10", "2024-01-25", 5, 20, 1e12, 1e12, 1e12,
                                         1e12, "lag", "2024-01-01")
    assert multi.count() == 0
    assert multi.columns == ["actor_id", "metric", "first_name", "last_name", "email", "country",
                             "login_list"]


def test_unknown_metric_fails_early(src):
    with pytest.raises(ValueError):
        inv.invitation_list(src, "2024-01-21", 300, "no_such_metric", 5, 1, False)


def test_documented_call_without_a_summary_start(src):
    args = ("2024-01-10", "2024-01-25", 5, 20, 50.0, 20.0, 10.0, 20.0)
    for mode in ("lag", "delta"):
        default = inv.multi_metric_invitations(src, *args, mode=mode)
        since = inv.multi_metric_invitations(src, *args, mode=mode, summary_start="2000-01-01")
        assert sorted(map(tuple, default.collect()), key=str) == sorted(map(tuple, since.collect()), key=str)


def test_stored_summary_gives_the_same_lists(spark, src):
    from cohortline.plans.summary import daily_summary, snapshot_summary, spec_v1
    from cohortline.session import checkpoint
    stored = checkpoint(daily_summary(src, spec_v1("2024-01-01")))
    args = ("2024-01-10", "2024-01-25", 5, 20, 50.0, 20.0, 10.0, 20.0)
    a = inv.multi_metric_invitations(src, *args, summary_start="2024-01-01").collect()
    b = inv.multi_metric_invitations(src, *args, stored=stored).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)
    day = checkpoint(snapshot_summary(src, "2024-01-21"))
    a = inv.invitation_list(src, "2024-01-21", 3, "bo_turnover_usd", 30, 20.0, False).collect()
    b = inv.invitation_list(src, "2024-01-21", 3, "bo_turnover_usd", 30, 20.0, False, stored=day).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_range_list_is_sorted(src):
    got = inv.invitation_list_range(src, "2024-01-02", "2024-01-28", 300, 30, "bo_turnover_usd", 5, 10.0, False,
                                    as_of="2024-01-31").collect()
    keys = [(r.metric_value, r.actor_id) for r in got]
    assert keys == sorted(keys) and len(keys) > 1


def test_building_a_query_runs_no_job(spark):
    import __spark_entry__ as se
    tracker = spark.sparkContext.statusTracker()
    for name in ("crossed_range", "exclude_rowwise", "exclude_strict", "exclude_unsubscribed", "group_share", "quota_shared",
                 "quota_capped", "rank_and_cut", "rank_per_label", "client_names_max", "client_names_latest"):
        spark.sparkContext.setJobGroup(f"build {name}", "")
        se.queries()[name](spark, SF)
        assert list(tracker.getJobIdsForGroup(f"build {name}")) == [], name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_facts_from_the_end_of_the_range_on_are_not_read(src):
    from cohortline.plans.summary import daily_summary, spec_v4
    plan = daily_summary(src, spec_v4("2024-01-31", 30, "2024-01-25"))._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-25" in plan or "19747" in plan      # the bound as a date, or as its day number

"""Rules (C8-C12), profile and exclusions."""

import pytest
from helpers import day, make_sources, money, trade, ts
from pyspark.sql import functions as F

from cohortline.operators import audience, rules
from cohortline.params import Scope, SummarySpec
from cohortline.plans.summary import daily_summary


def _summary(spark, trades):
    src = make_sources(spark, trades=trades)
    return daily_summary(src, SummarySpec(scope=Scope(day(1), day(31))))


def _active(df):
    return sorted((r["actor_id"], r["date"]) for r in rules.select_active(df).collect())


def test_crossed_subset_of_reached_and_once_for_growing_metric(spark):
    s = _summary(spark, [trade(1, d, 40) for d in range(1, 8)] + [trade(2, 1, 500)])
    crossed = _active(rules.metric_rule(s, "bo_turnover_usd", 100, True))
    reached = _active(rules.metric_rule(s, "bo_turnover_usd", 100, False))
    assert set(crossed) <= set(reached)
    assert crossed == [(1, day(3)), (2, day(1))]


def test_delta_lag_and_first_ever_differ_on_falling_metric(spark):
    # pnl goes 60 -> 40 -> 70: crosses 50 twice by delta, once ever
    s = _summary(spark, [trade(1, 1, 60, -60), trade(1, 2, 20, 20), trade(1, 3, 30, -30)])
    delta = _active(rules.metric_rule(s, "bo_pnl_usd", 50, True, "delta"))
    lag = _active(rules.metric_rule(s, "bo_pnl_usd", 50, True, "lag"))
    ever = _active(rules.metric_rule(s, "bo_pnl_usd", 50, True, "first_ever"))
    assert delta == [(1, day(1)), (1, day(3))]
    assert lag == [(1, day(3))]          # the first row has no previous total (C9)
    assert ever == [(1, day(1))]


def test_unknown_metric_is_rejected(spark):
    s = _summary(spark, [trade(1, 1, 1)])
    with pytest.raises(ValueError):
        rules.metric_rule(s, "bo_turnover_usd; DROP TABLE x", 1)
    with pytest.raises(ValueError):
        rules.metric_rule(s, "pnl_usd", 1)   # not produced without cross-source metrics


def test_label_rules_first_match_wins(spark):
    df = spark.createDataFrame([(1, 5), (2, 50), (3, 500)], "actor_id long, v long")
    out = rules.label_rules(df, [("big", F.col("v") > 100), ("mid", F.col("v") > 10)])
    assert sorted((r.actor_id, r.metric) for r in out.collect()) == [(1, "none"), (2, "mid"), (3, "big")]


def _aud(spark):
    src = make_sources(
        spark,
        profile=[(1, "A", "u1@x.com", "l1"), (2, "A", "u2@corp.com", "l2"), (3, "B", "nomail", "l3"),
                 (4, None, "u4@x.com", "l4")],
        internal_domains=[("corp.com", "internal")],
        statuses=[(1, "internal_client"), (1, "ok"), (3, "ok")],
        preferences=[("3", "true"), ("4", "false")])
    active = spark.createDataFrame([(a, day(2), 1.0, "m") for a in (1, 2, 3, 4, 5)],
                                   "actor_id long, date date, metric_value double, metric string")
    return src, audience.attach_profile(active, src.profile)


def test_profile_join_drops_unknown_actors(spark):
    _, prof = _aud(spark)
    assert sorted(r.actor_id for r in prof.collect()) == [1, 2, 3, 4]


def test_rowwise_versus_strict_exclusion(spark):
    # H3: user 1 has an internal and a normal status: row-wise keeps the normal row
    src, prof = _aud(spark)
    row = audience.exclude_internal(prof, src.internal_domains, src.statuses, "rowwise")
    strict = audience.exclude_internal(prof, src.internal_domains, src.statuses, "strict")
    assert sorted(r.actor_id for r in row.collect()) == [1, 3, 4]
    assert sorted(r.actor_id for r in strict.collect()) == [3, 4]


def test_unsubscribed_missing_preference_is_subscribed(spark):
    src, prof = _aud(spark)
    out = audience.exclude_unsubscribed(prof, src.preferences)
    assert sorted(r.actor_id for r in out.collect()) == [1, 2, 4]


def test_auto_rule(spark):
    src = make_sources(spark, trades=[trade(1, 1, 10, -10, contracts=3), trade(1, 2, 10, -10, contracts=3)],
                       payments=[(1, ts(2), "Client Withdrawal", money(-5))])
    s = daily_summary(src, SummarySpec(scope=Scope(day(1), day(31)), cross_source=True))
    out = rules.select_active(rules.auto_rule(s, 6, 15))
    rows = out.collect()
    assert [(r.actor_id, r.date, r.metric, r.metric_value) for r in rows] == [(1, day(2), "Auto", 1)]

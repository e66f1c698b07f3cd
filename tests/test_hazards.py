"""Hazards kept from the reference, each pinned by a small example."""

from helpers import day, make_sources, trade, ts
from pyspark.sql import functions as F

from cohortline.operators import quota, ranking, rules
from cohortline.params import Scope, SummarySpec
from cohortline.plans.summary import daily_summary


def _spec(**kw):
    return SummarySpec(scope=Scope(day(1), day(31)), **kw)


def test_h21_null_lag_hides_a_crossing(spark):
    # day 2 has payments only, so the merged row's turnover total is NULL and LAG on day 3 is NULL
    src = make_sources(spark, trades=[trade(1, 1, 100), trade(1, 3, 300)],
                       payments=[(1, ts(2), "Client Deposit", 5.0)])
    s = daily_summary(src, _spec())
    lag = rules.select_active(rules.metric_rule(s, "bo_turnover_usd", 300, True, "lag")).collect()
    delta = rules.select_active(rules.metric_rule(s, "bo_turnover_usd", 300, True, "delta")).collect()
    assert lag == []
    assert [(r.actor_id, r.date) for r in delta] == [(1, day(3))]


def test_h13_zero_fill_covers_the_win_count_too(spark):
    src = make_sources(spark, trades=[trade(1, 1, 10, -10)],
                       payments=[(1, ts(2), "Client Deposit", 5.0)])
    s = daily_summary(src, _spec(fill=0)).filter(F.col("date") == F.lit(day(2)))
    row = s.first()
    assert (row.bo_win_count, row.cumulative_bo_win_count, row.cumulative_bo_turnover_usd) == (0, 0, 0.0)


def test_h12_repeated_rows_of_one_user_take_ranks(spark):
    # user 1 meets the level rule on two days, user 2 once: the quota counts 2 users,
    # but the two rows of user 1 take both ranks
    df = spark.createDataFrame([(1, day(1), 9.0, "c"), (1, day(2), 8.0, "c"), (2, day(1), 7.0, "c")],
                               "actor_id long, date date, metric_value double, country string")
    q = quota.quota_table(df, ["country"], 50, 10, "shared")
    assert q.first().final_number_user == 2
    kept = ranking.rank_and_cut(df, q, ["country"])
    assert sorted({r.actor_id for r in kept.collect()}) == [1]

"""

Every query reads the driver's tables (role mapping in
``cohortline.sources.fixtures``) over their whole extent; the oracle SQL in
``oracle_queries`` computes the same result in the plain SQL shape.
"""

from __future__ import annotations

import datetime as dt
import importlib
import os
import sys
import uuid
import warnings
from dataclasses import replace
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle_queries as oq  # noqa: E402
from cohortline.functions.columns import exact  # noqa: E402
from cohortline.operators import audience, naming, quota, ranking, rules, series, sketches  # noqa: E402
from cohortline.operators.rollup import (Measure, daily_rollup, fact_part,  # noqa: E402
                                         fx_deals_part, trades_part)
from cohortline.operators.thresholds import estimate_thresholds, quantile_array  # noqa: E402
from cohortline.params import Scope, add_months  # noqa: E402
from cohortline.plans import invitations as inv  # noqa: E402
from cohortline.plans import sql_objects  # noqa: E402
from cohortline.plans.stored import SummaryStore, save_series, stored_series  # noqa: E402
from cohortline.plans.summary import (daily_summary, snapshot_summary, spec_v1,  # noqa: E402
                                      spec_v2, spec_v3, spec_v4, spec_v5)
from cohortline.session import checkpoint, ensure_checkpoint_dir  # noqa: E402
from cohortline.sources import (catalogue_sources, load_sources, new_database, read_table,  # noqa: E402
                                register_view, save_sources, save_table)

# Parameters of the checks (the test data covers 2024-01-01 .. 2024-01-30).
REPORT = dt.date(2024, 1, 21)            # single-day report: previous day 2024-01-20
SNAP = REPORT - dt.timedelta(days=1)
LOOKBACK = 3                              # months
START, END = dt.date(2024, 1, 10), dt.date(2024, 1, 25)
AS_OF, INTERVAL_DAYS = dt.date(2024, 1, 31), 30
HISTORY = dt.date(2024, 1, 1)             # fixed start of the v1 / v2 summaries
T_RANGE = 200.0                           # turnover threshold in the range
T_DAY = 400.0                             # turnover level for the single day
LIMIT_A, PCT_A = 25, 15                   # quota: under-limit, shared remainder, below
LIMIT_B, PCT_B = 7, 50                    # quota: below over the limit, remainder floored at 0
AUTO_REPORT, AUTO_LOW = dt.date(2024, 1, 4), (4, -1000)   # an early report, when many cross four contracts
MULTI = dict(invitation_limit=5, threshold=20, bo_turnover_limit=300.0, withdrawal_limit=100.0,
             profit_limit=50.0, mt5_pnl_limit=100.0)

ORDERS_REPORT = dt.date(1998, 5, 31)      # month clamp: 3 months before is 1998-02-28
V5_START = add_months(REPORT, -LOOKBACK)
V4_START = AS_OF - dt.timedelta(days=INTERVAL_DAYS)


_SOURCES: dict = {}


def _src(spark: SparkSession, sf_dir: str):
    """Lazily defined source relations, reused for the same session and folder."""
    ensure_checkpoint_dir(spark)
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _SOURCES:
        _SOURCES[key] = load_sources(spark, sf_dir)
    return _SOURCES[key]


# --------------------------------------------------------------------------- shared pieces

def _v5_running(src):
    return daily_summary(src, spec_v5(REPORT, LOOKBACK))


def _range_active(src):
    """Rows of [START, END) whose cumulative turnover crossed T_RANGE, with profile."""
    ruled = rules.metric_rule(_v5_running(src), "bo_turnover_usd", T_RANGE, True)
    active = rules.select_active(ruled).filter(
        (F.col("date") >= F.lit(START)) & (F.col("date") < F.lit(END)))
    return audience.attach_profile(active.select("actor_id", "date", "metric_value", "metric"), src.profile)


def _stored_active(src):
    """The range's active rows as a stored table, as the pipelines keep them."""
    return checkpoint(_range_active(src))


_DATABASES: dict = {}


def _database(spark: SparkSession, sf_dir: str) -> str:
    """The relations as catalogue tables, written once for the same session and folder."""
    key = (spark.sparkContext.applicationId, id(spark), sf_dir)
    if key not in _DATABASES:
        name = new_database(spark)
        save_sources(_src(spark, sf_dir), name, _buckets(spark))
        _DATABASES[key] = name
    return _DATABASES[key]


def _buckets(spark) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _fresh(spark, name: str) -> str:
    """A new table folder for each run; readers of an earlier one keep theirs."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


# --------------------------------------------------------------------------- queries

def q_daily_rollup(spark, d):
    return daily_rollup(trades_part(_src(spark, d), spec_v5(REPORT, LOOKBACK)))


def q_running_totals(spark, d):
    src = _src(spark, d)
    return series.build_series([trades_part(src, spec_v5(REPORT, LOOKBACK))])


def q_convert_prev_day(spark, d):
    return daily_rollup(fx_deals_part(_src(spark, d), spec_v5(REPORT, LOOKBACK)))


def q_merge_daily_null(spark, d):
    return _v5_running(_src(spark, d))


def q_merge_daily_zero(spark, d):
    return daily_summary(_src(spark, d), spec_v3(REPORT, LOOKBACK))


def q_combined_metrics(spark, d):
    return _v5_running(_src(spark, d)).select(
        "actor_id", "date", "pnl_usd", "cumulative_pnl_usd", "contract_count",
        "cumulative_contract_count")


def q_running_ratio(spark, d):
    return daily_summary(_src(spark, d), spec_v2(HISTORY)).select(
        "actor_id", "date", "bo_profit_percentage", "cumulative_bo_profit_percentage",
        "withdrawal_deposit_percentage", "cumulative_withdrawal_deposit_percentage")


def q_snapshot_day(spark, d):
    return snapshot_summary(_src(spark, d), REPORT, LOOKBACK)


def q_daily_summary_v1(spark, d):
    return daily_summary(_src(spark, d), spec_v1(HISTORY))


def q_daily_summary_v2(spark, d):
    return daily_summary(_src(spark, d), spec_v2(HISTORY))


def q_daily_summary_v4(spark, d):
    return daily_summary(_src(spark, d), spec_v4(AS_OF, INTERVAL_DAYS))


def q_crossed_range(spark, d):
    return _range_active(_src(spark, d)).select("actor_id", "date", "metric_value")


def q_reached(spark, d):
    src = _src(spark, d)
    snap = snapshot_summary(src, REPORT, LOOKBACK)
    ruled = rules.metric_rule(snap, "bo_turnover_usd", T_DAY, first_time=False)
    return rules.select_active(ruled).select("actor_id", "date", "metric_value")


def q_crossed_lag(spark, d):
    summary = daily_summary(_src(spark, d), spec_v1(HISTORY))
    ruled = rules.metric_rule(summary, "bo_turnover_usd", 300.0, True, mode="lag")
    active = rules.select_active(ruled)
    return active.filter((F.col("date") >= F.lit(START)) & (F.col("date") < F.lit(END))).select(
        "actor_id", "date", "metric_value")


def q_first_ever(spark, d):
    ruled = rules.metric_rule(_v5_running(_src(spark, d)), "bo_pnl_usd", 50.0, True,
                              mode="first_ever")
    return rules.select_active(ruled).select("actor_id", "date", "metric_value")


def q_crossed_pnl(spark, d):
    ruled = rules.metric_rule(_v5_running(_src(spark, d)), "bo_pnl_usd", 50.0, True)
    return rules.select_active(ruled).select("actor_id", "date", "metric_value")


def q_auto_rule(spark, d):
    ruled = rules.auto_rule(_v5_running(_src(spark, d)), 4, 1, strict_pnl=True)
    return rules.select_active(ruled).select("actor_id", "date", "metric_value", "metric")


def q_label_rules(spark, d):
    src = _src(spark, d)
    lab = inv.labelled_users(src, START, END, MULTI["bo_turnover_limit"], MULTI["withdrawal_limit"],
                             MULTI["profit_limit"], MULTI["mt5_pnl_limit"], "lag", HISTORY)
    return lab.select("actor_id", "date", "metric")


def q_exclude_rowwise(spark, d):
    src = _src(spark, d)
    out = audience.exclude_internal(_range_active(src), src.internal_domains, src.statuses, "rowwise")
    return out.select("actor_id", "date", "metric_value", "country", "email")


def q_exclude_strict(spark, d):
    src = _src(spark, d)
    out = audience.exclude_internal(_range_active(src), src.internal_domains, src.statuses, "strict")
    return out.select("actor_id", "date", "metric_value", "country", "email")


def q_exclude_unsubscribed(spark, d):
    src = _src(spark, d)
    out = audience.exclude_unsubscribed(_range_active(src), src.preferences)
    return out.select("actor_id", "date", "metric_value", "country", "email")


def q_group_share(spark, d):
    return quota.group_share(_range_active(_src(spark, d)), ["country"], PCT_A)


def _quota(spark, d, limit, pct, rule):
    return quota.quota_table(_range_active(_src(spark, d)), ["country"], pct, limit, rule)


def q_quota_shared(spark, d):
    return _quota(spark, d, LIMIT_A, PCT_A, "shared")


def q_quota_shared_floor(spark, d):
    return _quota(spark, d, LIMIT_B, PCT_B, "shared")


def q_quota_capped(spark, d):
    return _quota(spark, d, LIMIT_A, PCT_A, "capped")


def _rank(active, **how):
    quotas = quota.quota_table(active, ["country"], PCT_A, LIMIT_A, "shared", with_rows=True)
    chosen = ranking.rank_and_cut(active, quotas, ["country"], **how)
    return chosen.select("actor_id", "date", "metric_value", "country")


def q_rank_and_cut(spark, d):
    return _rank(_range_active(_src(spark, d)))


def q_rank_global_sort(spark, d):
    return _rank(_range_active(_src(spark, d)), splits=7)   # the same ranks whatever the number of parts


def q_rank_by_selection(spark, d):
    return _rank(_stored_active(_src(spark, d)), select_by="metric_value")


def q_rank_per_label(spark, d):
    src = _src(spark, d)
    lab = inv.labelled_users(src, START, END, MULTI["bo_turnover_limit"], MULTI["withdrawal_limit"],
                             MULTI["profit_limit"], MULTI["mt5_pnl_limit"], "lag", HISTORY)
    active = audience.attach_profile(
        lab.select("actor_id", "date", "metric", *sorted(set(inv.LAG_LABELS.values()))), src.profile)
    quotas = quota.quota_table(active, ["country", "metric"], MULTI["threshold"],
                               MULTI["invitation_limit"], "capped", with_rows=True)
    chosen = ranking.rank_per_label(active, quotas, inv.LAG_LABELS)
    return chosen.select("actor_id", "date", "metric", "country")


def _all_actors(src):
    return _v5_running(src).select("actor_id").distinct()


def q_client_names_max(spark, d):
    src = _src(spark, d)
    return naming.client_names(_all_actors(src), src.clients, "max")


def q_client_names_latest(spark, d):
    src = _src(spark, d)
    return naming.client_names(_all_actors(src), src.clients, "latest")


def q_estimate_thresholds(spark, d):
    return estimate_thresholds(_v5_running(_src(spark, d)))


def q_invitation_list(spark, d):
    return inv.invitation_list(_src(spark, d), REPORT, 3, "bo_turnover_usd", 30, T_DAY,
                               first_time_meet=False)


def q_invitation_list_auto(spark, d):
    return inv.invitation_list(_src(spark, d), REPORT, 300, "auto", 5, 0, True,
                               auto_thresholds=(4, 1), strict_auto_pnl=True)


def q_invitation_list_range(spark, d):
    return inv.invitation_list_range(_src(spark, d), START, END, LIMIT_A, INTERVAL_DAYS,
                                     "bo_turnover_usd", PCT_A, T_RANGE, True, as_of=AS_OF)


def q_invitation_list_sample(spark, d):
    # zero-filled running summary filtered to the day; internal users excluded, no unsubscribe
    return inv.invitation_list(_src(spark, d), REPORT, 3, "bo_turnover_usd", 30, T_DAY,
                               first_time_meet=False, unsubscribe=False, summary="v3")


def q_invitation_list_first_ever(spark, d):
    # P/L reaching 50 for the first time within the lookback on the report's previous day (H2)
    return inv.invitation_list(_src(spark, d), REPORT, 3, "bo_pnl_usd", 30, 50.0,
                               first_time_meet=True, rule_mode="first_ever")


def q_invitation_list_range_reached(spark, d):
    # level rule over a range: one user yields several rows, each taking a rank
    return inv.invitation_list_range(_src(spark, d), START, END, LIMIT_A, INTERVAL_DAYS,
                                     "bo_turnover_usd", PCT_A, T_RANGE, False, as_of=AS_OF)


def q_invitation_list_strict_latest(spark, d):
    return inv.invitation_list(_src(spark, d), REPORT, 3, "bo_turnover_usd", 30, T_DAY,
                               first_time_meet=False, exclusion="strict", names="latest")


def q_multi_metric_lag(spark, d):
    return inv.multi_metric_invitations(_src(spark, d), START, END, mode="lag",
                                        summary_start=HISTORY, **MULTI)


def q_multi_metric_delta(spark, d):
    return inv.multi_metric_invitations(_src(spark, d), START, END, mode="delta",
                                        summary_start=HISTORY, **MULTI)


def q_month_lookback(spark, d):
    orders = read_table(spark, d, "orders", ["o_custkey", "o_orderdate", "o_totalprice"])
    part = fact_part("orders", orders, "o_custkey", "o_orderdate",
                     Scope.months_before(ORDERS_REPORT, LOOKBACK),
                     [Measure("order_count", F.lit(1).cast("bigint"), "count"),
                      Measure("order_value", exact(F.col("o_totalprice")))])
    return series.build_series([part])


def q_multi_metric_from_view(spark, d):
    """The table function's shape: the summary is a view, the labels and ranks read that."""
    src = _src(spark, d)
    view = register_view(daily_summary(src, spec_v1(HISTORY)), "labelled_summary_source")
    return inv.multi_metric_invitations(src, START, END, mode="lag", stored=view, **MULTI)


def q_partition_pruned_scan(spark, d):
    """The first fact stored by month; the rollup's scan reads the months in scope only."""
    src = _src(spark, d)
    stored = save_table(src.trades.withColumn("month", F.trunc("ts", "MM")), _fresh(spark, "trades"),
                        partition_by=("month",))
    spec = replace(spec_v5(REPORT, LOOKBACK), month_partitions=(("trades", "month"),))
    return daily_rollup(trades_part(replace(src, trades=stored), spec))


def q_group_share_exact(spark, d):
    return quota.group_share(_range_active(_src(spark, d)), ["country"], PCT_A, exact_share=True)


def q_summary_view(spark, d):
    view = register_view(daily_summary(_src(spark, d), spec_v1(HISTORY)), "daily_summary_v1",
                         order_by=("actor_id", "date"))
    return view.filter(F.col("date") >= F.lit(START)).select(
        "actor_id", "date", "cumulative_bo_turnover_usd", "cumulative_withdrawal_usd",
        "cumulative_mt5_pnl_usd")


def q_stored_thresholds(spark, d):
    """Summary stored partitioned by day, read back whole, then quantiles."""
    return estimate_thresholds(save_table(_v5_running(_src(spark, d)), _fresh(spark, "summary")))


def q_snapshot_thresholds(spark, d):
    """Quantiles over the stored single-day table (the reference's population)."""
    return estimate_thresholds(save_table(snapshot_summary(_src(spark, d), REPORT, LOOKBACK),
                                          _fresh(spark, "snapshot")))


def q_quantile_array(spark, d):
    return quantile_array(_v5_running(_src(spark, d)), "cumulative_bo_turnover_usd", 100, (80, 90))


def q_metric_profit_usd(spark, d):
    snap = snapshot_summary(_src(spark, d), REPORT, LOOKBACK)
    ruled = rules.metric_rule(snap, "bo_profit_usd", 50, first_time=False)
    return rules.select_active(ruled).select("actor_id", "date", "metric_value", "metric")


def q_metric_deposit_count(spark, d):
    snap = snapshot_summary(_src(spark, d), REPORT, LOOKBACK)
    ruled = rules.metric_rule(snap, "deposit_count", 3, first_time=False)
    return rules.select_active(ruled).select("actor_id", "date", "metric_value", "metric")


def q_client_names_last_value(spark, d):
    src = _src(spark, d)
    return naming.client_names(_all_actors(src), src.clients, "last_value")


def q_stored_series(spark, d):
    """Running totals, LAG and the profile over tables bucketed by actor: no exchange after they are stored."""
    src, spec = _src(spark, d), spec_v1(HISTORY)
    database = new_database(spark, "series")
    save_series(src, spec, database, _buckets(spark))
    tracked = ["cumulative_bo_turnover_usd", "cumulative_withdrawal_usd"]
    lagged = rules.with_previous(stored_series(spark, src, spec, database), tracked)
    return audience.attach_profile(lagged, spark.table(f"{database}.profile")).select(
        "actor_id", "date", *tracked, *[f"prev_{c}" for c in tracked], "country", "email")


def q_incremental_summary(spark, d):
    """The stored summary carried on: history, a stretch of days, then one more day."""
    src = _src(spark, d)
    store = SummaryStore(spark, _fresh(spark, "store"), spec_v1(HISTORY))
    for first, end in ((HISTORY, SNAP), (SNAP, AS_OF - dt.timedelta(days=1)), (AS_OF - dt.timedelta(days=1), AS_OF)):
        store.refresh(src, first, end)
    return store.read()


def q_late_facts_summary(spark, d):
    """Payments of the last days arrive late: a refresh from their first day sets the summary right."""
    src = _src(spark, d)
    late = replace(src, payments=src.payments.filter(F.col("ts") < F.lit(START)))
    store = SummaryStore(spark, _fresh(spark, "store"), spec_v1(HISTORY))
    store.refresh(late, HISTORY, START)
    store.refresh(late, START, END)
    store.refresh(src, START, AS_OF)
    return store.read()


def q_sketched_thresholds(spark, d):
    """Thresholds of a range of days from the stored daily sketches alone."""
    stored = checkpoint(sketches.daily_sketches(_v5_running(_src(spark, d))))
    return sketches.sketched_thresholds(stored, START, END)


def q_group_share_bitmaps(spark, d):
    """Shares of the range from stored daily bitmaps of actors."""
    active = _stored_active(_src(spark, d))
    stored = checkpoint(sketches.daily_bitmaps(active, sketches.number_actors(active)))
    return quota.share_of(sketches.distinct_actors(stored, start=START, end=END), ["country"], PCT_A)


def q_invitation_list_catalogue(spark, d):
    """The range list from catalogue tables instead of the role mapping."""
    return inv.invitation_list_range(catalogue_sources(spark, _database(spark, d), amount_decimals=2), START, END, LIMIT_A, INTERVAL_DAYS,
                                     "bo_turnover_usd", PCT_A, T_RANGE, True, as_of=AS_OF)


def q_persistent_view(spark, d):
    """The summary as a view of the catalogue, read by another session."""
    database = _database(spark, d)
    sql_objects.create_summary_view(spark, f"{database}.daily_summary", database, HISTORY, order_by=("actor_id", "date"))
    return spark.newSession().table(f"{database}.daily_summary")


def _by_function(spark, d, mode):
    database = _database(spark, d)
    view, function = f"{database}.summary_{mode}", f"{database}.invitations_{mode}"
    sql_objects.create_summary_view(spark, view, database, HISTORY, profit_loss=mode == "delta")
    sql_objects.create_invitation_function(spark, function, view, database, mode)
    return sql_objects.call_function(
        spark, function, START, END, MULTI["invitation_limit"], MULTI["threshold"], MULTI["bo_turnover_limit"],
        MULTI["withdrawal_limit"], MULTI["profit_limit"], MULTI["mt5_pnl_limit"])


def q_table_function_lag(spark, d):
    return _by_function(spark, d, "lag")


def q_table_function_delta(spark, d):
    return _by_function(spark, d, "delta")


def q_invitation_list_auto_low(spark, d):
    # the auto rule on a day and with thresholds that select users of the test data
    return inv.invitation_list(_src(spark, d), AUTO_REPORT, 300, "auto", 5, 0, True,
                               auto_thresholds=AUTO_LOW, strict_auto_pnl=True)


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "daily_rollup": q_daily_rollup,
    "running_totals": q_running_totals,
    "convert_prev_day": q_convert_prev_day,
    "merge_daily_null": q_merge_daily_null,
    "merge_daily_zero": q_merge_daily_zero,
    "combined_metrics": q_combined_metrics,
    "running_ratio": q_running_ratio,
    "snapshot_day": q_snapshot_day,
    "daily_summary_v1": q_daily_summary_v1,
    "daily_summary_v2": q_daily_summary_v2,
    "daily_summary_v4": q_daily_summary_v4,
    "crossed_range": q_crossed_range,
    "reached": q_reached,
    "crossed_lag": q_crossed_lag,
    "first_ever": q_first_ever,
    "crossed_pnl": q_crossed_pnl,
    "auto_rule": q_auto_rule,
    "label_rules": q_label_rules,
    "exclude_rowwise": q_exclude_rowwise,
    "exclude_strict": q_exclude_strict,
    "exclude_unsubscribed": q_exclude_unsubscribed,
    "group_share": q_group_share,
    "quota_shared": q_quota_shared,
    "quota_shared_floor": q_quota_shared_floor,
    "quota_capped": q_quota_capped,
    "rank_and_cut": q_rank_and_cut,
    "rank_global_sort": q_rank_global_sort,
    "rank_per_label": q_rank_per_label,
    "client_names_max": q_client_names_max,
    "client_names_latest": q_client_names_latest,
    "estimate_thresholds": q_estimate_thresholds,
    "invitation_list": q_invitation_list,
    "invitation_list_auto": q_invitation_list_auto,
    "invitation_list_range": q_invitation_list_range,
    "invitation_list_range_reached": q_invitation_list_range_reached,
    "invitation_list_strict_latest": q_invitation_list_strict_latest,
    "invitation_list_sample": q_invitation_list_sample,
    "invitation_list_first_ever": q_invitation_list_first_ever,
    "multi_metric_lag": q_multi_metric_lag,
    "multi_metric_delta": q_multi_metric_delta,
    "month_lookback": q_month_lookback,
    "summary_view": q_summary_view,
    "stored_thresholds": q_stored_thresholds,
    "snapshot_thresholds": q_snapshot_thresholds,
    "multi_metric_from_view": q_multi_metric_from_view,
    "partition_pruned_scan": q_partition_pruned_scan,
    "group_share_exact": q_group_share_exact,
    "quantile_array": q_quantile_array,
    "metric_deposit_count": q_metric_deposit_count,
    "metric_profit_usd": q_metric_profit_usd,
    "rank_by_selection": q_rank_by_selection,
    "client_names_last_value": q_client_names_last_value,
    "stored_series": q_stored_series,
    "incremental_summary": q_incremental_summary,
    "late_facts_summary": q_late_facts_summary,
    "sketched_thresholds": q_sketched_thresholds,
    "group_share_bitmaps": q_group_share_bitmaps,
    "invitation_list_catalogue": q_invitation_list_catalogue,
    "persistent_view": q_persistent_view,
    "table_function_lag": q_table_function_lag,
    "table_function_delta": q_table_function_delta,
    "invitation_list_auto_low": q_invitation_list_auto_low,
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the date-range invitation list (C25) on sf0.001."""
    return inv.invitation_list_range(_src(spark, "/root/testdata/sf0.001"), START, END, 300,
                                     INTERVAL_DAYS, "bo_turnover_usd", 5, T_RANGE, True, as_of=AS_OF)


def _llm():
    """The document operators' query module, or None where it or anything it needs is not installed."""
    try:
        return importlib.import_module("cohortline.llm.queries")
    except ImportError as missing:
        warnings.warn(f"document operators are left out: {missing}", stacklevel=2)
        return None


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return {**_QUERIES, **(llm.QUERIES if llm else {})}


def oracle_sql() -> dict[str, str]:
    llm = _llm()
    return (llm.ORACLE_SQL if llm else {}) | oq.oracle_map(
        report=REPORT, snap=SNAP, v5_start=V5_START, start=START, end=END, v4_start=V4_START,
        history=HISTORY, t_range=T_RANGE, t_day=T_DAY, limit_a=LIMIT_A, pct_a=PCT_A,
        limit_b=LIMIT_B, pct_b=PCT_B, multi=MULTI, auto_low=(AUTO_REPORT, *AUTO_LOW), orders_report=ORDERS_REPORT,
        orders_start=add_months(ORDERS_REPORT, -LOOKBACK))


__all__ = ["entry", "queries", "oracle_sql"]

"""The reference's pipelines as DataFrame compositions.

Stage sizes: the summary is the large relation (actors x active days); after
a rule only the active rows remain, which are small. The active set is written
once as a table under ``spark.checkpoint.dir`` (``session.checkpoint``), with its
profile and after the exclusions: the share, the quota and the ranking all read it,
later stages do not recompute the summary after an executor loss, and their plans
stay small. ``stored`` takes a summary that is already stored or viewed (the table
functions of the reference read one) instead of building it from the facts.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.operators import audience, naming, quota, ranking, rules
from cohortline.params import as_date, today
from cohortline.plans.summary import daily_summary, spec_v1, spec_v2, spec_v3, spec_v4, spec_v5
from cohortline.session import checkpoint
from cohortline.sources.catalog import Sources


def active_users(src: Sources, report_date, metric: str, threshold: float,
                 first_time_meet: bool = True, lookback_months: int = 3,
                 auto_thresholds=(1000, 100), strict_auto_pnl: bool = False,
                 exclusion: str = "rowwise", unsubscribe: bool = True,
                 rule_mode: str = "delta", summary: str = "v5",
                 stored: DataFrame | None = None) -> DataFrame:
    """Rows of the report's previous day meeting the rule, with profile, minus exclusions.

    ``summary``: "v5" = the day's snapshot (NULL where a source had no rows that
    day, negated withdrawals, cross-source metrics); "v3" = the zero-filled
    running summary filtered to the day (the inlined sample). ``stored`` replaces both.
    Returns the checkpointed rows.
    """
    report = as_date(report_date)
    day = report - dt.timedelta(days=1)
    on_day = F.col("date") == F.lit(day)
    # "lag" / "first_ever" look at earlier days, so they run on the whole lookback first
    history = first_time_meet and metric != "auto" and rule_mode != "delta"
    if stored is not None:
        frame = stored if history else stored.filter(on_day)
    elif summary == "v5":
        spec = spec_v5(report, lookback_months)
        frame = daily_summary(src, spec) if history else daily_summary(src, spec, snapshot_day=day)
    elif summary == "v3":
        frame = daily_summary(src, spec_v3(report, lookback_months))
        if not history:
            frame = frame.filter(on_day)
    else:
        raise ValueError(f"unknown summary variant {summary!r}")
    if metric == "auto":
        ruled = rules.auto_rule(frame, auto_thresholds[0], auto_thresholds[1], strict_auto_pnl)
    else:
        ruled = rules.metric_rule(frame, metric, threshold, first_time_meet, rule_mode)
    if history:
        ruled = ruled.filter(on_day)
    active = rules.select_active(ruled).select("actor_id", "date", "metric_value", "metric")
    active = checkpoint(audience.attach_profile(active, src.profile))
    if exclusion:
        active = audience.exclude_internal(active, src.internal_domains, src.statuses, exclusion)
    if unsubscribe:
        active = audience.exclude_unsubscribed(active, src.preferences)
    return checkpoint(active) if exclusion or unsubscribe else active


def invitation_list(src: Sources, report_date, invitation_limit: int, metric: str,
                    percentage_threshold: float, threshold: float, first_time_meet: bool = True,
                    lookback_months: int = 3, auto_thresholds=(1000, 100),
                    strict_auto_pnl: bool = False, exclusion: str = "rowwise",
                    names: str = "max", unsubscribe: bool = True,
                    summary: str = "v5", rule_mode: str = "delta",
                    stored: DataFrame | None = None, exact_share: bool = False) -> DataFrame:
    """One report date; columns actor_id, first_name, last_name, email.

    ``unsubscribe=False, summary="v3"`` is the inlined sample's flavour;
    ``rule_mode="first_ever"`` selects users who reach the threshold for the
    first time within the lookback (the stated intent, H2). ``stored``: a summary that
    holds the report's previous day (and, for "lag" and "first_ever", the days before).
    """
    active = active_users(src, report_date, metric, threshold, first_time_meet,
                          lookback_months, auto_thresholds, strict_auto_pnl, exclusion,
                          unsubscribe, rule_mode=rule_mode, summary=summary, stored=stored)
    quotas = quota.quota_table(active, ["country"], percentage_threshold, invitation_limit, "shared",
                               exact_share, with_rows=True)
    chosen = ranking.rank_and_cut(active, quotas, ["country"])
    named = naming.client_names(chosen.select("actor_id", "email"), src.clients, names)
    return naming.one_row_per_user(named, ["actor_id"], ["first_name", "last_name", "email"])


def invitation_list_range(src: Sources, start_date, end_date, invitation_limit: int,
                          interval_days: int, metric: str, percentage_threshold: float,
                          threshold: float, first_time_meet: bool = False, as_of=None,
                          names: str = "max", stored: DataFrame | None = None,
                          exact_share: bool = False) -> DataFrame:
    """A date range, metrics over ``interval_days`` before ``as_of``; no exclusions.

    Columns actor_id, metric, metric_value, first_name, last_name, email,
    country, login_list; sorted by metric_value.
    """
    as_of = as_date(as_of) if as_of is not None else today()
    start, end = as_date(start_date), as_date(end_date)
    # running sums look back only, so facts from ``end`` on are not read
    summary = stored if stored is not None else daily_summary(src, spec_v4(as_of, interval_days, end))
    in_range = summary.filter((F.col("date") >= F.lit(start)) & (F.col("date") < F.lit(end)))
    ruled = rules.metric_rule(in_range, metric, threshold, first_time_meet)
    active = rules.select_active(ruled).select("actor_id", "date", "metric_value", "metric")
    active = checkpoint(audience.attach_profile(active, src.profile))
    quotas = quota.quota_table(active, ["country"], percentage_threshold, invitation_limit, "shared",
                               exact_share, with_rows=True)
    chosen = ranking.rank_and_cut(active, quotas, ["country"])
    named = naming.client_names(
        chosen.select("actor_id", "metric", "metric_value", "email", "country", "login_list"),
        src.clients, names)
    out = naming.one_row_per_user(
        named, ["actor_id", "metric"],
        ["metric_value", "first_name", "last_name", "email", "country", "login_list"])
    return out.orderBy("metric_value", "actor_id")


# Labels of the multi-metric rules and the column ranking each label.
LAG_LABELS = {
    "cumulative_bo_turnover_usd": "bo_turnover_usd",
    "cumulative_withdrawal_usd": "withdrawal_usd",
    "bo_profit_percentage": "bo_profit_percentage",
    "cumulative_mt5_pnl_usd": "mt5_pnl_usd",
}
DELTA_LABELS = {
    "cumulative_bo_turnover_usd": "bo_turnover_usd",
    "cumulative_bo_profit_usd": "bo_profit_usd",
    "cumulative_withdrawal_usd": "withdrawal_usd",
    "cumulative_mt5_profit_usd": "mt5_profit_usd",
    "cumulative_bo_profit_percentage": "bo_profit_percentage",
}


def labelled_users(src: Sources, start_date, end_date, bo_turnover_limit: float,
                   withdrawal_limit: float, profit_limit: float, mt5_pnl_limit: float,
                   mode: str = "lag", summary_start=None,
                   stored: DataFrame | None = None) -> DataFrame:
    """Rows of ``[start, end)`` labelled by the first multi-metric rule they meet (C9/C8 + C12).

    The summary runs from ``summary_start`` (None: all history) to ``end``; ``stored`` replaces it.
    """
    start, end = as_date(start_date), as_date(end_date)
    col = F.col
    if mode == "lag":
        summary = stored if stored is not None else daily_summary(src, spec_v1(summary_start, end))
        tracked = ["cumulative_bo_turnover_usd", "cumulative_withdrawal_usd", "cumulative_mt5_pnl_usd"]
        summary = rules.with_previous(summary, tracked)   # LAG over the whole history
        labels = [
            ("cumulative_bo_turnover_usd", (col("cumulative_bo_turnover_usd") >= bo_turnover_limit)
             & (col("prev_cumulative_bo_turnover_usd") < bo_turnover_limit)),
            ("cumulative_withdrawal_usd", (col("cumulative_withdrawal_usd") >= withdrawal_limit)
             & (col("prev_cumulative_withdrawal_usd") < withdrawal_limit)),
            ("bo_profit_percentage", col("bo_profit_percentage") >= profit_limit),
            ("cumulative_mt5_pnl_usd", (col("cumulative_mt5_pnl_usd") >= mt5_pnl_limit)
             & (col("prev_cumulative_mt5_pnl_usd") < mt5_pnl_limit)),
        ]
    elif mode == "delta":
        summary = stored if stored is not None else daily_summary(src, spec_v2(summary_start, end))

        def crossed(cum, daily, limit):
            return (col(cum) >= limit) & ((col(cum) - col(daily)) < limit)
        labels = [
            ("cumulative_bo_turnover_usd", crossed("cumulative_bo_turnover_usd", "bo_turnover_usd",
                                                   bo_turnover_limit)),
            ("cumulative_bo_profit_usd", crossed("cumulative_bo_profit_usd", "bo_profit_usd",
                                                 bo_turnover_limit)),
            ("cumulative_withdrawal_usd", crossed("cumulative_withdrawal_usd", "withdrawal_usd",
                                                  withdrawal_limit)),
            ("cumulative_mt5_profit_usd", crossed("cumulative_mt5_profit_usd", "mt5_profit_usd",
                                                  mt5_pnl_limit)),
            ("cumulative_bo_profit_percentage", col("cumulative_bo_profit_percentage") >= profit_limit),
        ]
    else:
        raise ValueError(f"unknown mode {mode!r}")
    in_range = summary.filter((col("date") >= F.lit(start)) & (col("date") < F.lit(end)))
    labelled = rules.label_rules(in_range, labels)
    return labelled.filter(col("metric") != "none")


def multi_metric_invitations(src: Sources, start_date, end_date, invitation_limit: int,
                             threshold: float, bo_turnover_limit: float, withdrawal_limit: float,
                             profit_limit: float, mt5_pnl_limit: float, mode: str = "lag",
                             summary_start=None, names: str = "max",
                             stored: DataFrame | None = None, exact_share: bool = False) -> DataFrame:
    """Per (country, label) shares and capped quotas; each label ranked by its own measure.

    Columns actor_id, metric, first_name, last_name, email, country, login_list.
    The quota is matched on (country, label), not on the country alone.
    """
    order_by = LAG_LABELS if mode == "lag" else DELTA_LABELS
    labelled = labelled_users(src, start_date, end_date, bo_turnover_limit, withdrawal_limit,
                              profit_limit, mt5_pnl_limit, mode, summary_start, stored)
    measures = sorted(set(order_by.values()))
    active = checkpoint(audience.attach_profile(labelled.select("actor_id", "date", "metric", *measures),
                                                src.profile))
    quotas = quota.quota_table(active, ["country", "metric"], threshold, invitation_limit, "capped",
                               exact_share, with_rows=True)
    chosen = ranking.rank_per_label(active, quotas, order_by)
    named = naming.client_names(
        chosen.select("actor_id", "metric", "email", "country", "login_list"), src.clients, names)
    return naming.one_row_per_user(named, ["actor_id", "metric"],
                                   ["first_name", "last_name", "email", "country", "login_list"])

"""The daily summary (one row per actor and active day, measure / cumulative pairs)."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame

from cohortline.operators import series
from cohortline.operators.rollup import summary_parts
from cohortline.params import Scope, SummarySpec, add_months, as_date
from cohortline.sources.catalog import Sources


def daily_summary(src: Sources, spec: SummarySpec, snapshot_day=None) -> DataFrame:
    """Merged daily summary; with ``snapshot_day`` only that day's rows (C7 plan)."""
    day = as_date(snapshot_day) if snapshot_day is not None else None
    return series.build_series(summary_parts(src, spec), spec.fill, spec.cross_source, day)


# Summary variants of the reference, as parameter sets.

def spec_v1(start=None, end=None, first_fact_month=None) -> SummarySpec:
    """Fixed start (None: all history), row-level win test, all payment categories, closed trades.

    ``end`` bounds the facts that are read. ``first_fact_month`` restricts the first fact, and
    only that, to one month.
    """
    month = None if first_fact_month is None else Scope.month_of(first_fact_month)
    return SummarySpec(scope=Scope.since(start, end), first_fact_scope=month,
                       wins="sign", payment_categories="all", third_fact="closed")


def spec_v2(start=None, end=None, first_fact_month=None) -> SummarySpec:
    """v1 plus profit / loss splits and the withdrawal-to-deposit ratio."""
    return replace(spec_v1(start, end, first_fact_month), profit_loss=True)


def spec_v5(report_date, lookback_months: int = 3) -> SummarySpec:
    """Months lookback before the report date, negated withdrawals, cross-source metrics.

    Also produces the profit / loss splits and the withdrawal-to-deposit ratio, so
    every metric the procedures advertise can be selected (H16).
    """
    return SummarySpec(scope=Scope.months_before(report_date, lookback_months),
                       withdrawal_sign=-1, cross_source=True, profit_loss=True)


def spec_v3(report_date, lookback_months: int = 3) -> SummarySpec:
    """The inlined sample: months lookback, raw withdrawals, zero fill."""
    return SummarySpec(scope=Scope.months_before(report_date, lookback_months), fill=0)


def spec_v4(as_of, interval_days: int, end=None) -> SummarySpec:
    """Days lookback from ``as_of`` (up to ``end``), row-level win test, all categories, closing
    sell/credit (plus the profit / loss splits and the ratio, H16)."""
    return SummarySpec(scope=Scope.days_before(as_of, interval_days, end), wins="sign",
                       payment_categories="all", closing_entries=("sell", "credit"),
                       fx_sign=-1, fill=0, profit_loss=True)


def snapshot_summary(src: Sources, report_date, lookback_months: int = 3) -> DataFrame:
    """The stored-table summary: report date's previous day, v5 measures."""
    report = as_date(report_date)
    return daily_summary(src, spec_v5(report, lookback_months), report - dt.timedelta(days=1))


__all__ = ["daily_summary", "snapshot_summary", "spec_v1", "spec_v2", "spec_v3", "spec_v4",
           "spec_v5", "add_months"]

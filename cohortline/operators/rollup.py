"""Daily rollups of the fact relations (C1) and the previous-day currency conversion.

A fact relation is described by a ``DailyPart``: rows already carrying
``actor_id`` and ``date`` plus the row-level values of its measures. The daily
measure is ``post(SUM(value))`` per (actor_id, date). Keeping parts declarative
lets ``series.merge_daily`` roll several facts up in one grouping.

Money is summed as decimals of ``functions.columns.AMOUNT_DECIMALS`` places: exact and independent of the
order of rows, without rounding amounts or rates. Where the sources declare how many decimals amounts have, rows
are summed as whole units in ``bigint`` (about five times as fast) and become decimals per day. Amounts become doubles
only in the output; a converted daily sum is rounded once, to four decimals.

Generated expressions are SQL text: one call to the JVM for each. All names in them are the library's own.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortline.functions.columns import amount_sql, total_sql, zero_sql
from cohortline.params import (AGENT_DEPOSIT, AGENT_WITHDRAWAL, DEPOSIT, WITHDRAWAL, Scope,
                               SummarySpec)
from cohortline.sources.catalog import Sources

KEY = ("actor_id", "date")


@dataclass(eq=False)
class Measure:
    name: str
    value: Column | str                # row-level value (or its SQL text), summed per (actor_id, date)
    kind: str = "money"                # "money" (decimal, output double) or "count"
    post: Callable[[Column], Column] | None = None   # applied to the daily sum
    units: int | None = None           # the value counts whole units of 10^-units

    def row_value(self) -> Column:
        return F.expr(f"{self.value} AS {self.name}") if isinstance(self.value, str) else self.value.alias(self.name)

    def total(self, summed: str) -> str:
        """SQL text of the amount that a sum of row values stands for."""
        return total_sql(summed, self.units)


@dataclass(eq=False)
class Ratio:
    """``numerator / denominator * 100`` daily, and of the running sums (a leading ``-`` negates the numerator)."""

    name: str
    numerator: str
    denominator: str

    def sql(self, prefix: str = "") -> str:
        """Both sides become doubles before dividing; NULL on a zero denominator."""
        sign, top = ("-", self.numerator[1:]) if self.numerator.startswith("-") else ("", self.numerator)
        return (f"try_divide(CAST({sign}{prefix}{top} AS DOUBLE), CAST({prefix}{self.denominator} AS DOUBLE)) * 100.0D")


@dataclass(eq=False)
class DailyPart:
    name: str
    rows: DataFrame                    # actor_id, date, and the columns the measures read
    measures: list[Measure]
    ratios: list[Ratio] = field(default_factory=list)

    @property
    def flag(self) -> str:
        return f"_rows_{self.name}"


def in_scope(date_col: Column, scope: Scope) -> Column:
    cond = F.lit(True)
    if scope.start is not None:
        cond = cond & (date_col >= F.lit(scope.start))
    if scope.end is not None:
        cond = cond & (date_col < F.lit(scope.end))
    return cond


def month_scope(month_col: str, scope: Scope) -> Column:
    """The scope restated on a monthly partition column: ``month >= trunc(start, 'MM')``
    and ``month < end`` (a month that starts before ``end`` may hold in-scope days).
    Redundant with the exact filter, but it lets the scan prune partitions."""
    cond = F.lit(True)
    if scope.start is not None:
        cond = cond & (F.col(month_col) >= F.trunc(F.lit(scope.start), "MM"))
    if scope.end is not None:
        cond = cond & (F.col(month_col) < F.lit(scope.end))
    return cond


def scope_sql(day: str, scope: Scope) -> str:
    parts = [f"{day} {op} DATE'{limit.isoformat()}'" for op, limit in ((">=", scope.start), ("<", scope.end)) if limit is not None]
    return " AND ".join(parts) or "TRUE"


def with_date(df: DataFrame, ts: str, scope: Scope, month_partition: str | None = None) -> DataFrame:
    """Filter a timestamped fact to ``scope`` (pushed to the scan) and add its ``date``."""
    if month_partition is not None:
        df = df.filter(month_scope(month_partition, scope))
    return df.filter(scope_sql(f"to_date({ts})", scope)).withColumn("date", F.expr(f"to_date({ts})"))


def daily_rollup(part: DailyPart) -> DataFrame:
    """One row per (actor_id, date) with the part's daily measures.

    Output types: money as double (summed exactly first), counts as bigint.
    """
    rows = part.rows.filter("actor_id IS NOT NULL").select(*KEY, *[m.row_value() for m in part.measures])
    daily = rows.groupBy(*KEY).agg(*[F.expr(f"{m.total(f'sum({m.name})')} AS {m.name}") for m in part.measures])

    def out(m):
        dtype = "bigint" if m.kind == "count" else "double"
        return m.post(F.col(m.name)).cast(dtype).alias(m.name) if m.post else F.expr(f"CAST({m.name} AS {dtype}) AS {m.name}")
    return daily.select(*KEY, *[out(m) for m in part.measures])


# --------------------------------------------------------------------------- parts

def fact_part(name: str, df: DataFrame, actor_col: str, ts_col: str, scope: Scope,
              measures: list[Measure]) -> DailyPart:
    """A ``DailyPart`` over any timestamped fact: rows in ``scope`` keyed by (actor_id, date)."""
    rows = with_date(df.withColumnRenamed(actor_col, "actor_id"), ts_col, scope)
    return DailyPart(name, rows.filter(F.col("actor_id").isNotNull()), measures)


def _either(condition: str, value: str, other: str) -> str:
    return f"CASE WHEN {condition} THEN {value} ELSE {other} END"


def _flag(condition: str) -> str:
    return f"CAST({_either(condition, '1', '0')} AS BIGINT)"


def _in(column: str, values) -> str:
    return f"{column} IN ({', '.join(repr(str(v)) for v in values)})"


def trades_part(src: Sources, spec: SummarySpec) -> DailyPart:
    scope, units = spec.first_fact_scope or spec.scope, src.amount_decimals
    rows = with_date(src.trades.filter("actor_id IS NOT NULL"), "ts", scope, spec.month_column("trades")).selectExpr(
        "actor_id", "date", *[f"{amount_sql(c, units)} AS {c}" for c in ("turnover", "result", "winning_turnover")],
        "win_count", "contracts")
    zero = zero_sql(units)
    if spec.wins == "precomputed":
        winning, wins = "winning_turnover", "CAST(win_count AS BIGINT)"
    else:
        winning, wins = _either("result < 0", "turnover", zero), _flag("result < 0")

    def money(name, value):
        return Measure(name, value, units=units)
    measures = [
        money("bo_turnover_usd", "turnover"),
        money("bo_winning_turnover_usd", winning),
        Measure("bo_win_count", wins, "count"),
        money("bo_pnl_usd", "-result"),
    ]
    if spec.profit_loss:
        measures += [
            money("bo_profit_usd", _either("result < 0", "-result", zero)),
            money("bo_loss_usd", _either("result > 0", "-result", zero)),
        ]
    measures.append(Measure("bo_contract_count", "CAST(contracts AS BIGINT)", "count"))
    return DailyPart("bo", rows, measures, [Ratio("bo_profit_percentage", "bo_pnl_usd", "bo_turnover_usd")])


def payments_part(src: Sources, spec: SummarySpec) -> DailyPart:
    if spec.payment_categories == "all":
        deposits, withdrawals = (DEPOSIT, AGENT_DEPOSIT), (WITHDRAWAL, AGENT_WITHDRAWAL)
    else:
        deposits, withdrawals = (DEPOSIT,), (WITHDRAWAL,)
    units = src.amount_decimals
    pay = src.payments.filter(f"actor_id IS NOT NULL AND {_in('category', deposits + withdrawals)}")
    rows = with_date(pay, "ts", spec.scope, spec.month_column("payments")).selectExpr(
        "actor_id", "date", "category", f"{amount_sql('amount', units)} AS amount")
    is_dep, is_wd, zero = _in("category", deposits), _in("category", withdrawals), zero_sql(units)
    measures = [
        Measure("deposit_usd", _either(is_dep, "amount", zero), units=units),
        Measure("withdrawal_usd", _either(is_wd, "amount" if spec.withdrawal_sign > 0 else "-amount", zero), units=units),
        Measure("deposit_count", _flag(is_dep), "count"),
        Measure("withdrawal_count", _flag(is_wd), "count"),
    ]
    ratios = [Ratio("withdrawal_deposit_percentage", "-withdrawal_usd", "deposit_usd")] if spec.profit_loss else []
    return DailyPart("pay", rows, measures, ratios)


def convert_prev_day(src: Sources, scope: Scope, closing_entries=("out", "out_by"),
                     target_currency: str = "USD", month_column: str | None = None) -> DataFrame:
    """Deals converted with the rate of the previous day, one row per (login, day).

    Deals are first rolled up per (login, date) (map-side partial aggregation, so
    a hot account collapses before any shuffle), then joined to the account,
    its group's currency and the previous day's rate. The rate is fixed per
    (login, date), so the rate multiplies the day's sum; it is not rounded. A day
    whose closing deals have no rate yields NULL when it has no other deals and 0
    otherwise, as the row-wise ``CASE ... ELSE 0`` would.
    """
    units = src.amount_decimals
    closing = f"coalesce({_in('entry', closing_entries)}, FALSE)"
    row = f"{amount_sql('profit', units)} + {amount_sql('storage', units)}"
    per_login = with_date(src.deals, "ts", scope, month_column).selectExpr(
        "login", "date", f"{closing} AS closing", f"CASE WHEN {closing} THEN {row} END AS closing_amount", "win_deals", "deals")
    per_login = per_login.groupBy("login", "date").agg(*[F.expr(e) for e in (
        f"{total_sql('sum(closing_amount)', units)} AS closing_sum", "count_if(closing) AS n_closing",
        "count_if(NOT closing) AS n_other", "sum(win_deals) AS win_deals", "sum(deals) AS deals")])
    accounts = src.accounts.select("login", "actor_id", "group_name", "server")
    # only the previous days of in-scope deals are needed: (days in scope) x currencies rows
    rate_scope = Scope(None if scope.start is None else scope.start - dt.timedelta(days=1),
                       None if scope.end is None else scope.end - dt.timedelta(days=1))
    rates = src.fx_rates.filter((F.col("target_currency") == target_currency) & F.expr(scope_sql("rate_date", rate_scope))) \
        .selectExpr("rate_date", "source_currency AS rate_currency", "rate")
    joined = (per_login.join(accounts, "login")
              .join(src.account_groups, ["group_name", "server"], "left")
              .join(rates, F.expr("rate_date = date_sub(date, 1) AND rate_currency = currency"), "left"))
    zero = zero_sql()
    converted = (f"CASE WHEN n_closing = 0 THEN {zero} WHEN rate IS NULL THEN CASE WHEN n_other > 0 THEN {zero} END "
                 f"ELSE {amount_sql('CAST(closing_sum AS DOUBLE) * rate')} END")
    return joined.filter("actor_id IS NOT NULL").selectExpr("actor_id", "date", f"{converted} AS converted", "win_deals", "deals")


def fx_deals_part(src: Sources, spec: SummarySpec) -> DailyPart:
    rows = convert_prev_day(src, spec.scope, spec.closing_entries, spec.target_currency,
                            spec.month_column("deals"))
    sign = spec.fx_sign
    measures = [
        # ROUND(SUM(amount * rate), 4), half away from zero
        Measure("mt5_pnl_usd", "converted",
                post=lambda c: F.round(c, 4) if sign > 0 else -F.round(c, 4)),
        Measure("mt5_win_count", "CAST(win_deals AS BIGINT)", "count"),
        Measure("mt5_contract_count", "CAST(deals AS BIGINT)", "count"),
    ]
    return DailyPart("mt5", rows, measures)


def closed_trades_part(src: Sources, spec: SummarySpec) -> DailyPart:
    units = src.amount_decimals
    ct = src.closed_trades.filter((F.col("platform") == spec.platform) & F.col("actor_id").isNotNull())
    if spec.month_column("closed_trades"):
        ct = ct.filter(month_scope(spec.month_column("closed_trades"), spec.scope))
    rows = ct.filter(scope_sql("trade_date", spec.scope)).selectExpr(
        "actor_id", "trade_date AS date", f"{amount_sql('closed_pnl', units)} AS closed_pnl", "trade_count")
    zero = zero_sql(units)
    measures = [Measure("mt5_pnl_usd", "-closed_pnl", units=units)]
    if spec.profit_loss:
        measures += [
            Measure("mt5_profit_usd", _either("closed_pnl < 0", "-closed_pnl", zero), units=units),
            Measure("mt5_loss_usd", _either("closed_pnl > 0", "-closed_pnl", zero), units=units),
        ]
    measures += [
        Measure("mt5_win_count", _flag("closed_pnl < 0"), "count"),
        Measure("mt5_contract_count", "CAST(trade_count AS BIGINT)", "count"),
    ]
    return DailyPart("mt5", rows, measures)


def summary_parts(src: Sources, spec: SummarySpec) -> list[DailyPart]:
    """The three fact parts of a summary spec."""
    third = fx_deals_part(src, spec) if spec.third_fact == "fx" else closed_trades_part(src, spec)
    return [trades_part(src, spec), payments_part(src, spec), third]

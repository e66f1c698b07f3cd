"""Typed parameters for the audience-selection operators.

Each reference variant is a choice of these parameters; nothing is spliced into
SQL text. Dates are ``datetime.date``.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass, field


# Fixed values of the reference's enumerations.
DEPOSIT = "Client Deposit"
WITHDRAWAL = "Client Withdrawal"
AGENT_DEPOSIT = "Payment Agent Deposit"
AGENT_WITHDRAWAL = "Payment Agent Withdrawal"
INTERNAL_STATUS = "internal_client"


def today() -> dt.date:
    """The current day in UTC, the time zone of all day boundaries."""
    return dt.datetime.now(dt.timezone.utc).date()


def add_months(day: dt.date, months: int) -> dt.date:
    """Calendar month shift, clamped to the month end (2022-05-31 - 3 months = 2022-02-28)."""
    index = day.year * 12 + (day.month - 1) + months
    year, month = divmod(index, 12)
    month += 1
    last = calendar.monthrange(year, month)[1]
    return dt.date(year, month, min(day.day, last))


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


@dataclass(frozen=True)
class Scope:
    """Half-open time scope ``[start, end)`` on the fact date; either side may be open."""

    start: dt.date | None = None
    end: dt.date | None = None

    @classmethod
    def months_before(cls, report_date, months: int) -> "Scope":
        report = as_date(report_date)
        return cls(add_months(report, -months), report)

    @classmethod
    def days_before(cls, as_of, days: int, end=None) -> "Scope":
        as_of = as_date(as_of)
        return cls(as_of - dt.timedelta(days=days), None if end is None else as_date(end))

    @classmethod
    def since(cls, start, end=None) -> "Scope":
        """From ``start`` (None: all history) up to ``end`` (None: open)."""
        return cls(None if start is None else as_date(start), None if end is None else as_date(end))

    @classmethod
    def month_of(cls, day) -> "Scope":
        """The calendar month containing ``day`` (one monthly partition)."""
        first = as_date(day).replace(day=1)
        return cls(first, add_months(first, 1))


@dataclass(frozen=True)
class SummarySpec:
    """How the daily summary is built (the choices listed in SURVEY 0.1)."""

    scope: Scope = field(default_factory=Scope)
    # optional narrower scope for the first fact only (a caller who wants one month of it)
    first_fact_scope: Scope | None = None
    # (fact, column) pairs: facts stored by a monthly partition column (first day of the month);
    # the scope is then also stated on that column, so the scan prunes whole partitions.
    # Facts: trades, payments, deals, closed_trades
    month_partitions: tuple[tuple[str, str], ...] = ()
    # "precomputed": wins come from pre-aggregated columns; "sign": row-level sign test
    wins: str = "precomputed"
    # "client": client categories only; "all": client and payment-agent categories
    payment_categories: str = "client"
    # +1 keeps the raw withdrawal sign, -1 negates it
    withdrawal_sign: int = 1
    # "fx": deals converted with the previous day's rate; "closed": pre-converted closed trades
    third_fact: str = "fx"
    # closing entries for the fx conversion and the outer sign of the converted sum
    closing_entries: tuple[str, ...] = ("out", "out_by")
    fx_sign: int = 1
    target_currency: str = "USD"
    platform: str = "MT5"
    # profit / loss splits and the withdrawal-to-deposit ratio (summary v2)
    profit_loss: bool = False
    # cross-source pnl_usd / contract_count (summary v5)
    cross_source: bool = False
    # None keeps a missing side NULL; 0 fills it with zero
    fill: float | None = None

    def month_column(self, fact: str) -> str | None:
        return dict(self.month_partitions).get(fact)

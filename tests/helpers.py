"""Tiny literal relations for unit tests (schemas of ``cohortline.sources.catalog``)."""

from __future__ import annotations

import datetime as dt

from cohortline.sources.catalog import Sources

SCHEMAS = {
    "trades": "actor_id bigint, ts timestamp_ntz, turnover double, result double, "
              "winning_turnover double, win_count bigint, contracts bigint",
    "payments": "actor_id bigint, ts timestamp_ntz, category string, amount double",
    "deals": "login string, ts timestamp_ntz, entry string, profit double, "
             "storage double, win_deals bigint, deals bigint",
    "accounts": "login string, group_name string, server string, actor_id bigint",
    "account_groups": "group_name string, server string, currency string",
    "fx_rates": "rate_date date, source_currency string, target_currency string, rate double",
    "closed_trades": "trade_date date, actor_id bigint, platform string, closed_pnl double, "
                     "trade_count bigint",
    "profile": "actor_id bigint, country string, email string, login_list string",
    "internal_domains": "domain string, company string",
    "statuses": "actor_id bigint, status_code string",
    "preferences": "user_ref string, unsubscribed string",
    "clients": "actor_id bigint, first_name string, last_name string, joined_at timestamp_ntz, "
               "client_seq bigint",
}


def ts(day: int, hour: int = 12) -> dt.datetime:
    return dt.datetime(2024, 1, day, hour)


def day(d: int) -> dt.date:
    return dt.date(2024, 1, d)


def money(x) -> float:
    return round(float(x), 2)


def trade(actor, d, turnover, result=None, contracts=1):
    result = money(turnover if result is None else result)
    won = result < 0
    return (actor, ts(d), money(turnover), result, money(turnover) if won else money(0),
            1 if won else 0, contracts)


def make_sources(spark, **rows) -> Sources:
    frames = {name: spark.createDataFrame(rows.get(name, []), schema)
              for name, schema in SCHEMAS.items()}
    return Sources(**frames)

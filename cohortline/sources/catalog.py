"""The relations the operators read, with the column names they expect.

| relation          | columns                                                               |
| ----------------- | --------------------------------------------------------------------- |
| trades            | actor_id, ts, turnover, result, winning_turnover, win_count, contracts |
| payments          | actor_id, ts, category, amount                                        |
| deals             | login, ts, entry, profit, storage, win_deals, deals                   |
| accounts          | login, group_name, server, actor_id                                   |
| account_groups    | group_name, server, currency                                          |
| fx_rates          | rate_date, source_currency, target_currency, rate                     |
| closed_trades     | trade_date, actor_id, platform, closed_pnl, trade_count               |
| profile           | actor_id, country, email, login_list                                  |
| internal_domains  | domain, company                                                       |
| statuses          | actor_id, status_code                                                 |
| preferences       | user_ref, unsubscribed                                                |
| clients           | actor_id, first_name, last_name, joined_at, client_seq                |

``result`` is the buy price minus the sell price of the first fact (positive when
the client lost). Money columns and rates are doubles and are used unrounded: sums
are taken over decimals of ``functions.columns.AMOUNT_DECIMALS`` places, or over whole units where
``amount_decimals`` declares how many decimals amounts have, so they do not depend on partition order. Timestamps without time zone; days are UTC days.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Declared schemas of the driver tables this library reads. Declaring them
# skips schema inference (a job per table) and fixes the types the code expects.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def read_table(spark: SparkSession, base: str, name: str, columns=None) -> DataFrame:
    """Parquet scan of ``base/name.parquet``; selecting columns prunes the scan."""
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    df = reader.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


@dataclass(eq=False)
class Sources:
    trades: DataFrame
    payments: DataFrame
    deals: DataFrame
    accounts: DataFrame
    account_groups: DataFrame
    fx_rates: DataFrame
    closed_trades: DataFrame
    profile: DataFrame
    internal_domains: DataFrame
    statuses: DataFrame
    preferences: DataFrame
    clients: DataFrame
    # decimals that every amount of the facts is declared to have at most (None: not declared). Declared
    # amounts are summed as whole units in ``bigint``; one with more decimals raises.
    amount_decimals: int | None = None


# What a column of a relation must hold. "key" is an actor, login or client id of any one type.
RELATIONS = {
    "trades": {"actor_id": "key", "ts": "time", "turnover": "number", "result": "number",
               "winning_turnover": "number", "win_count": "whole", "contracts": "whole"},
    "payments": {"actor_id": "key", "ts": "time", "category": "text", "amount": "number"},
    "deals": {"login": "key", "ts": "time", "entry": "text", "profit": "number", "storage": "number",
              "win_deals": "whole", "deals": "whole"},
    "accounts": {"login": "key", "group_name": "text", "server": "text", "actor_id": "key"},
    "account_groups": {"group_name": "text", "server": "text", "currency": "text"},
    "fx_rates": {"rate_date": "day", "source_currency": "text", "target_currency": "text", "rate": "number"},
    "closed_trades": {"trade_date": "day", "actor_id": "key", "platform": "text", "closed_pnl": "number",
                      "trade_count": "whole"},
    "profile": {"actor_id": "key", "country": "text", "email": "text", "login_list": "text"},
    "internal_domains": {"domain": "text", "company": "text"},
    "statuses": {"actor_id": "key", "status_code": "text"},
    "preferences": {"user_ref": "text", "unsubscribed": "text"},
    "clients": {"actor_id": "key", "first_name": "text", "last_name": "text", "joined_at": "time",
                "client_seq": "key"},
}
_KINDS = {
    "key": (T.IntegralType, T.StringType, T.BinaryType),
    "whole": (T.IntegralType,),
    "number": (T.NumericType,),
    "text": (T.StringType,),
    "time": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "day": (T.DateType, T.TimestampType, T.TimestampNTZType),
}


class SchemaMismatch(ValueError):
    """A catalogue table doesn't hold what its relation needs; the message lists every fault found."""


def relation(df: DataFrame, name: str, columns: Mapping[str, str] | None = None) -> tuple[DataFrame, list[str]]:
    """(the columns of relation ``name``, faults); ``columns`` maps a relation's column to the table's own.

    A whole number may be of any width, a number also a decimal (it becomes a double, as amounts are),
    a day also a timestamp. Further columns of the table are not read, but for a partition column that
    ``SummarySpec.month_partitions`` names: list it in ``columns`` under its own name.
    """
    columns = dict(columns or {})
    have = {f.name: f.dataType for f in df.schema.fields}
    out, faults = [], []
    for column, kind in RELATIONS[name].items():
        own = columns.pop(column, column)
        if own not in have:
            faults.append(f"{name}.{column}: no column {own!r}")
        elif not isinstance(have[own], _KINDS[kind]):
            faults.append(f"{name}.{column}: {own!r} is {have[own].simpleString()}, expected {kind}")
        else:
            value = F.col(f"`{own}`")
            value = {"whole": lambda c: c.cast("bigint"), "number": lambda c: c.cast("double"),
                     "day": lambda c: c.cast("date")}.get(kind, lambda c: c)(value)
            out.append(value.alias(column))
    for column, own in columns.items():
        if own in have:
            out.append(F.col(f"`{own}`").alias(column))
        else:
            faults.append(f"{name}.{column}: no column {own!r}")
    return df.select(*out), faults


def catalogue_sources(spark: SparkSession, tables: str | Mapping[str, str],
                      columns: Mapping[str, Mapping[str, str]] | None = None,
                      amount_decimals: int | None = None) -> "Sources":
    """The twelve relations from tables or views of the session's catalogue.

    ``tables`` is a database that holds all of them under their own names, or a mapping of
    relation to table name. The tables are checked against ``RELATIONS`` when the sources are made, from
    the catalogue's schemas alone: nothing is read.
    """
    names = {r: f"{tables}.{r}" for r in RELATIONS} if isinstance(tables, str) else dict(tables)
    missing = [f"{r}: no table is named for it" for r in RELATIONS if r not in names]
    missing += [f"{r}: unknown relation" for r in names if r not in RELATIONS]
    found, faults = {}, missing
    for r in RELATIONS:
        if r not in names:
            continue
        if not spark.catalog.tableExists(names[r]):
            faults.append(f"{r}: no table {names[r]!r}")
            continue
        found[r], wrong = relation(spark.table(names[r]), r, (columns or {}).get(r))
        faults += wrong
    if faults:
        raise SchemaMismatch("; ".join(faults))
    return Sources(**found, amount_decimals=amount_decimals)


def relations(src: "Sources") -> dict[str, DataFrame]:
    return {f.name: getattr(src, f.name) for f in fields(src) if f.name in RELATIONS}

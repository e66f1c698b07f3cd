"""Role mapping of the driver's test tables onto the relations of ``catalog``.

The reference ships no data. Its relations are derived here from ``events``,
``customer`` and ``orders`` (see FIXTURES.md); every relation grows with those
tables. The same mapping is written in SQL for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from cohortline.params import (AGENT_DEPOSIT, AGENT_WITHDRAWAL, DEPOSIT, INTERNAL_STATUS,
                               WITHDRAWAL)
from cohortline.sources.catalog import Sources, read_table


# Deal entries: opening ones and the two closing sets used by the reference.
DEAL_ENTRIES = ("in", "out", "out_by", "sell", "credit", "buy")
# Fixture-only value: the internal e-mail domain of the test data.
INTERNAL_DOMAINS = (("d3.com", "internal"),)


# Decimals of the amounts in the test data.
AMOUNT_DECIMALS = 2

# Rules of the role mapping, as SQL expressions over the tables' columns.
COUNTRY = ("CASE WHEN c_nationkey < 10 THEN 'big0' WHEN c_nationkey < 20 THEN 'big1' "
           "WHEN c_nationkey = 24 THEN CAST(NULL AS STRING) ELSE concat('n', CAST(c_nationkey AS STRING)) END")
EMAIL = ("concat('u', CAST(c_custkey AS STRING), CASE WHEN c_custkey % 11 = 0 THEN '.d' ELSE '@d' END, "
         "CAST(c_custkey % 7 AS STRING), '.com')")
SERVER = "concat('srv', CAST(c_nationkey % 2 AS STRING))"
# what a unit is worth: the test data's currencies range from strong to very weak ones
STRENGTH = ("CASE source_currency WHEN 'AUTOMOBILE' THEN 1.23457D WHEN 'BUILDING' THEN 0.00004D "
            "WHEN 'FURNITURE' THEN 0.00064D WHEN 'HOUSEHOLD' THEN 0.01235D ELSE 1.0D END")


def load_sources(spark: SparkSession, base: str) -> Sources:
    events = read_table(spark, base, "events", ["event_id", "ts", "user_id", "event_type", "value"])
    customer = read_table(spark, base, "customer",
                          ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"])
    orders = read_table(spark, base, "orders",
                        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])

    trades = events.filter("event_type = 'purchase'").selectExpr(
        "user_id AS actor_id", "ts", "value AS turnover",
        "CASE WHEN event_id % 2 = 1 THEN -value ELSE value END AS result", "event_id").selectExpr(
        "actor_id", "ts", "turnover", "result",
        "CASE WHEN result < 0 THEN turnover ELSE 0.0D END AS winning_turnover",
        "CAST(CASE WHEN result < 0 THEN 1 ELSE 0 END AS BIGINT) AS win_count",
        "CAST(1 + event_id % 3 AS BIGINT) AS contracts")

    # large payments go through payment agents
    payments = events.filter("event_type IN ('signup', 'error')").selectExpr(
        "user_id AS actor_id", "ts",
        f"CASE WHEN event_type = 'signup' THEN CASE WHEN value >= 100 THEN '{AGENT_DEPOSIT}' ELSE '{DEPOSIT}' END "
        f"ELSE CASE WHEN value >= 100 THEN '{AGENT_WITHDRAWAL}' ELSE '{WITHDRAWAL}' END END AS category",
        "CASE WHEN event_type <> 'signup' THEN -value ELSE value END AS amount")

    clicks = events.filter("event_type = 'click'")
    entries = ", ".join(f"'{e}'" for e in DEAL_ENTRIES)
    deals = clicks.selectExpr(
        "concat('MT', CAST(user_id AS STRING)) AS login", "ts",
        f"element_at(array({entries}), CAST(event_id % {len(DEAL_ENTRIES)} + 1 AS INT)) AS entry",
        "CASE WHEN event_id % 3 = 0 THEN -value ELSE value END AS profit",
        "CAST(-(event_id % 5) AS DOUBLE) AS storage").selectExpr(
        "*", "CAST(CASE WHEN profit > 0 THEN 1 ELSE 0 END AS BIGINT) AS win_deals", "1L AS deals")

    accounts = customer.selectExpr("concat('MT', CAST(c_custkey AS STRING)) AS login", "c_mktsegment AS group_name",
                                   f"{SERVER} AS server", "c_custkey AS actor_id")
    account_groups = customer.selectExpr("c_mktsegment AS group_name", f"{SERVER} AS server",
                                         "c_mktsegment AS currency").distinct()

    views = events.filter("event_type = 'view'").join(
        customer.selectExpr("c_custkey AS user_id", "c_mktsegment AS source_currency"), "user_id")
    per_day = views.selectExpr("to_date(ts) AS rate_date", "source_currency").groupBy("rate_date", "source_currency").count()
    fx_rates = per_day.selectExpr(
        "rate_date", "source_currency", "count",
        "explode(array(named_struct('target', 'USD', 'base', 1.0D), named_struct('target', 'EUR', 'base', 2.0D))) AS t").selectExpr(
        "rate_date", "source_currency", "t.target AS target_currency",
        f"(t.base + CAST(count AS DOUBLE) * 0.001D) * {STRENGTH} AS rate")

    closed_trades = clicks.selectExpr(
        "to_date(ts) AS trade_date", "user_id AS actor_id",
        "CASE WHEN value < 5 THEN 'CTRADER' ELSE 'MT5' END AS platform",
        "CASE WHEN event_id % 3 <> 0 THEN -value ELSE value END AS closed_pnl",
        "CAST(1 + event_id % 2 AS BIGINT) AS trade_count")

    profile = customer.selectExpr("c_custkey AS actor_id", f"{COUNTRY} AS country", f"{EMAIL} AS email",
                                  "c_name AS login_list")

    domains = ", ".join(f"named_struct('domain', '{d}', 'company', '{c}')" for d, c in INTERNAL_DOMAINS)
    internal_domains = spark.sql(f"SELECT d.domain, d.company FROM (SELECT explode(array({domains})) AS d)")

    statuses = orders.selectExpr(
        "o_custkey AS actor_id",
        f"CASE WHEN o_orderstatus = 'F' AND substring(o_orderpriority, 1, 1) = '1' THEN '{INTERNAL_STATUS}' "
        "ELSE concat(o_orderstatus, '-', substring(o_orderpriority, 1, 1)) END AS status_code").distinct()

    preferences = customer.filter("c_acctbal >= 0").selectExpr(
        "CAST(c_custkey AS STRING) AS user_ref",
        "CASE WHEN c_acctbal > 9000 THEN 'true' ELSE 'false' END AS unsubscribed")

    clients = orders.selectExpr("o_custkey AS actor_id", "o_orderpriority AS first_name", "o_orderstatus AS last_name",
                                "o_orderdate AS joined_at", "o_orderkey AS client_seq")

    return Sources(trades=trades, payments=payments, deals=deals, accounts=accounts,
                   account_groups=account_groups, fx_rates=fx_rates,
                   closed_trades=closed_trades, profile=profile,
                   internal_domains=internal_domains, statuses=statuses,
                   preferences=preferences, clients=clients,
                   amount_decimals=AMOUNT_DECIMALS)

"""SQL objects of a catalogue database for users who write SQL: the summary as a persistent view (P5, C27) and
the multi-metric list as a table function (P76, C26).

Both are texts over the database's relations (``catalogue_sources`` has their columns), so every session of the same
catalogue reads them, and facts that arrive later are seen. The view has the shape of the DataFrame plan: one union
of the facts, one grouping, one window. Names in the texts are the library's own; nothing a user passes is spliced in but
the names of the database and of the objects, which are checked.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from cohortline.functions.columns import AMOUNT_DECIMALS
from cohortline.operators.series import RUNNING
from cohortline.params import AGENT_DEPOSIT, AGENT_WITHDRAWAL, DEPOSIT, WITHDRAWAL, as_date
from cohortline.plans.invitations import DELTA_LABELS, LAG_LABELS

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)*")
_MONEY = f"DECIMAL(28,{AMOUNT_DECIMALS})"


def _name(text: str) -> str:
    if not _NAME.fullmatch(text):
        raise ValueError(f"not a name: {text!r}")
    return text


def _money(column: str) -> str:
    return f"CAST({column} AS {_MONEY})"


def _parts(database: str, start, profit_loss: bool) -> list[tuple]:
    """(flag, relation, day, conditions, {measure: (row value, is money)}, [(ratio, numerator, denominator)])."""
    result, turnover, amount, pnl = (_money(c) for c in ("result", "turnover", "amount", "closed_pnl"))
    zero = f"CAST(0 AS {_MONEY})"
    deposit = f"category IN ('{DEPOSIT}', '{AGENT_DEPOSIT}')"
    withdrawal = f"category IN ('{WITHDRAWAL}', '{AGENT_WITHDRAWAL}')"

    def either(condition, value, other=zero):
        return f"CASE WHEN {condition} THEN {value} ELSE {other} END"

    def one(condition):
        return f"CAST({either(condition, 1, 0)} AS BIGINT)"

    bo = {"bo_turnover_usd": (turnover, True), "bo_winning_turnover_usd": (either(f"{result} < 0", turnover), True),
          "bo_win_count": (one(f"{result} < 0"), False), "bo_pnl_usd": (f"-{result}", True)}
    mt5 = {"mt5_pnl_usd": (f"-{pnl}", True)}
    if profit_loss:
        bo |= {"bo_profit_usd": (either(f"{result} < 0", f"-{result}"), True),
               "bo_loss_usd": (either(f"{result} > 0", f"-{result}"), True)}
        mt5 |= {"mt5_profit_usd": (either(f"{pnl} < 0", f"-{pnl}"), True),
                "mt5_loss_usd": (either(f"{pnl} > 0", f"-{pnl}"), True)}
    bo["bo_contract_count"] = ("CAST(contracts AS BIGINT)", False)
    mt5 |= {"mt5_win_count": (one(f"{pnl} < 0"), False), "mt5_contract_count": ("CAST(trade_count AS BIGINT)", False)}
    pay = {"deposit_usd": (either(deposit, amount), True), "withdrawal_usd": (either(withdrawal, amount), True),
           "deposit_count": (one(deposit), False), "withdrawal_count": (one(withdrawal), False)}
    since = "" if start is None else " AND {day} >= DATE'" + as_date(start).isoformat() + "'"
    return [("_rows_bo", f"{database}.trades", "to_date(ts)", f"TRUE{since}", bo,
             [("bo_profit_percentage", "bo_pnl_usd", "bo_turnover_usd", "")]),
            ("_rows_pay", f"{database}.payments", "to_date(ts)", f"({deposit} OR {withdrawal}){since}", pay,
             [("withdrawal_deposit_percentage", "withdrawal_usd", "deposit_usd", "-")] if profit_loss else []),
            ("_rows_mt5", f"{database}.closed_trades", "trade_date", f"platform = 'MT5'{since}", mt5, [])]


def summary_sql(database: str, start=None, profit_loss: bool = False, order_by=()) -> str:
    """The summary of ``spec_v1`` (``profit_loss``: ``spec_v2``) as a query over the relations of ``database``."""
    parts = _parts(_name(database), start, profit_loss)
    measures = [(flag, m, money) for flag, *_, values, _ in parts for m, (_, money) in values.items()]
    selects = []
    for flag, table, day, where, values, _ in parts:
        none = {True: f"CAST(NULL AS {_MONEY})", False: "CAST(NULL AS BIGINT)"}
        columns = [f"{values[m][0] if f == flag else none[money]} AS {m}" for f, m, money in measures]
        flags = [f"{'1L' if f == flag else 'CAST(NULL AS BIGINT)'} AS {f}" for f, *_ in parts]
        selects.append(f"SELECT actor_id, {day} AS date, {', '.join(columns + flags)} FROM {table} "
                       f"WHERE actor_id IS NOT NULL AND {where.format(day=day)}")
    daily = ", ".join([f"sum({m}) AS {m}" for _, m, _ in measures] + [f"count({flag}) AS {flag}" for flag, *_ in parts])
    running = ", ".join(f"sum({m}) OVER {RUNNING} AS cumulative_{m}" for _, m, _ in measures)
    out = []
    for flag, *_, values, ratios in parts:
        for m, (_, money) in values.items():
            out += [f"CAST(CASE WHEN {flag} > 0 THEN {p}{m} END AS {'DOUBLE' if money else 'BIGINT'}) AS {p}{m}" for p in ("", "cumulative_")]
        for name, top, bottom, sign in ratios:
            out += [f"CASE WHEN {flag} > 0 THEN try_divide(CAST({sign}{p}{top} AS DOUBLE), CAST({p}{bottom} AS DOUBLE)) * 100.0D END AS {p}{name}"
                    for p in ("", "cumulative_")]
    order = f" ORDER BY {', '.join(_name(c) for c in order_by)}" if order_by else ""
    return (f"WITH facts AS ({' UNION ALL '.join(selects)}), "
            f"daily AS (SELECT actor_id, date, {daily} FROM facts GROUP BY actor_id, date), "
            f"totals AS (SELECT *, {running} FROM daily) "
            f"SELECT actor_id, date, {', '.join(out)} FROM totals{order}")


def create_summary_view(spark: SparkSession, view: str, database: str, start=None, profit_loss: bool = False,
                        order_by=()) -> None:
    """A persistent view of the summary; its reader sees the facts as they are then."""
    spark.sql(f"CREATE OR REPLACE VIEW {_name(view)} AS {summary_sql(database, start, profit_loss, order_by)}")


# (label, limit parameter, how it is met): below the limit on the row before, below it without the row, or reached
LAG_RULES = (("cumulative_bo_turnover_usd", "bo_turnover_limit", "lag"), ("cumulative_withdrawal_usd", "withdrawal_limit", "lag"),
             ("bo_profit_percentage", "profit_limit", "level"), ("cumulative_mt5_pnl_usd", "mt5_pnl_limit", "lag"))
DELTA_RULES = (("cumulative_bo_turnover_usd", "bo_turnover_limit", "delta"), ("cumulative_bo_profit_usd", "bo_turnover_limit", "delta"),
               ("cumulative_withdrawal_usd", "withdrawal_limit", "delta"), ("cumulative_mt5_profit_usd", "mt5_pnl_limit", "delta"),
               ("cumulative_bo_profit_percentage", "profit_limit", "level"))


def create_invitation_function(spark: SparkSession, function: str, view: str, database: str, mode: str = "lag") -> None:
    """A table function of a database, called by its own name there (``USE database``; Spark takes no database in the call).

    ``SELECT * FROM function(start_date, end_date, invitation_limit, threshold, bo_turnover_limit, withdrawal_limit,
    profit_limit, mt5_pnl_limit)`` gives the rows of ``multi_metric_invitations`` over the summary ``view``
    (for ``mode="delta"`` one with profit and loss)."""
    rules, order_by = {"lag": (LAG_RULES, LAG_LABELS), "delta": (DELTA_RULES, DELTA_LABELS)}[mode]
    met = {"lag": "{c} >= {limit} AND before_{c} < {limit}", "delta": "{c} >= {limit} AND {c} - {d} < {limit}", "level": "{c} >= {limit}"}
    labels = " ".join(f"WHEN {met[how].format(c=label, d=label.removeprefix('cumulative_'), limit=limit)} THEN '{label}'"
                      for label, limit, how in rules)
    before = ", ".join(f"lag({label}) OVER (PARTITION BY actor_id ORDER BY date) AS before_{label}"
                       for label, _, how in rules if how == "lag")
    value = " ".join(f"WHEN '{label}' THEN CAST({column} AS DOUBLE)" for label, column in order_by.items())
    actor = spark.table(f"{_name(database)}.profile").schema["actor_id"].dataType.simpleString()
    spark.sql(f"""
CREATE OR REPLACE FUNCTION {_name(function)}(start_date DATE, end_date DATE, invitation_limit BIGINT, threshold BIGINT,
    bo_turnover_limit DOUBLE, withdrawal_limit DOUBLE, profit_limit DOUBLE, mt5_pnl_limit DOUBLE)
RETURNS TABLE (actor_id {actor}, metric STRING, first_name STRING, last_name STRING, email STRING, country STRING, login_list STRING)
RETURN
WITH series AS (SELECT *{', ' + before if before else ''} FROM {_name(view)}),
labelled AS (SELECT *, CASE {labels} END AS metric FROM series WHERE date >= start_date AND date < end_date),
active AS (SELECT l.actor_id, l.date, l.metric, CASE l.metric {value} END AS order_value, p.country, p.email, p.login_list
           FROM labelled l JOIN {database}.profile p ON p.actor_id = l.actor_id WHERE l.metric IS NOT NULL),
counts AS (SELECT country, metric, count(DISTINCT actor_id) AS n FROM active GROUP BY country, metric),
shares AS (SELECT *, CAST((200 * n + sum(n) OVER ()) DIV (2 * sum(n) OVER ()) AS DOUBLE) / 100.0D * 100.0D AS percentage FROM counts),
quotas AS (SELECT country, metric, CASE WHEN n > invitation_limit AND percentage > threshold THEN invitation_limit ELSE n END AS places
           FROM shares),
ranked AS (SELECT a.*, q.places, row_number() OVER (PARTITION BY a.country, a.metric
               ORDER BY a.order_value DESC NULLS LAST, a.actor_id, a.date) AS place
           FROM active a JOIN quotas q ON q.country = a.country AND q.metric = a.metric),
names AS (SELECT actor_id, max(first_name) AS first_name, max(last_name) AS last_name FROM {database}.clients GROUP BY actor_id)
SELECT r.actor_id, r.metric, max(n.first_name), max(n.last_name), max(r.email), max(r.country), max(r.login_list)
FROM ranked r LEFT JOIN names n ON n.actor_id = r.actor_id
WHERE r.place <= r.places
GROUP BY r.actor_id, r.metric""")


def call_function(spark: SparkSession, function: str, *arguments) -> DataFrame:
    """``SELECT * FROM function(arguments)`` with bound arguments, whatever database the session is in."""
    database, _, own = _name(function).rpartition(".")
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(database or before)
    try:
        values = {f"a{k}": v for k, v in enumerate(arguments)}
        return spark.sql(f"SELECT * FROM {own}({', '.join(':' + k for k in values)})", args=values)
    finally:
        spark.catalog.setCurrentDatabase(before)


__all__ = ["call_function", "create_invitation_function", "create_summary_view", "summary_sql"]

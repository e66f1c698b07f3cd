"""Threshold rules on the daily summary (C8-C12, C23, first-ever option).

Each rule returns the summary with ``metric`` (label), ``metric_value`` and a
boolean ``meet``; ``select_active`` keeps rows where ``meet`` is TRUE (NULL drops).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions.columns import crossed, metric_columns, reached


def actor_history():
    return Window.partitionBy("actor_id").orderBy("date")


def metric_rule(summary: DataFrame, metric: str, threshold: float, first_time: bool = True,
                mode: str = "delta") -> DataFrame:
    """C8 / C10 / C9 / first-ever on a catalogued metric (C23 allow-list).

    ``first_time`` False: level rule ``cumulative >= T`` (C10).
    ``mode``: "delta" = crossed on this row (``cum - daily < T``, C8);
    "lag" = previous summary row's total below T (C9); "first_ever" = no earlier
    row of the actor reached T (running max of earlier rows), the stated intent.
    The lag / first-ever modes need the full history, so apply them before any
    date filter.
    """
    daily, cum = metric_columns(metric, summary.columns)
    if not first_time:
        meet = reached(cum, threshold)
    elif mode == "delta":
        meet = crossed(cum, daily, threshold)
    elif mode == "lag":
        meet = reached(cum, threshold) & (F.lag(cum).over(actor_history()) < F.lit(float(threshold)))
    elif mode == "first_ever":
        earlier = actor_history().rowsBetween(Window.unboundedPreceding, -1)
        prior_max = F.max(cum).over(earlier)
        meet = reached(cum, threshold) & (prior_max.isNull() | (prior_max < F.lit(float(threshold))))
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return summary.select("*", cum.alias("metric_value"), F.lit(metric).alias("metric"),
                          meet.alias("meet"))


def auto_rule(summary: DataFrame, contract_threshold: float = 1000, pnl_threshold: float = 100,
              strict_pnl: bool = False) -> DataFrame:
    """C11: contract count crossed its threshold and cumulative P/L at (or above) its threshold.

    The ranking value is the cumulative withdrawal count and the label ``Auto``.
    """
    pnl = F.col("cumulative_pnl_usd")
    pnl_ok = pnl > F.lit(float(pnl_threshold)) if strict_pnl else pnl >= F.lit(float(pnl_threshold))
    meet = crossed(F.col("cumulative_contract_count"), F.col("contract_count"), contract_threshold) & pnl_ok
    return summary.select("*", F.col("cumulative_withdrawal_count").alias("metric_value"),
                          F.lit("Auto").alias("metric"), meet.alias("meet"))


def select_active(ruled: DataFrame) -> DataFrame:
    return ruled.filter(F.col("meet"))


def label_rules(df: DataFrame, rules: list[tuple[str, Column]], default: str = "none",
                name: str = "metric") -> DataFrame:
    """The first rule whose predicate holds names the row, else ``default``."""
    expr = reduce(lambda acc, r: acc.when(r[1], F.lit(r[0])),
                  rules[1:], F.when(rules[0][1], F.lit(rules[0][0])))
    return df.withColumn(name, expr.otherwise(F.lit(default)))


def with_previous(summary: DataFrame, columns) -> DataFrame:
    """``prev_<c>`` = LAG(c) per actor by date, for every ``c`` (one window pass)."""
    w = actor_history()
    return summary.select("*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in columns])

"""Threshold estimation from quantiles of the summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The quantile taken per summary column (percent of 100 buckets).
DEFAULT_QUANTILES = {
    "cumulative_bo_turnover_usd": 80,
    "cumulative_bo_winning_turnover_usd": 80,
    "cumulative_bo_win_count": 90,
    "cumulative_bo_profit_percentage": 80,
    "cumulative_bo_contract_count": 80,
    "cumulative_withdrawal_usd": 80,
    "cumulative_deposit_count": 80,
    "cumulative_deposit_usd": 80,
    "cumulative_withdrawal_count": 80,
    "cumulative_bo_pnl_usd": 80,
    "cumulative_pnl_usd": 80,
    "cumulative_contract_count": 80,
}

ACCURACY = 10_000


def estimate_thresholds(summary: DataFrame, quantiles: dict[str, int] | None = None,
                        accuracy: int = ACCURACY) -> DataFrame:
    """One row: ``<column>_threshold = ROUND(approx. percentile)`` for each column.

    ``percentile_approx`` is a mergeable sketch: partial per task, merged once,
    so it scales with the data; its rank error is at most rows / ``accuracy``.
    """
    quantiles = quantiles or DEFAULT_QUANTILES
    return summary.agg(*[
        F.round(F.percentile_approx(F.col(c).cast("double"), q / 100.0, accuracy))
        .alias(f"{c}_threshold")
        for c, q in quantiles.items()
    ])


def quantile_array(summary: DataFrame, column: str, buckets: int = 100, offsets=(80, 90),
                   accuracy: int = ACCURACY) -> DataFrame:
    """The bucketed form: one sketch, several offsets read from the returned array."""
    levels = [i / float(buckets) for i in range(buckets + 1)]
    arr = F.percentile_approx(F.col(column).cast("double"), F.array(*[F.lit(x) for x in levels]),
                              accuracy)
    agg = summary.agg(arr.alias("_q"))
    return agg.select(*[F.col("_q")[o].alias(f"{column}_q{o}") for o in offsets])

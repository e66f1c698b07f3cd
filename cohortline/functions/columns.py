"""Scalar column expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The metric names a caller may select (the reference's catalogue).
# Each name ``m`` selects the daily column ``m`` and the running column ``cumulative_m``.
METRICS = (
    "bo_turnover_usd",
    "bo_winning_turnover_usd",
    "bo_pnl_usd",
    "bo_profit_usd",
    "bo_win_count",
    "bo_profit_percentage",
    "bo_contract_count",
    "deposit_usd",
    "withdrawal_usd",
    "deposit_count",
    "withdrawal_count",
    "withdrawal_deposit_percentage",
    "mt5_pnl_usd",
    "mt5_profit_usd",
    "mt5_win_count",
    "mt5_contract_count",
    "pnl_usd",
    "contract_count",
)


def metric_columns(metric: str, columns=None) -> tuple[Column, Column]:
    """(daily, cumulative) columns for a catalogued metric name (allow-list, never raw SQL)."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {', '.join(METRICS)}")
    if columns is not None and f"cumulative_{metric}" not in columns:
        raise ValueError(f"metric {metric!r} is not produced by this summary")
    return F.col(metric), F.col(f"cumulative_{metric}")


def safe_percentage(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator * 100 in double, NULL when the denominator is 0 or NULL."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double")) * F.lit(100.0)


# Decimals that sums of amounts keep. Doubles of 1e6 and more hold no finer part, and a smaller
# amount loses less than 1e-10 of one unit.
AMOUNT_DECIMALS = 10


def exact(amount: Column, decimals: int = AMOUNT_DECIMALS) -> Column:
    """A double amount as decimal(28, ``decimals``), so that sums are exact and independent of
    the order of rows; an amount that does not fit raises. Its sum is a decimal(38, ``decimals``)."""
    return amount.cast("double").cast(f"decimal(28,{decimals})")


def amount_sql(column: str, decimals: int | None = None) -> str:
    """The row value of an amount whose sum is exact: a decimal as ``exact`` gives it, or whole units of
    10^-``decimals`` as a ``bigint`` where that many decimals are declared. Units are only taken where they give the amount
    back; an amount with more decimals, or of 2^53 units and more, raises."""
    if decimals is None:
        return f"CAST(CAST({column} AS DOUBLE) AS DECIMAL(28,{AMOUNT_DECIMALS}))"
    scale, most = f"{10 ** decimals}.0D", f"{2 ** 53}.0D"
    return (f"CASE WHEN {column} IS NULL THEN NULL "
            f"WHEN rint({column} * {scale}) / {scale} = {column} AND abs({column}) * {scale} < {most} "
            f"THEN CAST(rint({column} * {scale}) AS BIGINT) "
            f"ELSE CAST(raise_error(concat('amount with more than {decimals} decimals: ', CAST({column} AS STRING))) AS BIGINT) END")


def zero_sql(decimals: int | None = None) -> str:
    return f"CAST(0 AS DECIMAL(28,{AMOUNT_DECIMALS}))" if decimals is None else "0L"


def total_sql(total: str, decimals: int | None = None) -> str:
    """The sum of ``amount_sql`` values as a decimal amount."""
    if decimals is None:
        return total
    unit = f"CAST('{10 ** -decimals:.{decimals}f}' AS DECIMAL({decimals + 1},{decimals}))"
    return f"CAST(CAST({total} AS DECIMAL(20,0)) * {unit} AS DECIMAL(38,{AMOUNT_DECIMALS}))"


def crossed(cumulative: Column, daily: Column, threshold: float) -> Column:
    """Running total reached the threshold on this row and was below it before the row."""
    t = F.lit(float(threshold))
    return (cumulative >= t) & ((cumulative - daily) < t)


def reached(cumulative: Column, threshold: float) -> Column:
    return cumulative >= F.lit(float(threshold))


def email_domain(email: Column) -> Column:
    """Text after the first '@'; NULL when there is none (as the regex extract would give)."""
    return F.nullif(F.regexp_extract(email, r"@(.*)", 1), F.lit(""))


def round_half_up_div(numerator: Column, denominator: Column) -> Column:
    """round(numerator / denominator) for numerator >= 0, denominator > 0, in exact integers
    (NULL when the denominator is 0)."""
    x = numerator.cast("bigint") * 2 + denominator.cast("bigint")
    y = F.nullif(denominator.cast("bigint") * 2, F.lit(0).cast("bigint"))   # 0 -> NULL, not an error
    # x - pmod(x, y) is an exact multiple of y, so the quotient is an exact integer
    return ((x - F.pmod(x, y)) / y).cast("bigint")


def whole_percent(part: Column, total: Column) -> Column:
    """part / total as a whole percent, rounded exactly on integers."""
    return round_half_up_div(part.cast("bigint") * 100, total.cast("bigint"))


def rounded_share(part: Column, total: Column) -> Column:
    """ROUND(part / total, 2) * 100 in double arithmetic: 7 of 100 gives 7.000000000000001."""
    return whole_percent(part, total).cast("double") / F.lit(100.0) * F.lit(100.0)

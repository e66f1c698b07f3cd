"""Per-group shares and quotas.

The active set is read once: one aggregation gives a row per group (country, or country and label), and
grand totals (sum of the counts, sum of the ``below`` counts, number of ``above`` groups) are windows over those
rows, as ``SUM(COUNT(DISTINCT ..)) OVER ()`` is. Only the group table, a row per country, passes such a
window. Nothing runs while a query is built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortline.functions.columns import round_half_up_div, rounded_share, whole_percent


def _status(pct: Column, percentage_threshold: float) -> Column:
    return F.when(pct > F.lit(float(percentage_threshold)), F.lit("above")).otherwise(F.lit("below"))


def group_share(df: DataFrame, keys=("country",), percentage_threshold: float = 5,
                actor: str = "actor_id", exact_share: bool = False,
                with_rows: bool = False) -> DataFrame:
    """Distinct actors per group, their share in percent, ``above`` / ``below``.

    The share is ``ROUND(n / total, 2) * 100``, where ``total`` is the sum of the
    per-group counts; the multiplication is one of doubles, so 7 of 100 is just above 7
    (the reference's result). ``exact_share`` takes the whole percent itself.
    """
    keys = list(keys)
    counts = df.groupBy(*keys).agg(F.count_distinct(actor).alias("count_user"),
                                   F.count(F.lit(1)).alias("count_rows"))
    return share_of(counts, keys, percentage_threshold, exact_share, with_rows)


def over_groups() -> Window:
    """All rows of a group table."""
    return Window.partitionBy(F.lit(0))


def share_of(counts: DataFrame, keys, percentage_threshold: float = 5, exact_share: bool = False,
             with_rows: bool = False) -> DataFrame:
    """C16 from the counts of each group (``count_user``), however these were found."""
    share = whole_percent if exact_share else rounded_share
    pct = share(F.col("count_user"), F.sum("count_user").over(over_groups())).cast("double")
    shared = counts.withColumn("percentage", pct).withColumn("status", _status(F.col("percentage"), percentage_threshold))
    return shared.select(*keys, "count_user", "percentage", "status", *(["count_rows"] if with_rows else []))


def quota_shared(share: DataFrame, invitation_limit: int) -> DataFrame:
    """Groups under the limit or ``below`` keep all; ``above`` groups split the remainder.

    ``final_number_user = round(max(limit - sum of below counts, 0) / #above)``.
    """
    limit = F.lit(int(invitation_limit)).cast("bigint")
    below = F.when(F.col("status") == "below", F.col("count_user"))
    above = F.when(F.col("status") == "above", F.lit(1))
    totals = share.withColumn("_below_sum", F.coalesce(F.sum(below).over(over_groups()), F.lit(0)).cast("bigint")) \
        .withColumn("_n_above", F.count(above).over(over_groups()))
    remainder = round_half_up_div(F.greatest(limit - F.col("_below_sum"), F.lit(0).cast("bigint")),
                                  F.col("_n_above"))
    n = F.col("count_user")
    final = (F.when(n <= limit, n)
             .when(F.col("status") == "below", n)
             .when(F.col("status") == "above", remainder))
    return totals.withColumn("final_number_user", final.cast("bigint")).drop("_below_sum", "_n_above")


def quota_capped(share: DataFrame, invitation_limit: int) -> DataFrame:
    """Groups under the limit or ``below`` keep all; ``above`` groups get the limit."""
    limit = F.lit(int(invitation_limit)).cast("bigint")
    n = F.col("count_user")
    final = (F.when(n <= limit, n)
             .when(F.col("status") == "below", n)
             .when(F.col("status") == "above", limit))
    return share.withColumn("final_number_user", final.cast("bigint"))


def quota_table(df: DataFrame, keys, percentage_threshold: float, invitation_limit: int,
                rule: str = "shared", exact_share: bool = False, with_rows: bool = False) -> DataFrame:
    """Share and quota per group (``with_rows``: also the rows of each group, ``count_rows``)."""
    share = group_share(df, keys, percentage_threshold, exact_share=exact_share, with_rows=with_rows)
    if rule == "shared":
        return quota_shared(share, invitation_limit)
    if rule == "capped":
        return quota_capped(share, invitation_limit)
    raise ValueError(f"unknown quota rule {rule!r}")

"""Top rows per group with a per-group quota.

``ROW_NUMBER() OVER (PARTITION BY group ORDER BY value DESC) <= quota`` puts a whole group into
one task. A row among the first ``quota`` of its group is also among the first ``quota`` of any part of
the group, so the groups are ranked twice: first in ``splits`` parts each, by a hash of the row, of
which at most ``quota`` rows are left, then what is left of the group. A country with a third of all
rows is sorted in ``splits`` tasks, and the last step sees at most ``splits * quota`` of its rows.
Groups whose quota covers all their rows are kept whole without ranking.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPLITS = 64


def top_per_group(df: DataFrame, group_cols, order_cols: list[Column], limit_col: str,
                  rows_col: str, splits: int = SPLITS) -> DataFrame:
    """Rows whose rank inside their group is ``<= limit_col``; NULL limits keep nothing.

    ``rows_col`` holds the number of rows of the group.
    """
    cut = F.col(rows_col) > F.col(limit_col)
    part = F.pmod(F.xxhash64(*[c for c in df.columns if c not in group_cols]), F.lit(splits))
    parted = df.filter(F.col(limit_col).isNotNull()).withColumn("_part", part)
    for step in range(2):
        rank = F.row_number().over(Window.partitionBy(*group_cols, "_part").orderBy(*order_cols))
        parted = parted.withColumn("_rank", rank).filter(~cut | (F.col("_rank") <= F.col(limit_col)))
        # second step: the parts of a cut group meet, a whole group stays in parts
        parted = parted.withColumn("_part", F.when(cut, F.lit(0)).otherwise(F.col("_part"))).drop("_rank")
    return parted.drop(rows_col, "_part")


BINS = 128


def select_top(df: DataFrame, group_cols, value_col: str, order_cols: list[Column], limit_col: str,
               rows_col: str, bins: int = BINS, splits: int = SPLITS) -> DataFrame:
    """The rows of ``top_per_group``, found by selection instead of by sorting the groups.

    ``order_cols`` begin with ``value_col`` descending. A quantile sketch of each group's values gives the edges of at most ``bins``
    bins, an exact count per bin tells which bin holds the row of rank ``limit_col``: bins
    above it are kept whole, bins below it are dropped, and only the rows of that one bin are ranked (by
    ``top_per_group``, so a value that a third of all rows share is spread out, too). The edges only decide how few rows are ranked:
    counts are exact, ties are settled by all of ``order_cols``, and NULL values form the last bin. Groups without a cut are kept
    without reading their values; the group tables hold one row per group, or per group and bin.
    """
    group_cols = list(group_cols)
    limited = df.filter(F.col(limit_col).isNotNull())
    cut = F.col(rows_col) > F.col(limit_col)
    whole, parted = limited.filter(~cut), limited.filter(cut)
    levels = F.array(*[F.lit(k / bins) for k in range(1, bins)])
    value = F.col(value_col).cast("double")
    edges = parted.groupBy(*group_cols).agg(F.percentile_approx(value, levels, 100 * bins).alias("_edges"))
    # edges above a value: 0 for the greatest; NULL sorts last
    bin_ = F.when(value.isNull(), F.lit(bins)).otherwise(
        F.size(F.filter(F.coalesce("_edges", F.array().cast("array<double>")), lambda e: e > value)))
    null_safe = [F.col(f"_e.{c}").eqNullSafe(F.col(f"_d.{c}")) for c in group_cols]
    binned = parted.alias("_d").join(edges.alias("_e"), null_safe).withColumn("_bin", bin_) \
        .select(*[f"_d.{c}" for c in df.columns], "_bin")
    counts = binned.groupBy(*group_cols, "_bin").agg(F.count(F.lit(1)).alias("_n"), F.max(limit_col).alias("_limit"))
    above = F.coalesce(F.sum("_n").over(Window.partitionBy(*group_cols).orderBy("_bin").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    at_cut = counts.withColumn("_above", above).filter(
        (F.col("_above") < F.col("_limit")) & (F.col("_above") + F.col("_n") > F.col("_limit")) | (F.col("_above") == F.col("_limit")))
    # the bin of the cut; where a bin ends at the limit, the next one is cut to no row
    at_cut = at_cut.groupBy(*group_cols).agg(F.min(F.struct("_bin", (F.col("_limit") - F.col("_above")).alias("_left"), "_n")).alias("_cut"))
    null_safe = [F.col(f"_b.{c}").eqNullSafe(F.col(f"_c.{c}")) for c in group_cols]
    beside = binned.alias("_b").join(at_cut.alias("_c"), null_safe).filter(F.col("_bin") <= F.col("_cut._bin"))
    beside = beside.select(*[f"_b.{c}" for c in df.columns], "_bin", "_cut")
    higher = beside.filter(F.col("_bin") < F.col("_cut._bin")).select(*df.columns)
    in_bin = beside.filter(F.col("_bin") == F.col("_cut._bin")).select(
        *df.columns, F.col("_cut._left").alias("_left"), F.col("_cut._n").alias("_in_bin"))
    ranked = top_per_group(in_bin, group_cols, order_cols, "_left", "_in_bin", splits).select(
        *[c for c in df.columns if c != rows_col])
    return whole.drop(rows_col).unionByName(higher.drop(rows_col)).unionByName(ranked)


def rank_and_cut(df: DataFrame, quota: DataFrame, group_cols=("country",),
                 order_cols: list[Column] | None = None, limit_col: str = "final_number_user",
                 splits: int = SPLITS, select_by: str | None = None) -> DataFrame:
    """Attach each group's quota (a NULL group never matches) and keep its top rows.

    Default order: ``metric_value`` descending, ties by ``actor_id`` then ``date``. A quota
    table with ``count_rows`` spares the grouping that counts the rows of each group. ``select_by`` names the
    column that the order begins with (descending): the rows are then found by ``select_top``, which
    reads them three times and sorts few of them, for stored active sets with large cut groups.
    """
    group_cols = list(group_cols)
    order_cols = order_cols or [F.col("metric_value").desc(), F.col("actor_id").asc(),
                                F.col("date").asc()]
    if "count_rows" not in quota.columns:
        quota = quota.join(df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("count_rows")), group_cols)
    limits = quota.select(*group_cols, limit_col, F.col("count_rows").alias("_rows"))
    limited = df.join(limits, group_cols)
    if select_by is not None:
        return select_top(limited, group_cols, select_by, order_cols, limit_col, "_rows", splits=splits)
    return top_per_group(limited, group_cols, order_cols, limit_col, "_rows", splits)


def rank_per_label(df: DataFrame, quota: DataFrame, order_by_label: dict[str, str],
                   group_cols=("country", "metric"), limit_col: str = "final_number_user",
                   splits: int = SPLITS) -> DataFrame:
    """Each label ranked by its own column, all labels in one pass.

    ``order_by_label`` maps label -> column whose value (descending) ranks that
    label's rows; rows of other labels are dropped.
    """
    expr = None
    for label, col in order_by_label.items():
        cond = F.col("metric") == F.lit(label)
        expr = F.when(cond, F.col(col).cast("double")) if expr is None else expr.when(
            cond, F.col(col).cast("double"))
    labelled = df.filter(F.col("metric").isin(*order_by_label)).withColumn("_order_value", expr)
    order_cols = [F.col("_order_value").desc_nulls_last(), F.col("actor_id").asc(),
                  F.col("date").asc()]
    return rank_and_cut(labelled, quota, group_cols, order_cols, limit_col, splits).drop("_order_value")

"""Stored partial states: quantile sketches per day (C22) and bitmaps of actors per day and group.

Both merge: thresholds and distinct counts of any range of days come from the stored states, the summary isn't
read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortline.operators.series import in_days
from cohortline.operators.thresholds import DEFAULT_QUANTILES
from cohortline.session import checkpoint

# Size of a quantile sketch. A sketch of up to so many values is exact; beyond, its rank error is about
# 2.3 / K of the values (1.3 % at 200, 0.1 % at 4096).
K = 4096
DICTIONARY = "actor_id bigint, number bigint"


def daily_sketches(summary: DataFrame, columns=tuple(DEFAULT_QUANTILES), k: int = K) -> DataFrame:
    """One row per day: a KLL sketch of every column (NULLs are not counted; NULL where a day has no value)."""
    return summary.groupBy("date").agg(*[
        F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias(c) for c in columns])


def sketched_thresholds(sketches: DataFrame, start=None, end=None, quantiles: dict[str, int] | None = None,
                        k: int = K) -> DataFrame:
    """One row: ``<column>_threshold`` over the days of [start, end), as ``estimate_thresholds`` gives it."""
    quantiles = quantiles or DEFAULT_QUANTILES
    merged = sketches.filter(in_days(start, end)).agg(*[
        F.kll_merge_agg_double(F.col(c), F.lit(k)).alias(c) for c in quantiles])
    return merged.select(*[
        # a sketch without values has no quantile
        F.when(F.kll_sketch_get_n_double(F.col(c)) > 0,
               F.round(F.kll_sketch_get_quantile_double(F.col(c), F.lit(q / 100.0)))).alias(f"{c}_threshold")
        for c, q in quantiles.items()])


def number_actors(actors: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(actor_id, number): dense numbers from 1 on, stored. ``known`` numbers stay, new actors follow them.

    Actors of any type are range-sorted; a number is the rows before the actor's partition plus its place there, so
    only one count per partition is added up. Dense numbers keep the bitmaps full whatever the ids are.
    """
    fresh = actors.select("actor_id").filter("actor_id is not null").distinct()
    first = F.lit(0).cast("bigint")
    if known is not None:
        fresh = fresh.join(known, "actor_id", "left_anti")
        first = F.col("_first")
    placed = checkpoint(fresh.repartitionByRange("actor_id").sortWithinPartitions("actor_id").select(
        "actor_id", F.spark_partition_id().alias("_part"),
        (F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias("_place")))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))       # one row per partition
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    numbered = placed.join(offsets, "_part")
    if known is not None:
        numbered = numbered.crossJoin(F.broadcast(known.agg(F.coalesce(F.max("number"), F.lit(0)).alias("_first"))))
    numbered = numbered.select("actor_id", (first + F.col("_before") + F.col("_place") + 1).alias("number"))
    return checkpoint(numbered if known is None else known.select("actor_id", "number").unionByName(numbered))


def daily_bitmaps(active: DataFrame, numbers: DataFrame, keys=("country",)) -> DataFrame:
    """(date, keys, bucket, actors): bitmaps of the actors of every day and group, 32,768 numbers to a bucket.

    Every actor of ``active`` must have a number (others would be missing from all counts, so they raise).
    """
    known = active.join(numbers, "actor_id", "left").filter("actor_id is not null")
    number = F.coalesce("number", F.raise_error(F.concat(F.lit("no number for actor "), F.col("actor_id").cast("string"))).cast("bigint"))
    placed = known.select("date", *keys, number.alias("number"))
    return placed.groupBy("date", *keys, F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("actors"))


def distinct_actors(bitmaps: DataFrame, keys=("country",), start=None, end=None) -> DataFrame:
    """(keys, count_user): ``COUNT(DISTINCT actor)`` per group over the days of [start, end).

    Bitmaps are united where they lie before they are exchanged: what moves is one bitmap of 4 KB per task, group and bucket.
    """
    united = bitmaps.filter(in_days(start, end)).groupBy(*keys, "bucket").agg(F.bitmap_or_agg("actors").alias("actors"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("actors")).alias("count_user"))

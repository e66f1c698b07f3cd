"""The daily summary as a stored table: bucketed by actor (``save_series``), or by day and refreshed
with new or late facts only (``SummaryStore``)."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortline.operators import series
from cohortline.operators.rollup import summary_parts
from cohortline.params import Scope, SummarySpec, as_date
from cohortline.session import checkpoint
from cohortline.sources.catalog import Sources
from cohortline.sources.tables import save_bucketed

DAILY, PROFILE = "daily_measures", "profile"


def save_series(src: Sources, spec: SummarySpec, database: str, buckets: int) -> None:
    """The merged daily measures (exact, before running totals) and the profile, both bucketed by actor.

    One exchange on the actor when they are stored; ``stored_series``, LAG and the profile join need none.
    """
    daily = series.merge_daily(summary_parts(src, spec))
    save_bucketed(daily, f"{database}.{DAILY}", buckets, sort_by=("actor_id", "date"))
    save_bucketed(src.profile, f"{database}.{PROFILE}", buckets)


def stored_series(spark: SparkSession, src: Sources, spec: SummarySpec, database: str) -> DataFrame:
    """The daily summary over the stored measures; ``src`` and ``spec`` only name the measures, no fact is read."""
    parts = summary_parts(src, spec)
    totals = series.running_totals(spark.table(f"{database}.{DAILY}"), parts)
    return series.finalize(totals, parts, fill=spec.fill, cross_source=spec.cross_source)


class SummaryStore:
    """A summary with a fixed start, stored by day, that is carried on instead of being rebuilt.

    ``days`` holds the finished rows partitioned by date; ``state`` holds, for each day a refresh ended
    on, every actor's running sums up to that day, exact, and the number of rows of each source. ``refresh`` starts from the newest state
    before the first touched day: the state's sums enter the window as one earlier row per actor, the facts from
    that day on are rolled up, and only days from there on are written (partitions are replaced as a whole).
    Late or corrected facts are a refresh from their first day. Days and states that a refresh has
    made void are removed after the new ones are in place, so a refresh that fails can be run again.
    """

    def __init__(self, spark: SparkSession, path: str, spec: SummarySpec):
        if spec.scope.end is not None or spec.first_fact_scope is not None:
            raise ValueError("a store grows with its refreshes: give the scope a start and no end")
        self.spark, self.spec = spark, spec
        self.days, self.state = f"{path.rstrip('/')}/days", f"{path.rstrip('/')}/state"

    def refresh(self, src: Sources, first_day, end) -> dt.date | None:
        """Facts of days before ``first_day`` are unchanged; ``end`` is the day after the last one to store.

        Returns the first day that was computed anew (None: all of them).
        """
        first, end = as_date(first_day), as_date(end)
        held = self.stored_states()
        if held and end <= max(held):
            raise ValueError(f"the store already reaches {max(held)}; refresh up to a later day")
        before = max((d for d in held if d < first), default=None)
        start = self.spec.scope.start if before is None else before + dt.timedelta(days=1)
        parts = summary_parts(src, replace(self.spec, scope=Scope(start, end)))
        daily = checkpoint(series.merge_daily(parts))
        both = daily if before is None else daily.unionByName(self.carried(daily, before))
        rows = series.running_totals(both, parts)
        if before is not None:
            rows = rows.filter(F.col("date") > F.lit(before))
        rows = series.finalize(rows, parts, fill=self.spec.fill, cross_source=self.spec.cross_source)
        self.write(rows.repartitionByRange("date", "actor_id").sortWithinPartitions("date", "actor_id"), self.days, "date")
        sums = [F.sum(c).cast(t).alias(c) for c, t in daily.dtypes if c not in ("actor_id", "date")]
        last = end - dt.timedelta(days=1)
        self.write(both.groupBy("actor_id").agg(*sums).withColumn("as_of", F.lit(last)), self.state, "as_of")
        touched = [r["date"] for r in daily.select("date").distinct().collect()]   # one row per day
        self.remove(self.days, "date", lambda d: (start is None or d >= start) and d not in set(touched))
        self.remove(self.state, "as_of", lambda d: (start is None or d >= start) and d != last)
        return start

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.days).withColumn("date", F.col("date").cast("date"))

    def carried(self, daily: DataFrame, as_of: dt.date) -> DataFrame:
        """The running sums of that day, as one row per actor in the shape of ``daily``."""
        state = self.spark.read.parquet(self.state).filter(F.col("as_of") == F.lit(as_of))
        return state.select(*[(F.lit(as_of) if c == "date" else F.col(c).cast(t)).alias(c) for c, t in daily.dtypes])

    def stored_states(self) -> list[dt.date]:
        return sorted(d for d in self.partitions(self.state))

    def write(self, df: DataFrame, path: str, column: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)

    def folder(self, path: str):
        jvm = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm, jvm.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def partitions(self, path: str) -> dict[dt.date, str]:
        """The stored days under ``path``: one folder each."""
        root, fs = self.folder(path)
        if not fs.exists(root):
            return {}
        names = [s.getPath() for s in fs.listStatus(root) if "=" in s.getPath().getName()]
        return {dt.date.fromisoformat(p.getName().split("=", 1)[1]): p.toString() for p in names}

    def remove(self, path: str, column: str, void) -> None:
        for day, folder in self.partitions(path).items():
            if void(day):
                where, fs = self.folder(folder)
                fs.delete(where, True)


__all__ = ["SummaryStore", "save_series", "stored_series"]

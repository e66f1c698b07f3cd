"""Sinks: a temporary view (the reference's CREATE VIEW) and a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def register_view(df: DataFrame, name: str, order_by=()) -> DataFrame:
    """Publish ``df`` as a temporary view, sorted if ``order_by`` names columns, and return its scan.

    Spark drops the sort where a reader regroups the rows, and keeps it where they are returned.
    """
    (df.orderBy(*order_by) if order_by else df).createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def save_table(df: DataFrame, path: str, partition_by=("date",), sort_by=("actor_id",)) -> DataFrame:
    """Write ``df`` as Parquet partitioned by ``partition_by``, rows clustered by ``sort_by``.

    Rows are range-partitioned on (partition columns, sort columns) first, so each
    task writes a contiguous key range: the file count stays near the task count
    instead of tasks x days, and a day holding a large share of rows is split
    across tasks by actor. Partitioning by day lets later reads prune to the days
    they need; sorting keeps each actor's rows together for min/max skipping.
    ``path`` must not exist: readers of an earlier table are never cut off.
    Returns a scan of the written table.
    """
    keys = [*partition_by, *sort_by]
    df.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("error") \
        .partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)

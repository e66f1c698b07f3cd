"""Catalogue tables of the library: databases in the shared folder, relations and series bucketed by actor.

A table that is bucketed by actor is read back already partitioned by actor: windows per actor, groupings by
actor and joins of two such tables of the same number of buckets need no exchange. One task writes one
bucket, sorted, so a bucket is one file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from cohortline.session import ensure_checkpoint_dir
from cohortline.sources.catalog import Sources, relations

ACTOR_RELATIONS = ("profile", "statuses", "clients")


def new_database(spark: SparkSession, name: str = "") -> str:
    """A database of its own for this call, kept beside the checkpoints; ``drop_database`` removes it."""
    name = f"cohortline_{name}_{uuid.uuid4().hex}" if name else f"cohortline_{uuid.uuid4().hex}"
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/databases/{name}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{folder}'")
    return name


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def save_bucketed(df: DataFrame, table: str, buckets: int, key: str = "actor_id", sort_by=("actor_id",)) -> DataFrame:
    """``df`` as the catalogue table ``table``, in ``buckets`` files by ``key``; the table must not exist."""
    df.repartition(buckets, key).sortWithinPartitions(*sort_by).write.mode("error") \
        .bucketBy(buckets, key).sortBy(*sort_by).format("parquet").saveAsTable(table)
    return df.sparkSession.table(table)


def save_sources(src: Sources, database: str, buckets: int) -> None:
    """All relations as tables of ``database``, those keyed by actor in ``buckets`` buckets."""
    for name, df in relations(src).items():
        if name in ACTOR_RELATIONS:
            save_bucketed(df, f"{database}.{name}", buckets)
        else:
            df.write.mode("error").format("parquet").saveAsTable(f"{database}.{name}")

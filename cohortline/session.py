"""Spark session helpers: local builder for tests/bench and checkpoint handling.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it, which must name a folder that driver and executors share
(a ``file:`` path only if it is mounted on all of them). A local folder is chosen only when the master
is ``local[...]`` and no checkpoint folder was configured (tests, bench).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "cohortline", extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's reliable checkpoint folder, setting one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a folder shared by the cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortline-ckpt-"))
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` once as Parquet under the shared checkpoint folder, read it back.

    Equivalent to a reliable checkpoint (survives executor loss; never a local
    checkpoint), but the plan runs once: an eager ``Dataset.checkpoint`` of an
    unpersisted plan computes it twice (the eager count, then the checkpoint
    write).
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{uuid.uuid4().hex}"
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_checkpoints(spark: SparkSession) -> None:
    """Delete the tables that ``checkpoint`` wrote in this session's checkpoint folder.

    For the end of a job: frames that were read from those tables are unusable afterwards.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

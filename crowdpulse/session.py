"""Session settings and lineage cuts."""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows of a few numbers each, so this many stay below 32 MB.
BROADCAST_ROWS = 500_000
HANDED_OUT_ROWS = 50_000

# What a session should carry. Partition counts are left to the cluster: adaptive
# execution merges small shuffle partitions and splits oversized ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app_name: str = "crowdpulse", master: str | None = None, **extra) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints: the one the session names.

    A session without the setting uses a folder beside its tables: the warehouse is shared by
    definition.
    """
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and go on from the written rows.

    Survives lost executors, unlike a cached or locally checkpointed plan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, by=()) -> DataFrame:
    """``df`` as a table beside the checkpoints, for what several steps of a batch job read.

    Unlike a checkpoint it is worked out once only, keeps its columns apart and tells the planner its
    size. It stays as long as the application's folder; streams use ``cut``. The last columns may be named
    in ``by``: a filter on them reads their folders only.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.partitionBy(*by).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def folder_made(spark: SparkSession, path: str) -> None:
    """The folder is there, with files or without."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(target)


def dropped(spark: SparkSession, path: str) -> None:
    """A folder that this application has written goes."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


@contextlib.contextmanager
def setting(spark: SparkSession, key: str, value):
    """The session has this setting for a while."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(value))
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def handed_out(side: DataFrame) -> DataFrame:
    """A side of a join that is expected to be short, such as the rows of the served people.

    Up to ``HANDED_OUT_ROWS`` rows are fetched and sent to every task, so that the other side need
    not be exchanged on a key that may be skewed (a filter does not lower Spark's estimate of a size
    far enough for that). With more rows it stays a table like any other.
    """
    rows = side.limit(HANDED_OUT_ROWS + 1).toArrow()
    if rows.num_rows > HANDED_OUT_ROWS:
        return side
    return F.broadcast(side.sparkSession.createDataFrame(rows, side.schema))

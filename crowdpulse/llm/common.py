"""Helpers shared by the corpus operators."""

from __future__ import annotations

import sys
import types
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.session import checkpoint_dir

#: The white space of the word and line contracts: x20 and x09 to x0D.
SPACE = "\t\n\x0b\x0c\r "
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(column: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder that the session names for checkpoints."""
    return f"{checkpoint_dir(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as a compressed table in the shared folder and read back."""
    path = shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def once_per_worker(key: str, make):
    """``make()``, kept for the life of a Python worker, whose tasks each get functions of their own."""
    kept = sys.modules.setdefault("_corpus_worker", types.ModuleType("_corpus_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]

"""Line dedup across documents: levelled sorted runs of line hashes.

Documents come in batches by rising doc_id. A batch's line keys are anti-joined with every run
written so far; what is new becomes a run of its own, hash-bucketed and sorted, so that the next
anti-join merges it without a shuffle. ``fanout`` runs of one level are compacted into one run
of the next level. All of it is DataFrame code on the JVM.
"""

from __future__ import annotations

import string
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.llm.common import SPACE, shared_path, shuffle_partitions, written

#: Stands for a null doc_id: such a row holds a line only if no numbered document does.
LAST = 2**63 - 1


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(SPACE)), string.ascii_uppercase, string.ascii_lowercase)


class LineRuns:
    """The keys seen so far, as sorted runs on levels.

    ``add(batch)`` takes rows ``h1, h2`` (a 128-bit line hash) and ``doc``, and returns the table
    of keys that were not known, each with its smallest ``doc``. Runs are bucketed tables of the
    session's warehouse; ``drop()`` removes them.
    """

    def __init__(self, spark: SparkSession, fanout: int = 3, buckets: int | None = None):
        self.spark, self.fanout = spark, fanout
        self.buckets = buckets or max(1, shuffle_partitions(spark))
        self.prefix = f"line_runs_{uuid.uuid4().hex}"
        self.levels: list[list[str]] = []
        self.made = 0

    def _write(self, df: DataFrame, level: int) -> str:
        name = f"{self.prefix}_{self.made}"
        self.made += 1
        (
            df.repartition(self.buckets, "h1", "h2").write.format("parquet").option("compression", "zstd")
            .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(name)
        )
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        return name

    def _compact(self) -> None:
        level = 0
        while level < len(self.levels):
            names = self.levels[level]
            if len(names) >= self.fanout:
                merged = self.spark.table(names[0])
                for name in names[1:]:
                    merged = merged.unionAll(self.spark.table(name))
                self.levels[level] = []
                self._write(merged, level + 1)
                for name in names:
                    self.spark.sql(f"DROP TABLE {name}")
            level += 1

    def add(self, batch: DataFrame) -> DataFrame:
        fresh = batch.groupBy("h1", "h2").agg(F.min("doc").alias("first"))
        for names in reversed(self.levels):
            for name in names:
                fresh = fresh.join(self.spark.table(name).select("h1", "h2"), ["h1", "h2"], "left_anti")
        path = shared_path(self.spark, "line-first")
        fresh.write.option("compression", "zstd").parquet(path)
        first = self.spark.read.schema("h1 long, h2 long, first long").parquet(path)
        self._write(first.select("h1", "h2"), 0)
        self._compact()
        return first

    def drop(self) -> None:
        for names in self.levels:
            for name in names:
                self.spark.sql(f"DROP TABLE {name}")
        self.levels = []


def repeated_lines(docs: DataFrame, min_length: int = 10, n_batches: int = 6, fanout: int = 3) -> DataFrame:
    """``doc, rid, dropped``: the positions of the lines each document loses, where there are any.

    A key of at least ``min_length`` code points stays only in the smallest doc_id that holds it.
    ``rid`` tells apart rows of one doc_id with different texts; rows repeated whole agree in all.
    """
    spark = docs.sparkSession
    rows = _rows(docs)
    bounds = (
        docs.agg(F.percentile_approx("doc_id", [i / n_batches for i in range(1, n_batches)], 10_000)).first()[0]
        or []
    )
    batch = F.lit(0)
    for bound in sorted(set(bounds)):
        batch = batch + (F.col("doc") > F.lit(bound)).cast("int")
    lines = (
        rows.select("doc", "rid", F.posexplode("lines").alias("pos", "line"))
        .select("doc", "rid", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.length("key") >= min_length)
        .select(
            "doc", "rid", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("second"), "key").alias("h2"),
            batch.alias("batch"),
        )
    )
    path = shared_path(spark, "lines")
    lines.write.option("compression", "zstd").partitionBy("batch").parquet(path)
    hashed = spark.read.schema("doc long, rid long, pos int, h1 long, h2 long, batch int").parquet(path)
    out = shared_path(spark, "dropped")
    runs = LineRuns(spark, fanout)
    for i in range(len(set(bounds)) + 1):
        part = hashed.filter(F.col("batch") == i)
        first = runs.add(part)
        # Of a line's holders only its first document finds a partner, so a common line is dealt
        # out by document and not to one task.
        lost = part.join(
            first.select("h1", "h2", F.col("first").alias("doc")), ["h1", "h2", "doc"], "left_anti"
        ).select("doc", "rid", "pos")
        lost.write.mode("append").option("compression", "zstd").parquet(out)
    runs.drop()
    return (
        spark.read.schema("doc long, rid long, pos int").parquet(out)
        .groupBy("doc", "rid").agg(F.collect_set("pos").alias("dropped"))
    )


def _rows(docs: DataFrame, *more: Column) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST))
    return docs.select(
        *more, doc.alias("doc"), F.xxhash64("doc_id", text).alias("rid"), F.split(text, "\n", -1).alias("lines")
    )


def dedup_lines(docs: DataFrame, min_length: int = 10, n_batches: int = 6, fanout: int = 3) -> DataFrame:
    """All columns of ``docs`` (at least doc_id and text) with the lines that stay, and their counts.

    ``text`` becomes the kept lines joined by ``\\n``; ``_n_lines`` and ``_n_dropped`` are added and
    replace columns of these names. A null or empty text is one empty line. Rows with a null doc_id
    come last. Rows that repeat a doc_id count as one document; each is returned. An empty table
    gives an empty table. Other columns may have any names.
    """
    dropped = repeated_lines(docs, min_length, n_batches, fanout)
    names = [c for c in docs.columns if c not in ("_n_lines", "_n_dropped")]
    others = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("row")
    # The lines are made below the join: above it they are a plain column with constant-time access.
    joined = _rows(docs, others).join(
        dropped.select(F.col("doc").alias("_doc"), F.col("rid").alias("_rid"), "dropped"),
        (F.col("doc") == F.col("_doc")) & (F.col("rid") == F.col("_rid")), "left",
    )
    n, all_stay = F.size("lines"), F.col("dropped").isNull()
    kept = F.array_except(F.sequence(F.lit(0), n - 1), "dropped")
    text = F.when(all_stay, F.array_join("lines", "\n")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")
    )
    return joined.select(
        *[text.alias("text") if c == "text" else F.col("row").getField(c).alias(c) for c in names],
        n.cast("long").alias("_n_lines"),
        F.when(all_stay, 0).otherwise(F.size("dropped")).cast("long").alias("_n_dropped"),
    )

"""Spam detection as a continuous query.

Thresholds depend on the order of events, so events wait until the watermark has passed them
and are then judged in order by the batch operators. Between batches only a few numbers (the
histograms) and the last minute of counts per person are carried; who has been flagged already is
keyed state of the stream that hands each flag on once.
The flags are those of the batch job, with the disorder bound as extra latency.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions.text import unique_word_ratio
from crowdpulse.operators import spam
from crowdpulse.operators.threshold import Histogram, bucket_totals, running_threshold, slice_in_order
from crowdpulse.schema import BURST_MAX, BURST_WINDOW, EVENT_ORDER, MAX_DELAY_SECONDS
from crowdpulse.session import cut
from crowdpulse.streaming.event_time import first_of_each
from crowdpulse.streaming.tables import BatchTables

WAITING = (
    "kind string, id bigint, id_kind string, person_id bigint, ts_s bigint, parent_kind string, "
    "parent_id bigint, ratio double"
)


class SpamStream:
    """``parsed.writeStream.foreachBatch(SpamStream(spark, root))``."""

    def __init__(self, spark: SparkSession, root: str, max_delay: int = MAX_DELAY_SECONDS,
                 burst_window: int = BURST_WINDOW, burst: Histogram = spam.BURST, burst_max: int = BURST_MAX,
                 vocabulary: Histogram = spam.VOCABULARY, order=EVENT_ORDER):
        self.max_delay, self.window, self.burst_max = max_delay, burst_window, burst_max
        self.burst, self.vocabulary, self.order = burst, vocabulary, list(order)
        self.tables = BatchTables(spark, root, {
            "waiting": WAITING,
            "recent": "person_id bigint, ts_s bigint, c bigint",
            "state": "max_ts bigint, closed bigint, burst array<bigint>, vocabulary array<bigint>",
            "flags": "detector string, person_id bigint, ts_s bigint, value double, threshold double",
        })

    def __call__(self, parsed: DataFrame, batch_id: int) -> None:
        spark, tables = parsed.sparkSession, self.tables
        if tables.done(spark, "flags", batch_id):
            return
        columns = tables.schemas["waiting"].names
        ratio = F.when(F.col("kind") != "like", unique_word_ratio("content"))
        before = tables.previous(spark, "state", batch_id).first()
        arrived = parsed.filter("kind <> 'malformed'").withColumn("ratio", ratio).select(*columns)
        arrived = cut(arrived.unionByName(tables.previous(spark, "waiting", batch_id)))
        top = arrived.agg(F.max("ts_s")).first()[0]
        max_ts = max(x for x in (before and before["max_ts"], top, 0) if x is not None)
        reached = max_ts - self.max_delay

        events = arrived.filter("kind <> 'watermark'")
        if before:  # later than the bound: its place in the order is gone
            events = events.filter(F.col("ts_s") > before["closed"])
        closed = events.filter(F.col("ts_s") <= reached)

        burst_flags, burst_state, recent = self._bursts(closed, tables.previous(spark, "recent", batch_id),
                                                        before and before["burst"], reached)
        word_flags, word_state = self._vocabulary(closed, before and before["vocabulary"])
        # A person may be flagged in other batches too: ``once`` takes the first, without a look at all flags.
        flags = burst_flags.unionByName(word_flags)

        tables.write("waiting", events.filter(F.col("ts_s") > reached), batch_id)
        tables.write("recent", recent, batch_id)
        state = [(max_ts, reached, burst_state, word_state)]
        tables.write("state", spark.createDataFrame(state, tables.schemas["state"]), batch_id)
        tables.write("flags", flags, batch_id)
        tables.compact(spark, ("flags",), batch_id)

    def _bursts(self, closed: DataFrame, history: DataFrame, start, reached: int):
        sliced = slice_in_order(closed.select(*self.order), self.order)
        counted = cut(spam.burst_counts(sliced, self.order, self.window, history=history).withColumn(
            "entry", spam.burst_entry(F.col("n"), self.burst_max)
        ))
        deltas = spam.burst_deltas(self.burst_max)
        scored = running_threshold(counted, [*self.order, "n"], deltas, self.burst, start)
        flags = spam.first_flags(scored, self.order, "entry")
        totals = _plus(start, bucket_totals(counted, deltas, self.burst))
        recent = (
            history.unionByName(sliced.groupBy("person_id", "ts_s").agg(F.count("*").alias("c")))
            .filter(F.col("ts_s") > reached - self.window - 1)
            .groupBy("person_id", "ts_s").agg(F.sum("c").alias("c"))
        )
        return _named("burst", flags, "entry"), totals, recent

    def _vocabulary(self, closed: DataFrame, start):
        full = [*self.order, "ratio"]
        sliced = slice_in_order(spam.text_ratios(closed, self.order, "ratio"), full)
        deltas = [(F.col("ratio"), F.lit(1))]
        scored = running_threshold(sliced, full, deltas, self.vocabulary, start)
        flags = spam.first_flags(scored, self.order, "ratio")
        return _named("low_vocabulary", flags, "ratio"), _plus(start, bucket_totals(sliced, deltas, self.vocabulary))

    def flags(self, spark: SparkSession) -> DataFrame:
        """Each person's first flag by each detector, so far."""
        first = F.min(F.struct("ts_s", "value", "threshold")).alias("f")
        rows = self.tables.everything(spark, "flags").groupBy("detector", "person_id").agg(first)
        return rows.select("detector", "person_id", "f.ts_s", "f.value", "f.threshold")

    def once(self, spark: SparkSession) -> DataFrame:
        """The same as a stream, each flag as soon as it is known: the flagged people are keyed state, so a trigger
        reads only its own batches' flags. The session's state provider must be RocksDB."""
        return first_of_each(self.tables.stream(spark, "flags"), ["detector", "person_id"], ["ts_s"])

    def start(self, parsed: DataFrame, checkpoint: str, **trigger):
        return (
            parsed.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start()
        )


def _named(detector: str, flags: DataFrame, value: str) -> DataFrame:
    return flags.select(
        F.lit(detector).alias("detector"), "person_id", "ts_s", F.col(value).cast("double").alias("value"), "threshold"
    )


def _plus(a, b) -> list[int]:
    return [x + y for x, y in zip(a or [0] * len(b), b)]

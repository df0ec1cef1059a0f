"""The continuous queries over the sample tables.

The sample events lie as text records in a folder that a file stream reads. Punctuation at the end
says that time has gone on, so that the last ticks come out; the records and each mark make a run
of their own, stopped and started again from its checkpoint. Arrival in any other order and in
many portions is replayed by the tests.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions.timegrid import last_slot
from crowdpulse.operators.threshold import Histogram
from crowdpulse.operators.timegrid import Running, time_bounds
from crowdpulse.schema import (
    ACTIVE_POSTS_EVERY,
    ACTIVE_POSTS_HORIZON,
    MAX_DELAY_SECONDS,
    RECOMMEND_EVERY,
)
from crowdpulse.session import checkpoint_dir
from crowdpulse.sources import sample_tables as sample
from crowdpulse.sources.wire import parse_events
from crowdpulse.streaming import ActivePostsStream, RecommendationStream, SpamStream, ThreadStream
from crowdpulse.streaming import event_time as engine

# Likes are led to posts of the week before.
LIKE_HORIZON = 604_800
SNAPSHOT_EVERY, SLIDE_EVERY, SLIDE_WINDOW = 21_600, 3_600, 14_400
SNAPSHOT_AGGS = [
    Running("n", "count"), Running("cents", "sum", "cents"),
    Running("lowest_user", "min", "user_id"), Running("last_ts", "max", "ts_s"),
]
SECONDS = "kind string, ts_s bigint, event_type string, user_id bigint, cents bigint"


class Feed:
    """The records in a folder of their own under the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, sf_dir: str, texts: bool = False, withheld: str | None = None):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/feed-{uuid.uuid4().hex}"
        self.origin, self.until = time_bounds(sample.sample_events(spark, sf_dir))
        # Quoted texts may hold line breaks, so records are rows and not lines.
        wire = sample.sample_wire(spark, sf_dir, texts=texts, keep=("event_id", "kind"))
        self.late = wire.filter(withheld) if withheld else None
        (wire.filter(f"not ({withheld})") if withheld else wire).select("value").write.parquet(self.path("records"))

    def send_withheld(self) -> None:
        """The records that were held back arrive."""
        self.late.select("value").write.mode("append").parquet(self.path("records"))

    def runs(self, *marks: int) -> Iterator[None]:
        """One run over the records and one more after each mark of time."""
        yield
        for mark in marks:
            row = self.spark.range(1).select(F.lit(f"WATERMARK|{mark}").alias("value"))
            row.write.mode("append").parquet(self.path("records"))
            yield

    def stream(self) -> DataFrame:
        return parse_events(self.spark.readStream.schema("value string").parquet(self.path("records")))

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def _threads(feed: Feed, **kw) -> ThreadStream:
    return ThreadStream(feed.spark, feed.path("threads"), **kw)


def _place(feed: Feed, threads: ThreadStream) -> None:
    threads.start(feed.stream(), feed.path("cp-threads")).awaitTermination()


def stream_post_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = Feed(spark, sf_dir)
    threads = _threads(feed)
    for _ in feed.runs():
        _place(feed, threads)
    return threads.resolved(spark).select("kind", "post_id", "person_id", "ts_s", "author_id")


def stream_late_expiry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some comments come after the disorder bound: the answers that waited for them have been given up."""
    feed = Feed(spark, sf_dir, withheld="kind = 'comment' AND event_id % 7 = 0")
    threads = _threads(feed)
    for _ in feed.runs(feed.until + MAX_DELAY_SECONDS + 1):
        _place(feed, threads)
    feed.send_withheld()
    _place(feed, threads)
    return threads.resolved(spark).select("kind", "post_id", "person_id", "ts_s", "author_id")


def _stateful(spark: SparkSession) -> SparkSession:
    """A session of its own for queries with keyed state: the state lies in RocksDB, in as many parts as there are
    cores for (a stateful query keeps its number of parts for good)."""
    session = spark.newSession()
    for key, value in {
        "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.sql.shuffle.partitions": str(max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))),
        "spark.sql.session.timeZone": "UTC",
    }.items():
        session.conf.set(key, value)
    return session


def _appended(stream: DataFrame, root: str) -> DataFrame:
    """Run ``stream`` over what there is, appending to a table, and return the table."""
    (
        stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/cp")
        .outputMode("append").trigger(availableNow=True).start().awaitTermination()
    )
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{root}/out")


def stream_likes(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = Feed(spark, sf_dir)
    parsed = parse_events(_stateful(spark).readStream.schema("value string").parquet(feed.path("records")))
    out = engine.stream_likes(parsed, LIKE_HORIZON)
    _appended(out, feed.path("likes"))
    return spark.read.schema(out.schema).parquet(feed.path("likes/out"))


def _seconds(spark: SparkSession, sf_dir: str, build, every: int) -> DataFrame:
    """``build(events, origin)`` over the sample's seconds as a stream, stopped and started again with a last mark of time."""
    events = sample.sample_seconds(spark, sf_dir)
    origin, until = time_bounds(events, None)
    root = f"{checkpoint_dir(spark)}/feed-{uuid.uuid4().hex}"
    events.withColumn("kind", F.lit("event")).select("kind", "ts_s", "event_type", "user_id", "cents").write.parquet(f"{root}/in")
    last = origin + every * last_slot(until, origin, every)
    session = _stateful(spark)
    out = build(engine.event_time(session.readStream.schema(SECONDS).parquet(f"{root}/in")), origin)
    _appended(out, root)
    mark = [("watermark", last + MAX_DELAY_SECONDS + 1, None, None, None)]
    spark.createDataFrame(mark, SECONDS).write.mode("append").parquet(f"{root}/in")
    _appended(out, root)
    return spark.read.schema(out.schema).parquet(f"{root}/out").filter(F.col("notify_ts") <= last)


def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(
        spark, sf_dir, lambda e, origin: engine.stream_snapshot(e, ["event_type"], SNAPSHOT_AGGS, SNAPSHOT_EVERY, origin), SNAPSHOT_EVERY
    )


def stream_sliding_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _seconds(
        spark, sf_dir,
        lambda e, origin: engine.stream_sliding_sum(e, ["user_id"], {"cents": "cents"}, SLIDE_EVERY, SLIDE_WINDOW, origin), SLIDE_EVERY,
    )


def stream_active(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reports until every post has gone quiet."""
    feed = Feed(spark, sf_dir)
    threads = _threads(feed, origin=feed.origin)
    service = ActivePostsStream(spark, feed.path("active"), threads)
    for _ in feed.runs(feed.until + ACTIVE_POSTS_HORIZON + ACTIVE_POSTS_EVERY + MAX_DELAY_SECONDS):
        _place(feed, threads)
        service.start(spark, feed.path("cp-active")).awaitTermination()
    return service.reports(spark)


def stream_recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tick up to the one after the last event."""
    feed = Feed(spark, sf_dir)
    threads = _threads(feed)
    service = RecommendationStream(
        spark, feed.path("recommendations"), threads, sample.sample_static(spark, sf_dir), feed.origin
    )
    last = feed.origin + RECOMMEND_EVERY * last_slot(feed.until, feed.origin, RECOMMEND_EVERY)
    for _ in feed.runs(last + MAX_DELAY_SECONDS):
        _place(feed, threads)
        (
            threads.complete(spark).writeStream.foreachBatch(service)
            .option("checkpointLocation", feed.path("cp-recommendations"))
            .trigger(availableNow=True).start().awaitTermination()
        )
    return service.result(spark)


def stream_spam(spark: SparkSession, sf_dir: str, burst_window: int, burst: Histogram) -> DataFrame:
    feed = Feed(spark, sf_dir, texts=True)
    spammers = SpamStream(spark, feed.path("spam"), burst_window=burst_window, burst=burst)
    for _ in feed.runs(feed.until + MAX_DELAY_SECONDS):
        spammers.start(feed.stream(), feed.path("cp-spam")).awaitTermination()
        once = spammers.once(_stateful(spark))
        _appended(once, feed.path("once"))
    return spark.read.schema(once.schema).parquet(feed.path("once/out"))

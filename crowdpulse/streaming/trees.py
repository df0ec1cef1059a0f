"""Threads from an unordered stream.

An answer may arrive before what it answers, so a thread cannot be found by keyed state
alone. Each micro-batch joins its events, and those still waiting, with the threads known so
far, runs the same pointer doubling as the batch job over the few new comments, and keeps
what it cannot place for as long as the disorder bound allows.

Tables under ``root`` (one folder per batch): ``resolved`` (the result), ``engagements`` (the
same, summed per post, person and slot, for the statistics stream), ``nodes`` and ``posts``
(what answers can lead to), ``waiting`` and ``progress``. ``progress`` is written last: a batch
that is in it is complete, and readers take no other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.operators import trees
from crowdpulse.operators.active_posts import engagement_slots
from crowdpulse.schema import ACTIVE_POSTS_EVERY, MAX_DELAY_SECONDS
from crowdpulse.session import cut
from crowdpulse.streaming.tables import BatchTables

WAITING = (
    "kind string, id_kind string, id bigint, person_id bigint, ts_s bigint, parent_kind string, "
    "parent_id bigint, forum_id bigint, tags array<bigint>"
)
NODES = "id bigint, comment_ts bigint, comment_author bigint, root_post_id bigint"
PROGRESS = "max_ts bigint, batch bigint"
POSTS = "post_id bigint, post_ts bigint, author_id bigint"
RESOLVED = (
    "kind string, post_id bigint, person_id bigint, ts_s bigint, author_id bigint, "
    "parent_author bigint, forum_id bigint, tags array<bigint>"
)
ENGAGEMENTS = "post_id bigint, person_id bigint, k bigint, num_comments bigint, num_replies bigint, last_ts bigint"


class ThreadStream:
    """``parsed.writeStream.foreachBatch(ThreadStream(spark, root))``.

    With a fixed ``origin`` it also keeps the ``engagements`` table for ticks ``every`` seconds.
    """

    def __init__(self, spark: SparkSession, root: str, max_delay: int = MAX_DELAY_SECONDS,
                 origin: int | None = None, every: int = ACTIVE_POSTS_EVERY):
        self.max_delay, self.origin, self.every = max_delay, origin, every
        self.tables = BatchTables(spark, root, {
            "waiting": WAITING, "nodes": NODES, "posts": POSTS,
            "progress": PROGRESS, "resolved": RESOLVED, "engagements": ENGAGEMENTS,
        })

    def __call__(self, parsed: DataFrame, batch_id: int) -> None:
        spark, tables = parsed.sparkSession, self.tables
        if tables.done(spark, "progress", batch_id):
            return
        columns = tables.schemas["waiting"].names
        arrived = cut(
            parsed.filter("kind <> 'malformed'").select(*columns)
            .unionByName(tables.previous(spark, "waiting", batch_id))
        )
        before = tables.previous(spark, "progress", batch_id).agg(F.max("max_ts")).first()[0]
        top = arrived.agg(F.max("ts_s")).first()[0]
        max_ts = max((t for t in (before, top) if t is not None), default=None)
        expired = (max_ts or 0) - self.max_delay
        events = arrived.filter("kind <> 'watermark'")
        # Known comments, looked up once for the answered ids and for repeated ids.
        comments = events.filter("kind in ('comment', 'reply')")
        ids = comments.select("id").unionByName(
            events.filter("kind = 'reply'").select(F.col("parent_id").alias("id"))
        ).distinct()
        known = cut(lookup(tables.earlier(spark, "nodes", batch_id), ids, "id"))
        fresh = trees.comment_nodes(comments).join(known, "id", "left_anti")
        roots = cut(trees.follow_to_root(fresh, known))

        found = trees.located(events, roots, ("id_kind", "id", "parent_kind", "parent_id"), "left")
        targets = found.select("post_id").unionByName(
            events.filter("kind = 'post'").select(F.col("id").alias("post_id"))
        ).filter("post_id is not null").distinct()
        known_posts = cut(lookup(tables.earlier(spark, "posts", batch_id), targets, "post_id"))
        fresh_posts = trees.post_nodes(events).join(known_posts, "post_id", "left_anti")
        placed = cut(found.join(known_posts.unionByName(fresh_posts), "post_id", "left"))

        tables.write("nodes", roots.join(known, "id", "left_anti"), batch_id)
        tables.write("posts", fresh_posts, batch_id)
        tables.write("waiting", placed.filter(F.col("post_ts").isNull() & (F.col("ts_s") > expired)), batch_id)
        resolved = trees.own_trees(events).unionByName(
            trees.countable(placed.filter("post_ts is not null"))
        )
        if self.origin is not None:
            tables.write("engagements", engagement_slots(resolved, self.origin, self.every), batch_id)
        tables.write("resolved", resolved, batch_id)
        tables.write("progress", spark.createDataFrame([(max_ts, batch_id)], PROGRESS), batch_id)
        tables.compact(spark, ("nodes", "posts", "resolved"), batch_id)

    def resolved(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """The placed events of all complete batches, or of those up to the batch ``upto``."""
        upto = self.reached(spark)[1] if upto is None else upto
        return self.tables.earlier(spark, "resolved", upto + 1)

    def reached(self, spark: SparkSession) -> tuple[int | None, int]:
        """``time, batch``: all events up to that time have arrived and are placed or given up in
        the batches up to that one; ``None, -1`` before the first."""
        last = self.tables.last(spark, "progress")
        top = self.tables.one(spark, "progress", last).agg(F.max("max_ts")).first()[0]
        return (None if top is None else top - self.max_delay), last

    def complete(self, spark: SparkSession) -> DataFrame:
        """A stream with a row for each batch that is complete."""
        return self.tables.stream(spark, "progress")

    def start(self, parsed: DataFrame, checkpoint: str, **trigger):
        return (
            parsed.writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start()
        )


def lookup(table: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of a long history table for the keys of a micro-batch.

    The keys are counted first. Few enough, they go to the table, which then need not be
    exchanged. Ids grow with time, so their range lets the scan skip most of the old files.
    """
    n, low, high = wanted.agg(F.count("*"), F.min(key), F.max(key)).first()
    if not n:
        return table.filter(F.lit(False))
    side = F.broadcast(wanted) if n <= trees.BROADCAST_ROWS else wanted
    return table.filter(F.col(key).between(low, high)).join(side, key, "left_semi")

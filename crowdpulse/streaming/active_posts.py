"""Active-post statistics as a continuous query.

It reads the ``engagements`` that the thread stream has summed per post, person and slot. Slots
wait until they are complete and are then added up by the functions of the batch job, on top of
one row per active post. Whom a post has met is kept as rows of post and person, and what a quiet
post had reached as one row, looked up when it wakes up; no post is one task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions.timegrid import slot_time
from crowdpulse.operators import active_posts as batch_job
from crowdpulse.operators.timegrid import running_totals, spread
from crowdpulse.schema import ACTIVE_POSTS_HORIZON
from crowdpulse.session import cut
from crowdpulse.streaming.tables import BatchTables
from crowdpulse.streaming.trees import ENGAGEMENTS, ThreadStream, lookup

STATE = "post_id bigint, num_comments bigint, num_replies bigint, num_people bigint, last_ts bigint"
REPORTS = "notify_ts bigint, post_id bigint, num_comments bigint, num_replies bigint, num_people bigint"


class ActivePostsStream:
    """``threads.complete(spark).writeStream.foreachBatch(ActivePostsStream(...))``: every trigger
    reports the ticks that have become complete since the last one.

    The thread stream needs a fixed ``origin``. What arrives too late for its own tick counts from
    the next one on. What a trigger is about to do is written before anything of it, so that a
    trigger that is run again does the same.
    """

    def __init__(self, spark: SparkSession, root: str, threads: ThreadStream, horizon: int = ACTIVE_POSTS_HORIZON):
        if threads.origin is None:
            raise ValueError("the thread stream needs a fixed origin")
        self.threads, self.horizon = threads, horizon
        self.tables = BatchTables(spark, root, {
            "plan": "slot bigint, upto bigint", "pending": ENGAGEMENTS, "met": "post_id bigint, person_id bigint",
            "active": STATE, "quiet": STATE + ", at bigint", "reports": REPORTS,
        })

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, tables = batch.sparkSession, self.tables
        if tables.done(spark, "reports", batch_id):
            return
        before = tables.previous(spark, "plan", batch_id).first()
        served, read = (before["slot"], before["upto"]) if before else (0, -1)
        slot, upto = self._plan(spark, served, batch_id)
        arrived = self.threads.tables.between(spark, "engagements", read + 1, upto + 1)
        arrived = cut(
            arrived.unionByName(tables.previous(spark, "pending", batch_id))
            .withColumn("k", F.greatest("k", F.lit(served + 1)))
        )
        ready = arrived.filter(F.col("k") <= slot)

        firsts = ready.groupBy("post_id", "person_id").agg(F.min("k").alias("k"))
        posts = cut(ready.select("post_id").distinct())
        known = lookup(tables.earlier(spark, "met", batch_id), posts, "post_id")
        fresh = cut(firsts.join(known, ["post_id", "person_id"], "left_anti"))
        changes = batch_job.slot_changes(ready, fresh)

        active = tables.previous(spark, "active", batch_id)
        woken = posts.join(active, "post_id", "left_anti")
        rested = lookup(tables.earlier(spark, "quiet", batch_id), woken, "post_id")
        rested = rested.groupBy("post_id").agg(F.max_by(F.struct(*active.columns), "at").alias("s")).select("s.*")
        # What was reached before stands like a change in the last slot served.
        base = active.unionByName(rested).withColumn("k", F.lit(served).cast("bigint"))
        running = cut(running_totals(base.unionByName(changes), ["post_id"], batch_job.TOTALS))

        origin, every = self.threads.origin, self.threads.every
        reach = batch_job.with_reach(running, every, self.horizon, origin, slot)
        reports = spread(reach, F.greatest("k", F.lit(served + 1)), F.col("reach"), origin, every)
        state = running.filter("next_k is null").drop("k", "next_k")
        still = F.col("last_ts") + self.horizon >= slot_time(F.lit(slot + 1), origin, every)
        # Nothing has been added to a post that is quiet already: only new ones are written down.
        tables.write("pending", arrived.filter(F.col("k") > slot), batch_id)
        tables.write("met", fresh, batch_id)
        tables.write("active", state.filter(still), batch_id)
        tables.write("quiet", state.filter(~still).withColumn("at", F.lit(batch_id).cast("bigint")), batch_id)
        tables.write("reports", reports, batch_id)
        tables.compact(spark, ("met", "quiet", "reports"), batch_id)

    def _plan(self, spark: SparkSession, served: int, batch_id: int) -> tuple[int, int]:
        """Last slot that this trigger reports and last thread batch that it reads: as an earlier
        attempt wrote them, or as they are now."""
        if not self.tables.done(spark, "plan", batch_id):
            reached, upto = self.threads.reached(spark)
            slot = served if reached is None else max(served, (reached - self.threads.origin) // self.threads.every)
            self.tables.write("plan", spark.createDataFrame([(slot, upto)], self.tables.schemas["plan"]), batch_id)
        return tuple(self.tables.one(spark, "plan", batch_id).first())

    def reports(self, spark: SparkSession) -> DataFrame:
        return self.tables.everything(spark, "reports")

    def start(self, spark: SparkSession, checkpoint: str, **trigger):
        return (
            self.threads.complete(spark).writeStream.foreachBatch(self).option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"availableNow": True})).start()
        )

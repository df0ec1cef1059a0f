"""Recommendations as a continuous query.

A tick can be served once all events up to it have arrived and are placed. It then depends on
the placed events of the last window only, plus the tags the clients used before, which are
carried on from run to run; each run reads that much and nothing else. The time reached and the
batches it stands for are taken from the thread stream together, and what a trigger is about to
serve is written before anything of it: a trigger that is run again serves the same.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.operators import recommend, trees
from crowdpulse.schema import (
    RECOMMEND_CLIENTS,
    RECOMMEND_EVERY,
    RECOMMEND_SIZE,
    RECOMMEND_WINDOW,
    Weights,
)
from crowdpulse.session import cut
from crowdpulse.streaming.tables import BatchTables
from crowdpulse.streaming.trees import ThreadStream

FIRST_USE = "person_id bigint, tag bigint, first_use bigint"
SERVED = "slot bigint, upto bigint"
RESULT = "notify_ts bigint, person_id bigint, rank bigint, candidate_id bigint, score bigint"


class RecommendationStream:
    """``threads.complete(spark).writeStream.foreachBatch(RecommendationStream(...))``: every
    trigger serves the ticks that have become complete since the last one."""

    def __init__(self, spark: SparkSession, root: str, threads: ThreadStream, static: dict[str, DataFrame],
                 origin: int, clients=RECOMMEND_CLIENTS, every: int = RECOMMEND_EVERY,
                 window: int = RECOMMEND_WINDOW, k: int = RECOMMEND_SIZE, weights: Weights = Weights()):
        self.tables = BatchTables(spark, root, {
            "served": SERVED, "first_use": FIRST_USE, "recommendations": RESULT,
        })
        self.threads, self.static, self.origin = threads, static, origin
        self.clients, self.every, self.window, self.k, self.weights = clients, every, window, k, weights
        # The relational side is the same for all triggers: worked out by the first one that serves a tick.
        self.prepared: recommend.Prepared | None = None

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if self.tables.done(spark, "recommendations", batch_id):
            return
        served = self.tables.previous(spark, "served", batch_id).agg(F.max("slot")).first()[0] or 0
        complete, upto = self._plan(spark, served, batch_id)
        resolved = self.threads.resolved(spark, upto)
        first_use = self.tables.previous(spark, "first_use", batch_id)
        if complete > served:
            first_use = cut(self._first_use(resolved, first_use, served, complete))
            result = self.ticks(resolved, served + 1, complete, first_use)
        else:
            result = spark.createDataFrame([], RESULT)
        self.tables.write("first_use", first_use, batch_id)
        self.tables.write("recommendations", result, batch_id)

    def _plan(self, spark: SparkSession, served: int, batch_id: int) -> tuple[int, int]:
        """Last slot that this trigger serves and last thread batch that it reads: as an earlier
        attempt wrote them, or as they are now."""
        if not self.tables.done(spark, "served", batch_id):
            reached, batch = self.threads.reached(spark)
            # A tick is complete when the time reached is at or past it.
            slot = served if reached is None else max(served, (reached - self.origin) // self.every)
            self.tables.write("served", spark.createDataFrame([(slot, batch)], SERVED), batch_id)
        return tuple(self.tables.one(spark, "served", batch_id).first())

    def _first_use(self, resolved: DataFrame, so_far: DataFrame, served: int, complete: int) -> DataFrame:
        """First uses up to the last complete tick: those known, and those since the last one served."""
        posts = trees.recommendation_updates(resolved).filter(F.col("ts_s") <= self._time(complete))
        if served:
            posts = posts.filter(F.col("ts_s") > self._time(served))
        return (
            so_far.unionByName(recommend.tag_first_use(posts, self.clients))
            .groupBy("person_id", "tag").agg(F.min("first_use").alias("first_use"))
        )

    def ticks(self, resolved: DataFrame, first: int, last: int, first_use: DataFrame) -> DataFrame:
        """Recommendations of the ticks ``first .. last``."""
        until, since = self._time(last), self._time(first) - self.window
        updates = trees.recommendation_updates(resolved)
        recent = cut(updates.filter((F.col("ts_s") > since) & (F.col("ts_s") <= until)))
        if self.prepared is None:
            self.prepared = recommend.prepare(self.static, self.clients, self.k, self.weights)
        return recommend.friend_recommendations(
            recent, self.static, self.clients, self.every, self.window, self.origin, until, self.k,
            self.weights, first_slot=first, first_use=first_use, prepared=self.prepared,
        )

    def _time(self, slot: int) -> int:
        return self.origin + slot * self.every

    def result(self, spark: SparkSession) -> DataFrame:
        return self.tables.everything(spark, "recommendations")

"""Hot keys are split, plans hold no all-pairs join, and scans read what they need."""

import contextlib

from pyspark.sql import functions as F

from crowdpulse.operators import graph, recommend, spam, threshold, trees
from crowdpulse.plans.queries import queries
from crowdpulse.session import cut

SMALL = "/root/testdata/sf0.001"


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df, executed=False):
    if executed:
        df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


def hot_network(spark, n=60_000):
    """A third of all events answers one post, another third one comment."""
    i = F.col("id")
    kind = F.when(i < 200, "post").when(i < 400, "comment").when(i % 3 == 0, "like").otherwise("reply")
    rows = spark.range(n).repartition(8).select(
        kind.alias("kind"),
        F.when(kind == "post", "post").when(kind != "like", "comment").alias("id_kind"),
        F.when(kind != "like", i).alias("id"),
        (i % 977).alias("person_id"),
        (F.lit(1_000_000) + i).alias("ts_s"),
        F.when(kind == "reply", "comment").when(kind != "post", "post").alias("parent_kind"),
        F.when(kind == "comment", i - 200).when(kind == "like", 7)
        .when(kind == "reply", F.when(i % 3 == 1, 207).otherwise(200 + i % 200)).alias("parent_id"),
        F.lit(None).cast("bigint").alias("forum_id"), F.lit(None).cast("array<bigint>").alias("tags"),
    )
    return cut(rows)


def test_hot_post_and_hot_comment_are_split(spark):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="20KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="20KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__shuffle__partitions="16",
    ):
        events = hot_network(spark)
        resolved = trees.post_trees(events)
        rows = resolved.groupBy("post_id", "kind").agg(F.count("*").alias("n"))
        result = {(r.post_id, r.kind): r.n for r in rows.collect()}
        final = rows._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final
    assert sum(result.values()) == 60_000
    assert result[(7, "like")] == sum(1 for i in range(400, 60_000) if i % 3 == 0)
    assert result[(7, "reply")] >= sum(1 for i in range(400, 60_000) if i % 3 == 1)


def test_narrow_scans(spark):
    q = queries()
    friends = plan(q["friends"](spark, SMALL))
    assert "o_totalprice" not in friends and "PushedFilters: [In(o_custkey" in friends
    assert "text" not in plan(q["burst_counts"](spark, SMALL)).split("ReadSchema", 1)[-1]
    study = plan(q["shared_study"](spark, SMALL))
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in study


def test_top_k_limits_before_the_exchange(spark):
    df = spark.range(1000).select(
        (F.col("id") % 3).alias("g"), (F.col("id") * 7 % 101).alias("score"), F.col("id").alias("candidate_id")
    )
    best = recommend.top_candidates(df, ["g"], 5)
    assert "WindowGroupLimit" in plan(best)
    assert best.count() == 15


def test_a_hot_second_and_a_hot_person_are_cut_into_slices(spark):
    """Half of the rows are one person's in one second; no slice holds more than its share."""
    n = 40_000
    df = spark.range(n).repartition(8).select(
        F.when(F.col("id") % 2 == 0, 5_000).otherwise(F.col("id")).cast("bigint").alias("ts_s"),
        F.col("id").alias("event_id"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("bigint").alias("person_id"),
    )
    order = ("ts_s", "event_id")
    sliced = threshold.slice_in_order(df, order, 8)
    sizes = [r["count"] for r in sliced.groupBy("slice").count().collect()]
    assert sum(sizes) == n and len(sizes) == 8 and max(sizes) < n / 4
    counts = spam.burst_counts(sliced, order, 60).filter("person_id = 1")
    # Numbered one by one across the slices.
    row = counts.agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(row) == (1, n // 2, n // 2)


def test_inputs_are_read_once(spark):
    """Threads read the narrow copy of the events and not the source."""
    q = queries()
    for name in ("active_posts", "post_roots", "engagement_totals", "friend_recommendations"):
        assert "events.parquet" not in plan(q[name](spark, SMALL)), name
    # Tables written on the way are files as well: what counts is how often a source is read.
    assert plan(q["friend_recommendations"](spark, SMALL)).count(SMALL) <= 4
    assert plan(q["static_scores"](spark, SMALL)).count("orders.parquet") <= 2


def test_the_clients_side_is_handed_out(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        pairs = spark.range(20_000).selectExpr("id % 500 as person_id", "id % 7 as organisation_id")
        shown = plan(graph.shared_organisations(cut(pairs), [1, 2, 3]))
    assert "BroadcastHashJoin" in shown and "hashpartitioning(organisation_id" not in shown

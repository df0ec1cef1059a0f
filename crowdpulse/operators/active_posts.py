"""Statistics of posts with recent activity, at every tick."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.functions.timegrid import floor_div, last_slot, slot_index
from crowdpulse.operators.timegrid import Running, running_totals, spread

TOTALS = [
    Running("num_comments", "sum"),
    Running("num_replies", "sum"),
    Running("num_people", "sum"),
    Running("last_ts", "max"),
]


def engagement_slots(resolved: DataFrame, origin: int, every: int) -> DataFrame:
    """What each person did on each post per slot; the slot before the first tick counts into it."""
    k = F.greatest(slot_index("ts_s", origin, every), F.lit(1).cast("bigint"))
    return (
        resolved.select("kind", "post_id", "person_id", "ts_s", k.alias("k"))
        .groupBy("post_id", "person_id", "k")
        .agg(
            F.count_if(F.col("kind") == "comment").alias("num_comments"),
            F.count_if(F.col("kind") == "reply").alias("num_replies"),
            F.max("ts_s").alias("last_ts"),
        )
    )


def slot_changes(acts: DataFrame, firsts: DataFrame) -> DataFrame:
    """What each post gained per slot, ``post_id, k`` and the totals.

    ``acts`` has sums per post and slot or finer ones, ``firsts`` a row per post and person with
    the slot in which they first met: they count as one person each.
    """
    gains = acts.groupBy("post_id", "k").agg(
        F.sum("num_comments").alias("num_comments"), F.sum("num_replies").alias("num_replies"), F.max("last_ts").alias("last_ts"),
    )
    met = firsts.groupBy("post_id", "k").agg(F.count("*").alias("num_people"))
    zero = F.lit(0).cast("bigint")
    both = gains.withColumn("num_people", zero).unionByName(
        met.select("post_id", "k", "num_people", zero.alias("num_comments"), zero.alias("num_replies"), F.lit(None).cast("bigint").alias("last_ts"))
    )
    return both.groupBy("post_id", "k").agg(
        F.sum("num_comments").alias("num_comments"), F.sum("num_replies").alias("num_replies"),
        F.sum("num_people").alias("num_people"), F.max("last_ts").alias("last_ts"),
    )


def _changes(resolved: DataFrame, every: int, origin: int, until: int) -> DataFrame:
    """What each post gained per slot. A person is new in the slot of their first engagement.

    Counts per post and slot and first slots per post and person are summed map-side each, so
    events are reduced before they are exchanged and neither a busy post nor a busy person is
    gathered.
    """
    k = F.greatest(slot_index("ts_s", origin, every), F.lit(1).cast("bigint"))
    acts = resolved.filter(F.col("ts_s") <= until).select(
        "post_id", "person_id", k.alias("k"), F.col("ts_s").alias("last_ts"),
        (F.col("kind") == "comment").cast("bigint").alias("num_comments"),
        (F.col("kind") == "reply").cast("bigint").alias("num_replies"),
    )
    return slot_changes(acts, acts.groupBy("post_id", "person_id").agg(F.min("k").alias("k")))


def with_reach(running: DataFrame, every: int, horizon: int, origin: int, stop: int) -> DataFrame:
    """Last slot each state is reported at: until it changes or its horizon has passed."""
    quiet = floor_div(F.col("last_ts") + F.lit(horizon - origin), every)
    reach = F.least(
        F.coalesce(F.col("next_k") - 1, F.lit(stop).cast("bigint")), quiet, F.lit(stop).cast("bigint")
    )
    return running.withColumn("reach", reach)


def active_posts(resolved: DataFrame, every: int, horizon: int, origin: int, until: int,
                 people: str = "exact", lg_k: int = 12) -> DataFrame:
    """``notify_ts, post_id, num_comments, num_replies, num_people`` of posts whose last
    activity is at most ``horizon`` seconds old. Counts run since the start of the post.

    With ``people='approx'`` the people are counted by sketches of 2^``lg_k`` cells, which are made
    per post and slot and united along the slots: there is no row for a post and a person. The
    standard error is 1.04 / sqrt(2^lg_k), 1.6 % by default; a few hundred people are counted
    as good as exactly.
    """
    if people not in ("exact", "approx"):
        raise ValueError(f"unknown way to count people {people!r}")
    stop = max(1, last_slot(until, origin, every))
    if people == "exact":
        running = running_totals(_changes(resolved, every, origin, until), ["post_id"], TOTALS)
    else:
        running = _sketched_totals(resolved, every, origin, until, lg_k)
    reach = with_reach(running, every, horizon, origin, stop)
    out = spread(reach, F.col("k"), F.col("reach"), origin, every)
    return out.select("notify_ts", "post_id", "num_comments", "num_replies", "num_people")


def _sketched_totals(resolved: DataFrame, every: int, origin: int, until: int, lg_k: int) -> DataFrame:
    """The totals of ``running_totals`` with the estimate of a running union of sketches for ``num_people``."""
    k = F.greatest(slot_index("ts_s", origin, every), F.lit(1).cast("bigint"))
    slots = resolved.filter(F.col("ts_s") <= until).groupBy("post_id", k.alias("k")).agg(
        F.count_if(F.col("kind") == "comment").alias("num_comments"), F.count_if(F.col("kind") == "reply").alias("num_replies"),
        F.max("ts_s").alias("last_ts"), F.hll_sketch_agg("person_id", lg_k).alias("people"),
    )
    w = Window.partitionBy("post_id").orderBy("k")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = [a.running(upto) for a in TOTALS if a.name != "num_people"]
    return slots.select(
        "post_id", "k", *sums, F.lead("k").over(w).alias("next_k"), F.hll_union_agg("people").over(upto).alias("people")
    ).withColumn("num_people", F.hll_sketch_estimate("people")).drop("people")


def activity_spans(resolved: DataFrame, every: int, horizon: int, origin: int, until: int) -> DataFrame:
    """Unbroken stretches of slots ``[first_k, last_k]`` in which a post is reported."""
    stop = max(1, last_slot(until, origin, every))
    aggs = [Running("last_ts", "max")]
    k = F.greatest(slot_index("ts_s", origin, every), F.lit(1).cast("bigint"))
    changes = (
        resolved.filter(F.col("ts_s") <= until).select("post_id", "ts_s").withColumn("k", k)
        .groupBy("post_id", "k").agg(F.max("ts_s").alias("last_ts"))
    )
    reach = with_reach(running_totals(changes, ["post_id"], aggs), every, horizon, origin, stop)
    w = Window.partitionBy("post_id").orderBy("k")
    broken = F.coalesce(F.lag("reach").over(w), F.lit(-1).cast("bigint")) < F.col("k") - 1
    marked = reach.filter("k <= reach").withColumn("_new", broken.cast("int"))
    island = F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (
        marked.withColumn("_island", island).groupBy("post_id", "_island")
        .agg(F.min("k").alias("first_k"), F.max("reach").alias("last_k")).drop("_island")
    )


def active_posts_people(resolved: DataFrame, every: int, horizon: int, origin: int, until: int) -> DataFrame:
    """The people behind ``num_people``, one row per tick, post and person.

    Rows rather than a set column: a post that half the network engaged with would not fit
    one row. The stretches of a post are few, its people may be many, so the join is on the
    post with the people as the side that can be split.
    """
    k = F.greatest(slot_index("ts_s", origin, every), F.lit(1).cast("bigint"))
    firsts = (
        resolved.filter(F.col("ts_s") <= until).select("post_id", "person_id", "ts_s")
        .withColumn("since_k", k).groupBy("post_id", "person_id").agg(F.min("since_k").alias("since_k"))
    )
    spans = activity_spans(resolved, every, horizon, origin, until)
    joined = firsts.join(spans, "post_id").filter("since_k <= last_k")
    start = F.greatest("since_k", "first_k")
    out = spread(joined, start, F.col("last_k"), origin, every)
    return out.select("notify_ts", "post_id", "person_id")


def engagement_totals(resolved: DataFrame) -> DataFrame:
    """Final totals per post, without a grid. People are counted after a grouping by post and
    person, so a post with very many of them is counted in parts."""
    per_person = resolved.groupBy("post_id", "person_id").agg(
        F.count_if(F.col("kind") == "comment").alias("c"),
        F.count_if(F.col("kind") == "reply").alias("r"),
        F.count_if(F.col("kind") == "like").alias("l"),
        F.max("ts_s").alias("t"),
    )
    return per_person.groupBy("post_id").agg(
        F.sum("c").alias("num_comments"), F.sum("r").alias("num_replies"), F.sum("l").alias("num_likes"),
        F.count("*").alias("num_people"), F.max("t").alias("last_ts"),
    )

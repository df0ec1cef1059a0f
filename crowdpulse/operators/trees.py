"""Threads: every like, comment and reply is led back to the post it belongs to.

A reply names only the comment it answers, so its post is the end of a chain of
unknown length. Pointer doubling follows that chain: in each round every open pointer
jumps to where its target points, which takes log2(depth) equi-joins. Only comments
that somebody answered take part; the leaves, by far the most rows, are joined once
at the end.

Skew: every join here has one row per key on its right side and nothing downstream
groups by the join key alone, so adaptive execution may split the partition of a
thread or comment that draws a large part of all events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.session import BROADCAST_ROWS, cut


def only_events(rows: DataFrame) -> DataFrame:
    """Rows of a source without punctuation and unreadable records."""
    return rows.filter("kind in ('post', 'comment', 'reply', 'like')")


def thread_events(rows: DataFrame, keep=()) -> DataFrame:
    """The columns that threads, statistics and recommendations read."""
    return only_events(rows).select(
        "kind", "id_kind", "id", "person_id", "ts_s", "parent_kind", "parent_id", "forum_id", "tags", *keep
    )


def post_nodes(events: DataFrame) -> DataFrame:
    """One row per post id: its author and time. Repeated ids keep the earliest record."""
    return (
        events.filter("kind = 'post'")
        .groupBy(F.col("id").alias("post_id"))
        .agg(F.min(F.struct("ts_s", "person_id")).alias("n"))
        .select("post_id", F.col("n.ts_s").alias("post_ts"), F.col("n.person_id").alias("author_id"))
    )


def comment_nodes(comments: DataFrame) -> DataFrame:
    """One row per comment id. Repeated ids keep the earliest record."""
    return (
        comments.groupBy("id")
        .agg(F.min(F.struct("ts_s", "parent_id", "parent_kind", "person_id")).alias("n"))
        .select(
            "id",
            F.col("n.ts_s").alias("comment_ts"),
            F.col("n.person_id").alias("comment_author"),
            F.col("n.parent_kind").alias("parent_kind"),
            F.col("n.parent_id").alias("parent_id"),
        )
    )


def answered_comments(events: DataFrame) -> DataFrame:
    """Nodes of the comments that have at least one reply."""
    targets = events.filter("kind = 'reply'").select(F.col("parent_id").alias("id")).distinct()
    comments = events.filter("kind in ('comment', 'reply')").select(
        "id", "ts_s", "parent_id", "parent_kind", "person_id"
    )
    return comment_nodes(comments.join(targets, "id", "left_semi"))


def comment_roots(events: DataFrame) -> DataFrame:
    """Root post of every answered comment: ``(id, comment_ts, comment_author, root_post_id)``.

    Comments whose chain ends nowhere or runs in a circle do not come out.
    """
    return follow_to_root(answered_comments(events))


def recursive_comment_roots(events: DataFrame) -> DataFrame:
    """``comment_roots`` by a recursive query, for short inputs: a step for each level of the deepest thread.

    Spark raises beyond ``spark.sql.cteRecursionLevelLimit`` levels (100) or
    ``spark.sql.cteRecursionRowLimit`` rows (1,000,000); pointer doubling has neither limit.
    """
    spark, nodes = events.sparkSession, cut(answered_comments(events))
    return spark.sql(
        """
        WITH RECURSIVE found(id, root_post_id) AS (
          SELECT id, parent_id FROM {nodes} WHERE parent_kind = 'post'
          UNION ALL
          SELECT n.id, f.root_post_id FROM {nodes} AS n JOIN found AS f ON n.parent_kind = 'comment' AND n.parent_id = f.id
        )
        SELECT n.id, n.comment_ts, n.comment_author, f.root_post_id FROM found AS f JOIN {nodes} AS n ON n.id = f.id
        """,
        nodes=nodes,
    )


def follow_to_root(nodes: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Pointer doubling over ``nodes``; ``known`` are comments whose root is settled already."""
    columns = ["id", "comment_ts", "comment_author"]
    nodes = cut(nodes)
    settled = nodes.filter("parent_kind = 'post'").select(
        *columns, F.col("parent_id").alias("root_post_id")
    )
    if known is not None:
        settled = settled.unionByName(known.select(*columns, "root_post_id"))
    open_ = nodes.filter("parent_kind = 'comment'").select(*columns, F.col("parent_id").alias("ptr"))
    left = open_.count()
    while left:
        targets = settled.select(
            F.col("id").alias("ptr"), "root_post_id", F.lit(None).cast("bigint").alias("next")
        ).unionByName(
            open_.select(
                F.col("id").alias("ptr"),
                F.lit(None).cast("bigint").alias("root_post_id"),
                F.col("ptr").alias("next"),
            )
        )
        # The pointers left are counted, so few of them can go to the targets instead of all
        # targets being exchanged once more; beyond the bound both sides are.
        if left <= BROADCAST_ROWS:
            step = targets.join(F.broadcast(open_), "ptr").hint("rebalance")
        else:
            step = targets.join(open_, "ptr")
        step = cut(step.select(*columns, "root_post_id", "next"))
        settled = settled.unionByName(
            step.filter("root_post_id is not null").select(*columns, "root_post_id")
        )
        open_ = step.filter("root_post_id is null").select(*columns, F.col("next").alias("ptr"))
        before, left = left, open_.count()
        if left == before:  # nothing ended and nothing fell away: only circles are left
            break
    return settled


def resolve_likes(events: DataFrame) -> DataFrame:
    """Likes with the author of the liked post; likes of unknown posts stay out."""
    likes = events.filter("kind = 'like'").select(
        "person_id", "ts_s", F.col("parent_id").alias("post_id")
    )
    return likes.join(post_nodes(events), "post_id").filter("ts_s >= post_ts")


def located(events: DataFrame, roots: DataFrame, keep=(), how: str = "inner") -> DataFrame:
    """Likes, comments and replies with the post they lead to: ``post_id`` and, for replies,
    time and author of the answered comment. ``how='left'`` keeps replies of unknown comments,
    with no ``post_id``."""
    payload = ["kind", "person_id", "ts_s", "forum_id", "tags", *keep]
    no_id = F.lit(None).cast("bigint")
    direct = events.filter("kind in ('like', 'comment')").select(
        *payload, F.col("parent_id").alias("post_id"),
        no_id.alias("parent_ts"), no_id.alias("parent_author"),
    )
    targets = roots.select(
        F.col("id").alias("_target"), F.col("root_post_id").alias("post_id"),
        F.col("comment_ts").alias("parent_ts"), F.col("comment_author").alias("parent_author"),
    )
    replies = (
        events.filter("kind = 'reply'")
        .select(*payload, F.col("parent_id").alias("_target"))
        .join(targets, "_target", how)
        .drop("_target")
    )
    return direct.unionByName(replies)


def post_trees(events: DataFrame, keep=(), roots=comment_roots) -> DataFrame:
    """Every event that belongs to a known post, with that post. ``roots`` finds the root posts of answered
    comments: ``comment_roots``, or ``recursive_comment_roots`` for short inputs.

    Out: ``kind, post_id, person_id, ts_s, author_id, parent_author, forum_id, tags`` and
    the columns named in ``keep``. An event older than what it answers does not count, but
    answers to it still find their way through it.
    """
    attached = located(events, roots(events), keep).join(post_nodes(events), "post_id")
    return own_trees(events, keep).unionByName(countable(attached, keep))


def own_trees(events: DataFrame, keep=()) -> DataFrame:
    """Posts are the roots of their own trees."""
    return events.filter("kind = 'post'").select(
        "kind", "person_id", "ts_s", "forum_id", "tags", *keep,
        F.col("id").alias("post_id"),
        F.col("person_id").alias("author_id"),
        F.col("person_id").alias("parent_author"),
    )


def countable(attached: DataFrame, keep=()) -> DataFrame:
    """Attached events that are not older than what they answer."""
    return attached.filter(F.col("ts_s") >= F.coalesce("parent_ts", "post_ts")).select(
        "kind", "person_id", "ts_s", "forum_id", "tags", *keep, "post_id", "author_id",
        F.coalesce("parent_author", "author_id").alias("parent_author"),
    )


def engagements(resolved: DataFrame) -> DataFrame:
    """The part of the trees that activity statistics read."""
    return resolved.select("kind", "post_id", "person_id", "ts_s")


def recommendation_updates(resolved: DataFrame) -> DataFrame:
    """The part of the trees that recommendations read."""
    return resolved.select(
        "kind", "ts_s", F.col("person_id").alias("actor_id"),
        F.col("author_id").alias("to_person_id"), "parent_author", "forum_id", "tags",
    )

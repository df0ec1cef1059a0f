"""The sample warehouse tables, read as a social network.

The tables are a shop's, not a network's, so roles are given to them by equi-joins and
per-row arithmetic over the whole tables:

* ``events``: purchase and signup are posts, click comments, error replies, view likes. Each
  user owns ten accounts. Answers go to the previous block of 16 consecutive events: comments
  to its first post, likes to its last post, replies to its last comment or reply.
* ``documents``: event n has the text n modulo the number of documents, so every text is used.
* ``orders``: the customer of an order knows the customer of the next order.
* ``lineitem``: a customer works where their parts come from and is a member of the forums of
  the suppliers.
* ``customer``: everybody studied in their nation.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.session import dropped, folder_made, setting, written

BLOCK = 16
ACCOUNTS = 10

SAMPLE_ORDER = ("ts_s", "event_id")

#: Events whose files may lie on disk at once, where there are fewer documents.
PART_EVENTS = 100_000
EVENT_FILES = ("posts", "comments", "likes")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _kinds(events: DataFrame) -> DataFrame:
    t = F.col("event_type")
    return events.withColumn(
        "kind",
        F.when(t.isin("purchase", "signup"), "post").when(t == "click", "comment")
        .when(t == "error", "reply").otherwise("like"),
    ).withColumn("_block", F.call_function("div", F.col("event_id"), F.lit(BLOCK)))


def sample_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` in the event layout, with ``event_id`` and ``doc_id``, without texts."""
    events = _kinds(table(spark, sf_dir, "events"))
    # A subquery of one number, which is not worked out where no text is asked for.
    texts = table(spark, sf_dir, "documents").agg(F.greatest(F.count("*"), F.lit(1))).scalar()
    # At most BLOCK rows per group: event ids are unique.
    ahead = events.groupBy((F.col("_block") + 1).alias("_block")).agg(
        F.min(F.when(F.col("kind") == "post", F.col("event_id"))).alias("first_post"),
        F.max(F.when(F.col("kind") == "post", F.col("event_id"))).alias("last_post"),
        F.max(F.when(F.col("kind").isin("comment", "reply"), F.col("event_id"))).alias("last_comment"),
    )
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.col("kind")
    return events.join(ahead, "_block", "left").select(
        "event_id",
        kind,
        F.when(kind == "post", "post").when(kind != "like", "comment").alias("id_kind"),
        F.when(kind != "like", F.col("event_id")).alias("id"),
        (F.col("user_id") * ACCOUNTS + F.col("event_id") % ACCOUNTS).alias("person_id"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts_s"),
        F.when(kind.isin("comment", "like"), "post").when(kind == "reply", "comment").alias("parent_kind"),
        F.when(kind == "comment", F.col("first_post")).when(kind == "like", F.col("last_post"))
        .when(kind == "reply", F.col("last_comment")).alias("parent_id"),
        F.when(kind == "post", F.array(k % 20, k % 7)).alias("tags"),
        F.when(kind == "post", F.col("user_id")).alias("forum_id"),
        (F.col("event_id") % texts).alias("doc_id"),
    )


def sample_seconds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` with whole seconds and whole cents."""
    return table(spark, sf_dir, "events").select(
        "event_type", "user_id", F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts_s"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
    )


def sample_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("content"))


def sample_events_with_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sample_events`` with ``content``; an event without a document has an empty text."""
    return _with_texts(sample_events(spark, sf_dir), sample_texts(spark, sf_dir))


def _with_texts(events: DataFrame, texts: DataFrame) -> DataFrame:
    """Texts are the bulk of the data, so they are never sent to every task."""
    return events.join(texts.hint("merge"), "doc_id", "left").withColumn("content", F.coalesce("content", F.lit("")))


def sample_parts(spark: SparkSession, sf_dir: str) -> Iterator[DataFrame]:
    """``sample_events_with_texts`` in parts, by a hash of ``doc_id``.

    Documents are shared, so the texts of all events may be many times the tables they come from. A part has
    about as many events as there are documents, or ``PART_EVENTS``: the size of its texts is near that of the table.
    """
    n = table(spark, sf_dir, "events").count()
    parts = -(-n // max(PART_EVENTS, table(spark, sf_dir, "documents").count()))
    if parts < 2:
        yield sample_events_with_texts(spark, sf_dir)
        return
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")
    events = written(sample_events(spark, sf_dir).withColumn("_part", part), by=("_part",))
    for i in range(parts):
        yield _with_texts(events.filter(F.col("_part") == i).drop("_part"), sample_texts(spark, sf_dir).filter(part == i))


def sample_static(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    following = orders.select((F.col("o_orderkey") - 1).alias("o_orderkey"), F.col("o_custkey").alias("person_id2"))
    knows = (
        orders.join(following, "o_orderkey")
        .select(F.col("o_custkey").alias("person_id1"), "person_id2")
        .filter("person_id1 <> person_id2").distinct()
    )
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey", F.col("l_shipdate").cast("timestamp").alias("d")
    )
    bought = lines.join(orders, "o_orderkey")
    work = bought.groupBy(F.col("o_custkey").alias("person_id"), F.col("l_partkey").alias("organisation_id")).agg(
        F.min(F.year("d")).alias("works_from")
    )
    forums = bought.groupBy(F.col("l_suppkey").alias("forum_id"), F.col("o_custkey").alias("person_id")).agg(
        F.min("d").alias("join_date")
    )
    study = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("person_id"), F.col("c_nationkey").cast("bigint").alias("organisation_id"),
        F.lit(None).cast("int").alias("class_year"),
    )
    return {
        "person_knows_person": knows,
        "person_workAt_organisation": work,
        "person_studyAt_organisation": study,
        "forum_has_member": forums,
    }


def sample_wire(spark: SparkSession, sf_dir: str, keep=(), texts: bool = True, one_line: bool = False) -> DataFrame:
    """The sample events as text records in ``value``, texts quoted (or left empty), with spaces for line breaks if ``one_line``."""
    if texts:
        e = sample_events_with_texts(spark, sf_dir)
    else:
        e = sample_events(spark, sf_dir).withColumn("content", F.lit(""))
    return _wire(e, keep, one_line)


def _wire(e: DataFrame, keep=(), one_line: bool = False) -> DataFrame:
    if one_line:
        e = e.withColumn("content", F.translate("content", "\n\r", "  "))
    at = F.date_format(F.timestamp_seconds("ts_s"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    text = F.concat(F.lit('"'), F.replace("content", F.lit('"'), F.lit('""')), F.lit('"'))
    none = F.lit("")
    tags = F.concat(F.lit("["), F.concat_ws(", ", F.transform("tags", lambda t: t.cast("string"))), F.lit("]"))

    def line(*fields):
        return F.concat_ws("|", *[F.coalesce(f.cast("string"), none) for f in fields])

    post = line(F.col("id"), F.col("person_id"), at, none, none, none, none, text, tags, F.col("forum_id"), F.lit(0))
    comment = line(
        F.col("id"), F.col("person_id"), at, none, none, text,
        F.when(F.col("kind") == "comment", F.col("parent_id")),
        F.when(F.col("kind") == "reply", F.col("parent_id")), F.lit(0),
    )
    like = line(F.col("person_id"), F.col("parent_id"), at)
    return e.select(
        *keep,
        F.when(F.col("kind") == "post", post).when(F.col("kind") == "like", like).otherwise(comment).alias("value")
    )


def event_files(spark: SparkSession, sf_dir: str, folder: str, arrival: bool = False) -> Iterator[list[str]]:
    """The sample as the three kinds of event files, each with a header line; with ``arrival`` a first field
    says when a record arrived, up to ten minutes after its event. Gives the folders of posts, comments and likes,
    for one of the ``sample_parts`` after the other; the files of a part go when the next part is asked for."""
    for i, events in enumerate(sample_parts(spark, sf_dir)):
        wire = _wire(events, keep=("event_id", "kind", "ts_s"), one_line=True)
        if arrival:
            at = F.date_format(F.timestamp_seconds(F.col("ts_s") + F.col("event_id") % 600), "yyyy-MM-dd'T'HH:mm:ss'Z'")
            wire = wire.withColumn("value", F.concat(at, F.lit("|"), "value"))
        kind = F.col("kind")
        file = F.when(kind == "post", "posts").when(kind == "like", "likes").otherwise("comments")
        path = f"{folder}/{i}"
        # All kinds at once, as each would join the texts anew, and without a sort of the lines by kind.
        with setting(spark, "spark.sql.maxConcurrentOutputFileWriters", len(EVENT_FILES)):
            # A separator and quotes that no line holds: lines are written as they are, under a header in each file.
            wire.select("value", file.alias("file")).write.partitionBy("file").option("header", True).option("sep", "\x00").option(
                "quote", "\x01").option("emptyValue", "").csv(path)
        folders = [f"{path}/file={name}" for name in EVENT_FILES]
        for name in folders:  # a part may have no such record
            folder_made(spark, name)
        try:
            yield folders
        finally:
            dropped(spark, path)


def write_static_tables(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """The four relational tables as ``<folder>/<table>.csv``."""
    for name, df in sample_static(spark, sf_dir).items():
        df.write.option("sep", "|").option("header", True).csv(f"{folder}/{name}.csv")

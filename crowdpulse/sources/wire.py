"""Text records to typed events.

One record is one pipe-separated line without header; the number of fields tells a
post (11) from a comment (9) and a like (3), and ``WATERMARK|<epoch seconds>`` only
moves time on. A record that fits none of them becomes ``kind = 'malformed'`` and is
kept with its text, so one bad line neither stops the job nor disappears.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions.text import parse_tags
from crowdpulse.functions.timegrid import parse_utc
from crowdpulse.schema import (
    COMMENT_FIELDS,
    EVENT_SCHEMA,
    LIKE_FIELDS,
    POST_FIELDS,
    WATERMARK_PREFIX,
    text_struct,
)

CSV_OPTIONS = {"sep": "|", "quote": '"', "escape": '"'}


def read_kafka(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Event topic from its earliest offset; needs the Kafka connector on the classpath.

    Never run here, for want of a broker and the connector: the tests look at the options only.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    for key, value in options.items():
        reader = reader.option(key, value)
    return reader.load().select("value")


def read_text_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """A folder that receives text files of records, as a stream of ``value``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def _field_count(text: Column) -> Column:
    # Separators inside a quoted field do not count; a quote opens a field only at its start.
    # Most records have no quote at all and need no pattern.
    bare = F.regexp_replace(F.replace(text, F.lit('""'), F.lit("")), r'(^|\|)"[^"]*"', "$1")
    outside = F.when(F.contains(text, F.lit('"')), bare).otherwise(text)
    return F.length(outside) - F.length(F.replace(outside, F.lit("|"), F.lit(""))) + 1


def _long(field: Column) -> Column:
    return F.trim(field).try_cast("bigint")


def _optional_text(field: Column) -> Column:
    return F.when(field != "", field)


def parse_events(records: DataFrame, value: str | Column = "value", keep=()) -> DataFrame:
    """All records as typed rows: the event columns plus ``raw`` for malformed ones.

    ``value`` is the text or bytes of a record: a column's name or any expression over ``records``.

    Punctuation comes out as ``kind = 'watermark'`` with its time in ``ts_s``. Columns
    named in ``keep`` travel along unchanged. Works on batch and streaming frames.
    """
    raw = F.col(value) if isinstance(value, str) else value
    text = F.try_validate_utf8(raw.cast("string"))
    split = records.select(
        *keep,
        F.when(text.isNull(), F.lit("")).otherwise(text).alias("_text"),
        F.when(text.isNull(), raw.cast("binary")).otherwise(text.cast("binary")).alias("_raw"),
    ).withColumn("_n", _field_count(F.col("_text")))

    typed = (
        split.withColumn("_post", _as_struct(POST_FIELDS))
        .withColumn("_comment", _as_struct(COMMENT_FIELDS))
        .withColumn("_like", _as_struct(LIKE_FIELDS))
        .withColumn(
            "_mark",
            F.when(
                (F.col("_n") == 2) & F.col("_text").startswith(WATERMARK_PREFIX + "|"),
                F.trim(F.substring_index("_text", "|", -1)).try_cast("bigint"),
            ),
        )
    )
    # A generator of one row: filters on the result stay above it, so a filter does not parse
    # the text a second time, once for every column it mentions.
    events = typed.select(*keep, "_raw", F.inline(F.array(_event_struct())))
    return events.select(
        *keep, *EVENT_SCHEMA.names, F.when(F.col("kind") == "malformed", F.col("_raw")).alias("raw")
    )


def _as_struct(fields) -> Column:
    schema = text_struct(fields).simpleString()[len("struct<"):-1].replace(":", " ")
    parsed = F.from_csv(F.col("_text"), schema.replace(",", ", "), CSV_OPTIONS)
    return F.when(F.col("_n") == len(fields), parsed)


def _event_struct() -> Column:
    post, comment, like = F.col("_post"), F.col("_comment"), F.col("_like")
    to_post = _long(comment["reply_to_post_id"])
    to_comment = _long(comment["reply_to_comment_id"])

    a_post = dict(
        kind=F.lit("post"), id_kind=F.lit("post"), id=_long(post["id"]),
        person_id=_long(post["person_id"]), ts_s=parse_utc(post["creation_date"]),
        image_file=_optional_text(post["image_file"]),
        location_ip=F.coalesce(post["location_ip"], F.lit("")),
        browser_used=F.coalesce(post["browser_used"], F.lit("")),
        language=_optional_text(post["language"]),
        content=F.coalesce(post["content"], F.lit("")), tags=parse_tags(post["tags"]),
        forum_id=_long(post["forum_id"]), place_id=_long(post["place_id"]),
    )
    a_comment = dict(
        kind=F.when(to_post.isNotNull(), "comment").otherwise("reply"),
        id_kind=F.lit("comment"), id=_long(comment["id"]),
        person_id=_long(comment["person_id"]), ts_s=parse_utc(comment["creation_date"]),
        parent_kind=F.when(to_post.isNotNull(), "post").otherwise("comment"),
        parent_id=F.coalesce(to_post, to_comment),
        location_ip=F.coalesce(comment["location_ip"], F.lit("")),
        browser_used=F.coalesce(comment["browser_used"], F.lit("")),
        content=F.coalesce(comment["content"], F.lit("")),
        place_id=_long(comment["place_id"]),
    )
    a_like = dict(
        kind=F.lit("like"), person_id=_long(like["person_id"]),
        ts_s=parse_utc(like["creation_date"]), parent_kind=F.lit("post"),
        parent_id=_long(like["post_id"]),
    )
    return (
        F.when(_all_set(a_post, "id", "person_id", "ts_s", "forum_id", "place_id"), _row(a_post))
        .when(_all_set(a_comment, "id", "person_id", "ts_s", "parent_id", "place_id"), _row(a_comment))
        .when(_all_set(a_like, "person_id", "ts_s", "parent_id"), _row(a_like))
        .when(F.col("_mark").isNotNull(), _row(dict(kind=F.lit("watermark"), ts_s=F.col("_mark"))))
        .otherwise(_row(dict(kind=F.lit("malformed"))))
    )


def _row(given: dict[str, Column]) -> Column:
    """An event struct with the named columns set and the rest null."""
    return F.struct(*[
        given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT_SCHEMA
    ])


def _all_set(given: dict[str, Column], *names: str) -> Column:
    return reduce(and_, [given[name].isNotNull() for name in names])


def events_only(parsed: DataFrame) -> DataFrame:
    return parsed.filter(~F.col("kind").isin("watermark", "malformed")).drop("raw")


def heartbeats(parsed: DataFrame) -> DataFrame:
    return parsed.filter("kind = 'watermark'").select("ts_s")


def malformed(parsed: DataFrame) -> DataFrame:
    return parsed.filter("kind = 'malformed'").select("raw")

"""Events and static tables from pipe-separated files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions.timegrid import parse_utc
from crowdpulse.schema import (
    FORUM_MEMBER_SCHEMA,
    KNOWS_SCHEMA,
    STUDY_SCHEMA,
    WORK_SCHEMA,
)
from crowdpulse.sources.wire import parse_events

EVENT_FILES = ("posts_event_stream.csv", "comments_event_stream.csv", "likes_event_stream.csv")

STATIC_TABLES = {
    "person_knows_person": KNOWS_SCHEMA,
    "person_studyAt_organisation": STUDY_SCHEMA,
    "person_workAt_organisation": WORK_SCHEMA,
    "forum_has_member": FORUM_MEMBER_SCHEMA,
}


def _record_lines(spark: SparkSession, paths) -> DataFrame:
    """Lines of the files without each file's first line, the header, and without blank ones.

    The reader of separated files knows the first line by its position; with a separator that no
    line can hold and without quotes it leaves the lines as they are.
    """
    return (
        spark.read.schema("value string")
        .option("header", True).option("enforceSchema", True).option("sep", "\x00").option("quote", "").option("escape", "")
        .csv(list(paths)).filter("value is not null")
    )


def read_event_files(spark: SparkSession, posts: str, comments: str, likes: str) -> DataFrame:
    """The three event files as one table of events; what can't be read is kept as rows of the kind
    ``malformed`` with their text in ``raw``. The order of events is a property of the operators
    downstream (``ts_s`` and the tie order), so nothing is sorted here."""
    return parse_events(_record_lines(spark, (posts, comments, likes)))


def read_events_with_arrival(spark: SparkSession, posts: str, comments: str, likes: str) -> DataFrame:
    """Event files whose first field is the arrival time: rows as above plus ``arrival_s``, which is
    null where there is no such field."""
    lines = _record_lines(spark, (posts, comments, likes))
    first_end = F.instr("value", "|")
    records = lines.select(
        F.when(first_end > 0, parse_utc(F.expr("left(value, instr(value, '|') - 1)"))).alias("arrival_s"),
        F.col("value").substr(first_end + 1, F.length("value")).alias("value"),
    )
    return parse_events(records, keep=("arrival_s",))


def read_static_tables(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The four relational tables, ``<folder>/<table>.csv`` with a header line."""
    return {
        name: spark.read.csv(f"{folder}/{name}.csv", sep="|", header=True, schema=schema)
        for name, schema in STATIC_TABLES.items()
    }

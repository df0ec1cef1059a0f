"""Record layouts and the constants of the three questions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# They must keep these numbers for results to agree.
# ---------------------------------------------------------------------------
FIELD_SEPARATOR = "|"
WATERMARK_PREFIX = "WATERMARK"
MAX_DELAY_SECONDS = 600

ACTIVE_POSTS_EVERY = 1_800
ACTIVE_POSTS_HORIZON = 43_200

RECOMMEND_EVERY = 3_600
RECOMMEND_WINDOW = 14_400
RECOMMEND_SIZE = 5
RECOMMEND_CLIENTS = (100, 200, 300, 400, 500, 600, 700, 800, 900, 1000)

BURST_WINDOW = 60
BURST_MAX = 100
BURST_CAP = 90
BURST_BUCKETS = 20

VOCABULARY_CAP = 0.5
VOCABULARY_BUCKETS = 10

PERCENT = 5
MIN_OBSERVATIONS = 10


@dataclass(frozen=True)
class Weights:
    """How much each kind of evidence counts for a recommendation (fixed defaults)."""

    common_friends: int = 1
    work: int = 1
    study: int = 1
    like: int = 5
    comment: int = 10
    reply: int = 5
    forum_post: int = 20
    tag_post: int = 10
    active: int = 1


# Positional layouts of one text record, all fields as text; typed by ``sources.wire``.
POST_FIELDS = (
    "id", "person_id", "creation_date", "image_file", "location_ip", "browser_used",
    "language", "content", "tags", "forum_id", "place_id",
)
COMMENT_FIELDS = (
    "id", "person_id", "creation_date", "location_ip", "browser_used", "content",
    "reply_to_post_id", "reply_to_comment_id", "place_id",
)
LIKE_FIELDS = ("person_id", "post_id", "creation_date")


def text_struct(fields) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


# The one wide table every operator reads. ``kind`` is post / comment / reply / like
# (a comment answers a post, a reply answers a comment). Posts and comments number
# their ids independently, so an id always travels with ``id_kind``.
EVENT_SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("id_kind", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("person_id", T.LongType()),
    T.StructField("ts_s", T.LongType()),
    T.StructField("parent_kind", T.StringType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("image_file", T.StringType()),
    T.StructField("location_ip", T.StringType()),
    T.StructField("browser_used", T.StringType()),
    T.StructField("language", T.StringType()),
    T.StructField("content", T.StringType()),
    T.StructField("tags", T.ArrayType(T.LongType())),
    T.StructField("forum_id", T.LongType()),
    T.StructField("place_id", T.LongType()),
])

# Total order of events: by time, then by what the record says about itself.
EVENT_ORDER = ("ts_s", "id", "id_kind", "person_id", "parent_kind", "parent_id")

KNOWS_SCHEMA = T.StructType([
    T.StructField("person_id1", T.LongType(), False),
    T.StructField("person_id2", T.LongType(), False),
])
STUDY_SCHEMA = T.StructType([
    T.StructField("person_id", T.LongType(), False),
    T.StructField("organisation_id", T.LongType(), False),
    T.StructField("class_year", T.IntegerType()),
])
WORK_SCHEMA = T.StructType([
    T.StructField("person_id", T.LongType(), False),
    T.StructField("organisation_id", T.LongType(), False),
    T.StructField("works_from", T.IntegerType()),
])
FORUM_MEMBER_SCHEMA = T.StructType([
    T.StructField("forum_id", T.LongType(), False),
    T.StructField("person_id", T.LongType(), False),
    T.StructField("join_date", T.TimestampType()),
])

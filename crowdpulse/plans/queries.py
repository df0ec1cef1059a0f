"""Every operator as a query over the sample tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdpulse.functions.text import unique_word_ratio
from crowdpulse.functions.timegrid import last_slot
from crowdpulse.operators import active_posts as active
from crowdpulse.operators import graph, recommend, spam, threshold, trees
from crowdpulse.operators.timegrid import periodic_snapshot, sliding_sum, time_bounds
from crowdpulse.plans import api, stream_queries
from crowdpulse.schema import RECOMMEND_CLIENTS, RECOMMEND_EVERY, RECOMMEND_WINDOW
from crowdpulse.session import checkpoint_dir, written
from crowdpulse.sources import read_event_files, read_events_with_arrival, read_static_tables
from crowdpulse.sources import sample_tables as sample
from crowdpulse.sources.wire import parse_events

# The sample has no minute-long bursts, so its burst queries look at a day and flag from the
# third event on. The standard settings are covered by the tests.
SAMPLE_BURST_WINDOW = 86_400
SAMPLE_BURST = threshold.Histogram(20, 0.0, 100.0, 97.0)
ORDER = sample.SAMPLE_ORDER
# Everybody is served every two weeks.
ALL_EVERY, ALL_WINDOW = 1_209_600, 2_419_200


def _static(spark, sf_dir):
    return sample.sample_static(spark, sf_dir)


def _events(spark, sf_dir, keep=()):
    """The sample events, narrow and written once: threads read them several times."""
    return written(trees.thread_events(sample.sample_events(spark, sf_dir), keep))


def _resolved(spark, sf_dir, keep=()):
    return trees.post_trees(_events(spark, sf_dir, keep), keep)


def _updates(spark, sf_dir):
    return trees.recommendation_updates(_resolved(spark, sf_dir))


def _rated(spark, sf_dir) -> DataFrame:
    """Events with the ratio of their text; each shared document is measured once."""
    ratios = sample.sample_texts(spark, sf_dir).select(
        "doc_id", unique_word_ratio("content").alias("ratio")
    )
    events = sample.sample_events(spark, sf_dir).join(ratios, "doc_id", "left")
    return events.withColumn("ratio", F.coalesce("ratio", unique_word_ratio(F.lit(""))))


def _parse(spark, sf_dir):
    return _record_rows(parse_events(sample.sample_wire(spark, sf_dir)))


def _record_rows(parsed, *more):
    return parsed.select(
        "kind", "id_kind", "id", "person_id", "ts_s", "parent_kind", "parent_id", "forum_id",
        F.when(
            F.col("kind") == "post",
            F.concat(F.lit("["), F.concat_ws(", ", F.transform("tags", lambda t: t.cast("string"))), F.lit("]")),
        ).alias("tags"),
        F.md5(F.col("content").cast("binary")).alias("content_md5"), *more,
    )


def _event_files(spark, sf_dir):
    folder = f"{checkpoint_dir(spark)}/event-files-{uuid.uuid4().hex}"
    # What a part says is written before its files go.
    return reduce(DataFrame.unionByName, [
        written(_record_rows(read_event_files(spark, *paths))) for paths in sample.event_files(spark, sf_dir, folder)
    ])


def _event_files_with_arrival(spark, sf_dir):
    folder = f"{checkpoint_dir(spark)}/event-files-{uuid.uuid4().hex}"
    return reduce(DataFrame.unionByName, [
        written(_record_rows(read_events_with_arrival(spark, *paths), "arrival_s"))
        for paths in sample.event_files(spark, sf_dir, folder, arrival=True)
    ])


def _bad_bytes(spark, sf_dir):
    """A byte that is no UTF-8 in every hundredth record: those are kept as they came, the others are read."""
    wire = sample.sample_wire(spark, sf_dir, keep=("event_id",), texts=False)
    raw = F.col("value").cast("binary")
    bad = F.when(F.col("event_id") % 100 == 3, F.concat(raw, F.lit(b"\xff"))).otherwise(raw)
    return parse_events(wire.withColumn("value", bad), keep=("event_id",)).select(
        "kind", "event_id", "person_id",
        F.coalesce(F.hex("raw").endswith("FF"), F.lit(False)).alias("bad_bytes"), F.col("raw").isNotNull().alias("kept_raw"),
    )


def _static_tables(spark, sf_dir):
    folder = f"{checkpoint_dir(spark)}/static-tables-{uuid.uuid4().hex}"
    sample.write_static_tables(spark, sf_dir, folder)
    rows = []
    for name, df in read_static_tables(spark, folder).items():
        a, b, c = [*df.columns, None][:3]
        third = F.unix_seconds(c) if c == "join_date" else F.lit(None) if c is None else F.col(c)
        rows.append(df.select(F.lit(name).alias("name"), F.col(a).alias("a"), F.col(b).alias("b"), third.cast("bigint").alias("c")))
    return reduce(DataFrame.unionByName, rows)


def _classify(spark, sf_dir):
    return sample.sample_events(spark, sf_dir).select(
        "event_id", "kind", "id_kind", "id", "person_id", "ts_s",
        F.coalesce("parent_kind", F.lit("post")).alias("target_kind"),
        F.when(F.col("kind") == "post", F.col("id")).otherwise(F.col("parent_id")).alias("target_id"),
    )


def _likes(spark, sf_dir):
    return trees.resolve_likes(sample.sample_events(spark, sf_dir)).select(
        "post_id", "person_id", "ts_s", "author_id"
    )


def _roots(spark, sf_dir):
    return _resolved(spark, sf_dir, keep=("event_id",)).filter("kind in ('comment', 'reply')").select(
        "event_id", "kind", "post_id", "author_id"
    )


def _roots_recursive(spark, sf_dir):
    events = _events(spark, sf_dir, keep=("event_id",))
    resolved = trees.post_trees(events, ("event_id",), trees.recursive_comment_roots)
    return resolved.filter("kind in ('comment', 'reply')").select("event_id", "kind", "post_id", "author_id")


def _dynamic(spark, sf_dir):
    events = _events(spark, sf_dir)
    origin, until = time_bounds(events)
    return recommend.dynamic_scores(
        written(trees.recommendation_updates(trees.post_trees(events))),
        _static(spark, sf_dir)["forum_has_member"], RECOMMEND_CLIENTS,
        RECOMMEND_EVERY, RECOMMEND_WINDOW, origin, until,
    )


def _activity(spark, sf_dir):
    events = _events(spark, sf_dir)
    origin, until = time_bounds(events)
    stop = last_slot(until, origin, RECOMMEND_EVERY)
    updates = trees.recommendation_updates(trees.post_trees(events))
    return recommend.activity_window_scores(updates, RECOMMEND_EVERY, RECOMMEND_WINDOW, origin, stop)


def _histogram(spark, sf_dir):
    texts = spam.text_ratios(_rated(spark, sf_dir), ORDER, "ratio")
    return threshold.histogram_counts(texts, "ratio", spam.VOCABULARY)


def _threshold(spark, sf_dir):
    texts = spam.text_ratios(_rated(spark, sf_dir), ORDER, "ratio")
    return threshold.histogram_threshold(texts, "ratio", spam.VOCABULARY)


def _burst_counts(spark, sf_dir):
    events = sample.sample_events(spark, sf_dir).select("event_id", "person_id", "ts_s")
    sliced = threshold.slice_in_order(events, ORDER)
    return spam.burst_counts(sliced, ORDER, SAMPLE_BURST_WINDOW).select("event_id", "person_id", "ts_s", "n")


def _burst_spam(spark, sf_dir):
    return api.burst_spam(
        sample.sample_events(spark, sf_dir), SAMPLE_BURST_WINDOW, histogram=SAMPLE_BURST, order=ORDER
    ).withColumn("entry", F.col("entry").cast("bigint"))


def _low_vocabulary(spark, sf_dir):
    return api.low_vocabulary_spam(_rated(spark, sf_dir), order=ORDER, ratio="ratio")


def _snapshot(spark, sf_dir):
    events = sample.sample_seconds(spark, sf_dir)
    origin, until = time_bounds(events, None)
    return periodic_snapshot(events, ["event_type"], stream_queries.SNAPSHOT_AGGS, 21_600, origin, until)


def _sliding(spark, sf_dir):
    events = sample.sample_seconds(spark, sf_dir)
    origin, until = time_bounds(events, None)
    return sliding_sum(events, ["user_id"], {"cents": "cents"}, 3_600, 14_400, origin, until)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    clients = RECOMMEND_CLIENTS
    knows = lambda s, d: _static(s, d)["person_knows_person"]
    return {
        "parse_events": _parse,
        "event_files": _event_files,
        "event_files_with_arrival": _event_files_with_arrival,
        "records_with_bad_bytes": _bad_bytes,
        "static_tables": _static_tables,
        "classify_engagement": _classify,
        "resolve_likes": _likes,
        "post_roots": _roots,
        "post_roots_recursive": _roots_recursive,
        "engagement_totals": lambda s, d: active.engagement_totals(_resolved(s, d)),
        "active_posts": lambda s, d: api.active_posts(sample.sample_events(s, d)),
        "active_posts_approx": lambda s, d: api.active_posts(sample.sample_events(s, d), people="approx"),
        "active_posts_people": lambda s, d: api.active_posts_people(sample.sample_events(s, d)),
        "friends": lambda s, d: graph.friends(knows(s, d), clients),
        "in_degree": lambda s, d: graph.in_degree(knows(s, d)),
        "non_friends": lambda s, d: graph.non_friends(knows(s, d), clients),
        "common_friends": lambda s, d: graph.common_friends(knows(s, d), clients, ordered=True),
        "shared_work": lambda s, d: graph.shared_organisations(
            _static(s, d)["person_workAt_organisation"], clients),
        "shared_study": lambda s, d: graph.shared_organisations(
            _static(s, d)["person_studyAt_organisation"], clients),
        "client_forums": lambda s, d: graph.client_forums(_static(s, d)["forum_has_member"], clients),
        "forums_per_person": lambda s, d: graph.forums_per_person(_static(s, d)["forum_has_member"]),
        "static_scores": lambda s, d: graph.static_scores(
            knows(s, d), _static(s, d)["person_workAt_organisation"],
            _static(s, d)["person_studyAt_organisation"], clients),
        "interaction_affinity": lambda s, d: recommend.interaction_points(_updates(s, d), clients),
        "tag_affinity": lambda s, d: recommend.tag_points(written(_updates(s, d)), clients),
        "forum_affinity": lambda s, d: recommend.forum_points(
            _updates(s, d), _static(s, d)["forum_has_member"], clients),
        "activity_scores": _activity,
        "dynamic_scores": _dynamic,
        "friend_recommendations": lambda s, d: api.friend_recommendations(
            sample.sample_events(s, d), _static(s, d)),
        "all_common_friends": lambda s, d: graph.common_friends(knows(s, d), None),
        "all_recommendations": lambda s, d: api.friend_recommendations(
            sample.sample_events(s, d), _static(s, d), None, ALL_EVERY, ALL_WINDOW),
        "unique_word_ratio": lambda s, d: spam.text_ratios(_rated(s, d), ORDER, "ratio"),
        "vocabulary_histogram": _histogram,
        "vocabulary_threshold": _threshold,
        "running_vocabulary_threshold": lambda s, d: spam.vocabulary_thresholds(
            _rated(s, d), order=ORDER, ratio="ratio").drop("slice"),
        "low_vocabulary_spam": _low_vocabulary,
        "burst_counts": _burst_counts,
        "burst_spam": _burst_spam,
        "spammers": lambda s, d: spam.spammers(_burst_spam(s, d), _low_vocabulary(s, d)),
        "stream_post_trees": stream_queries.stream_post_trees,
        "stream_active_posts": stream_queries.stream_active,
        "stream_late_expiry": stream_queries.stream_late_expiry,
        "stream_likes": stream_queries.stream_likes,
        "stream_snapshot": stream_queries.stream_snapshot,
        "stream_sliding_sum": stream_queries.stream_sliding_sum,
        "stream_friend_recommendations": stream_queries.stream_recommendations,
        "stream_spammers": lambda s, d: stream_queries.stream_spam(
            s, d, SAMPLE_BURST_WINDOW, SAMPLE_BURST),
        "periodic_snapshot": _snapshot,
        "sliding_sum": _sliding,
    }

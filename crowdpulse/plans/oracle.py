"""The registered queries once more as plain SQL over the sample tables.

Written from the definitions, not from the Spark plans: ticks are joined with everything
that happened before them, threads are walked down by a recursive query, and thresholds are
running sums over one ordered table.
"""

from __future__ import annotations

from crowdpulse.schema import (
    ACTIVE_POSTS_EVERY,
    ACTIVE_POSTS_HORIZON,
    RECOMMEND_CLIENTS,
    RECOMMEND_EVERY,
    RECOMMEND_SIZE,
    RECOMMEND_WINDOW,
)

CLIENTS = ", ".join(str(c) for c in RECOMMEND_CLIENTS)

EVENTS = """
kinds AS (
  SELECT event_id, user_id, epoch_us(ts) // 1000000 AS ts_s, value, props,
         event_id // 16 AS block,
         CASE WHEN event_type IN ('purchase', 'signup') THEN 'post' WHEN event_type = 'click' THEN 'comment'
              WHEN event_type = 'error' THEN 'reply' ELSE 'like' END AS kind
  FROM events),
ahead AS (
  SELECT block + 1 AS block,
         min(event_id) FILTER (kind = 'post') AS first_post,
         max(event_id) FILTER (kind = 'post') AS last_post,
         max(event_id) FILTER (kind IN ('comment', 'reply')) AS last_comment
  FROM kinds GROUP BY 1),
e AS (
  SELECT event_id, kind, user_id * 10 + event_id % 10 AS person_id, ts_s,
         CASE WHEN kind = 'post' THEN 'post' WHEN kind <> 'like' THEN 'comment' END AS id_kind,
         CASE WHEN kind <> 'like' THEN event_id END AS id,
         CASE WHEN kind IN ('comment', 'like') THEN 'post' WHEN kind = 'reply' THEN 'comment' END AS parent_kind,
         CASE kind WHEN 'comment' THEN first_post WHEN 'like' THEN last_post WHEN 'reply' THEN last_comment END AS parent_id,
         CASE WHEN kind = 'post' THEN CAST(json_extract(props, '$.k') AS BIGINT) END AS tag_key,
         CASE WHEN kind = 'post' THEN user_id END AS forum_id,
         event_id % (SELECT count(*) FROM documents) AS doc_id
  FROM kinds LEFT JOIN ahead USING (block))"""

TREES = EVENTS + """,
posts AS (SELECT event_id AS post_id, person_id AS author_id, ts_s AS post_ts FROM e WHERE kind = 'post'),
roots AS (
  SELECT event_id, parent_id AS root_post_id FROM e WHERE kind = 'comment' AND parent_id IS NOT NULL
  UNION ALL
  SELECT c.event_id, r.root_post_id FROM e AS c JOIN roots AS r ON c.kind = 'reply' AND c.parent_id = r.event_id),
attached AS (
  SELECT x.event_id, x.kind, x.person_id, x.ts_s, x.parent_id AS post_id, p.author_id, x.forum_id, x.tag_key
  FROM e AS x JOIN posts AS p ON p.post_id = x.parent_id
  WHERE x.kind IN ('like', 'comment') AND x.ts_s >= p.post_ts
  UNION ALL
  SELECT x.event_id, x.kind, x.person_id, x.ts_s, r.root_post_id, p.author_id, x.forum_id, x.tag_key
  FROM e AS x JOIN roots AS r ON r.event_id = x.parent_id JOIN e AS parent ON parent.event_id = x.parent_id
  JOIN posts AS p ON p.post_id = r.root_post_id
  WHERE x.kind = 'reply' AND x.ts_s >= parent.ts_s),
resolved AS (
  SELECT * FROM attached
  UNION ALL
  SELECT event_id, kind, person_id, ts_s, event_id, person_id, forum_id, tag_key FROM e WHERE kind = 'post'),
bounds AS (SELECT min(ts_s) FILTER (kind = 'post') AS origin, max(ts_s) AS until FROM e)"""

STATIC = """
knows AS (
  SELECT DISTINCT a.o_custkey AS person_id1, b.o_custkey AS person_id2
  FROM orders AS a JOIN orders AS b ON b.o_orderkey = a.o_orderkey + 1 WHERE a.o_custkey <> b.o_custkey),
bought AS (
  SELECT o_custkey, l_partkey, l_suppkey, l_shipdate FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
work AS (SELECT DISTINCT o_custkey AS person_id, l_partkey AS organisation_id FROM bought),
forum_members AS (SELECT l_suppkey AS forum_id, o_custkey AS person_id, min(l_shipdate) AS join_date FROM bought GROUP BY 1, 2),
study AS (SELECT c_custkey AS person_id, CAST(c_nationkey AS BIGINT) AS organisation_id FROM customer),
clients AS (SELECT unnest([""" + CLIENTS + """])::BIGINT AS person_id),
friends AS (SELECT person_id1 AS person_id, person_id2 AS friend_id FROM knows JOIN clients ON person_id1 = person_id),
non_friends AS (
  SELECT c.person_id, k.person_id2 AS candidate_id, count(*) AS count
  FROM knows AS k CROSS JOIN clients AS c
  WHERE NOT EXISTS (SELECT 1 FROM friends AS f WHERE f.person_id = c.person_id AND f.friend_id = k.person_id2)
  GROUP BY 1, 2),
common_friends AS (
  SELECT f.person_id, ff.person_id2 AS candidate_id, count(*) AS count
  FROM friends AS f JOIN knows AS ff ON ff.person_id1 = f.friend_id
  WHERE ff.person_id1 <> f.person_id AND ff.person_id2 <> f.person_id GROUP BY 1, 2),
shared_work AS (
  SELECT a.person_id, b.person_id AS candidate_id, count(*) AS count
  FROM work AS a JOIN work AS b USING (organisation_id) JOIN clients AS c ON c.person_id = a.person_id
  WHERE a.person_id <> b.person_id GROUP BY 1, 2),
shared_study AS (
  SELECT a.person_id, b.person_id AS candidate_id, count(*) AS count
  FROM study AS a JOIN study AS b USING (organisation_id) JOIN clients AS c ON c.person_id = a.person_id
  WHERE a.person_id <> b.person_id GROUP BY 1, 2),
static_scores AS (
  SELECT person_id, candidate_id, CAST(sum(score) AS BIGINT) AS score FROM (
    SELECT person_id, candidate_id, 0 AS score FROM non_friends
    UNION ALL SELECT person_id, candidate_id, count FROM common_friends
    UNION ALL SELECT person_id, candidate_id, count FROM shared_work
    UNION ALL SELECT person_id, candidate_id, count FROM shared_study) AS s
  WHERE NOT EXISTS (SELECT 1 FROM friends AS f WHERE f.person_id = s.person_id AND f.friend_id = s.candidate_id)
  GROUP BY 1, 2)"""

LISTED = "SELECT unnest([" + CLIENTS + "])::BIGINT AS person_id"
EVERYBODY = """SELECT person_id1 AS person_id FROM knows UNION SELECT person_id2 FROM knows UNION SELECT person_id FROM work
            UNION SELECT person_id FROM study UNION SELECT person_id FROM forum_members"""
ALL_EVERY, ALL_WINDOW = 1_209_600, 2_419_200


def _for_everybody(sql: str) -> str:
    """The same query with everybody as clients, every two weeks."""
    assert LISTED in sql
    return (
        sql.replace(LISTED, EVERYBODY).replace(f"/ {RECOMMEND_EVERY})", f"/ {ALL_EVERY})")
        .replace(f"origin + {RECOMMEND_EVERY} *", f"origin + {ALL_EVERY} *").replace(f"- {RECOMMEND_WINDOW} ", f"- {ALL_WINDOW} ")
    )


DYNAMIC = TREES + "," + STATIC + f""",
tags AS (
  SELECT person_id, ts_s, event_id, unnest([tag_key % 20, tag_key % 7]) AS tag FROM resolved WHERE kind = 'post'),
first_use AS (SELECT person_id, tag, min(ts_s) AS first_use FROM tags JOIN clients USING (person_id) GROUP BY 1, 2),
interactions AS (
  SELECT person_id, author_id AS candidate_id, ts_s, CASE kind WHEN 'like' THEN 5 ELSE 10 END AS points
  FROM resolved JOIN clients USING (person_id) WHERE kind <> 'post'),
tag_points AS (
  SELECT f.person_id, t.person_id AS candidate_id, t.ts_s, 10 AS points
  FROM tags AS t JOIN first_use AS f ON f.tag = t.tag AND f.first_use < t.ts_s AND f.person_id <> t.person_id),
client_forums AS (SELECT DISTINCT person_id, forum_id FROM forum_members JOIN clients USING (person_id)),
forum_points AS (
  SELECT f.person_id, r.person_id AS candidate_id, r.ts_s, 20 AS points
  FROM resolved AS r JOIN client_forums AS f USING (forum_id) WHERE r.kind = 'post' AND f.person_id <> r.person_id),
points AS (
  SELECT * FROM interactions UNION ALL SELECT * FROM tag_points UNION ALL SELECT * FROM forum_points),
ticks AS (
  SELECT origin + {RECOMMEND_EVERY} * unnest(range(1, 1 + CAST(ceil((until - origin) / {RECOMMEND_EVERY}) AS BIGINT))) AS notify_ts
  FROM bounds),
personal AS (
  SELECT notify_ts, person_id, candidate_id, CAST(sum(points) AS BIGINT) AS points
  FROM points JOIN ticks ON ts_s > notify_ts - {RECOMMEND_WINDOW} AND ts_s <= notify_ts GROUP BY 1, 2, 3),
activity AS (
  SELECT notify_ts, person_id AS candidate_id, count(*) AS activity
  FROM resolved JOIN ticks ON ts_s > notify_ts - {RECOMMEND_WINDOW} AND ts_s <= notify_ts GROUP BY 1, 2)"""

_CLOSED = f"""
ticks AS (SELECT origin, until, {ACTIVE_POSTS_EVERY} AS w, {ACTIVE_POSTS_HORIZON} AS h,
                 CAST(ceil((until - origin) / {ACTIVE_POSTS_EVERY}) AS BIGINT) AS stop FROM bounds),
slotted AS (
  SELECT r.*, greatest(1, CAST(ceil((ts_s - origin) / w) AS BIGINT)) AS k, origin, w,
         least(stop, CAST(floor((ts_s + h - origin) / w) AS BIGINT)) AS reach
  FROM resolved AS r CROSS JOIN ticks),
active AS (SELECT DISTINCT post_id, origin, w, unnest(range(k, reach + 1)) AS tick FROM slotted)"""

# Fixed code points of white space that the engine's \\s does not cover.
WORD_BREAK = (
    r"[\s\x{0B}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
    r"!-/:-@\[-`{-~]+"
)
RATIOS = EVENTS + f""",
words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '{WORD_BREAK}'), lambda x: x <> '') AS w FROM documents),
doc_ratio AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN 1.0::DOUBLE
                      ELSE CAST(len(list_distinct(w)) AS DOUBLE) / CAST(len(w) AS DOUBLE) END AS ratio FROM words),
texts AS (
  SELECT e.event_id, e.person_id, e.ts_s, coalesce(r.ratio, 1.0::DOUBLE) AS ratio
  FROM e LEFT JOIN doc_ratio AS r USING (doc_id) WHERE e.kind <> 'like')"""


def _bucket(value: str, width: float, buckets: int) -> str:
    return f"least({buckets - 1}, greatest(0, CAST(ceil(({value}) / {width!r}::DOUBLE) AS BIGINT) - 1))"


def _threshold(buckets: int, width: float, cap: float, column: str = "u") -> str:
    total = f"{column}{buckets - 1}"
    whens = " ".join(
        f"WHEN {column}{b} > floor(5 * {total} / 100) THEN least({cap!r}::DOUBLE, {b + 1}.0::DOUBLE * {width!r}::DOUBLE)"
        for b in range(buckets)
    )
    return f"CASE WHEN {total} < 10 THEN {cap!r}::DOUBLE {whens} END"


def _running(source: str, deltas: list[tuple[str, str]], buckets: int, width: float, cap: float,
             order: str = "ts_s, event_id") -> str:
    """CTEs ``counted`` and ``scored`` over ``source`` in the order of time and event."""
    cums = []
    for b in range(buckets):
        gain = " + ".join(
            f"CASE WHEN {_bucket(v, width, buckets)} <= {b} THEN {w} ELSE 0 END" for v, w in deltas
        )
        cums.append(f"sum({gain}) OVER run AS u{b}")
    return f"""
counted AS (
  SELECT *, {', '.join(cums)} FROM {source}
  WINDOW run AS (ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
scored AS (SELECT *, {_threshold(buckets, width, cap)} AS threshold FROM counted)"""


_VOCABULARY = RATIOS + "," + _running("texts", [("ratio", "1")], 10, 0.1, 0.5)
_LOW_VOCABULARY = """
low_vocabulary AS (
  SELECT person_id, ts_s, ratio, threshold FROM scored WHERE ratio <= threshold
  QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY ts_s, event_id) = 1)"""

SAMPLE_BURST_WINDOW = 86_400
SAMPLE_BURST_CAP = 97.0


def _burst(prefix: str = "") -> str:
    counts = f""",
bursts AS (
  SELECT x.event_id, x.person_id, x.ts_s,
         (SELECT count(*) FROM e AS y WHERE y.person_id = x.person_id AND y.ts_s >= x.ts_s - {SAMPLE_BURST_WINDOW}
            AND (y.ts_s < x.ts_s OR (y.ts_s = x.ts_s AND y.event_id <= x.event_id))) AS n
  FROM e AS x),
entries AS (SELECT *, greatest(0, 100 - n) AS entry FROM bursts)"""
    return EVENTS + counts


_BURST = _burst() + "," + _running(
    "entries", [("entry", "1"), ("entry + 1", "CASE WHEN n > 1 THEN -1 ELSE 0 END")], 20, 5.0, SAMPLE_BURST_CAP
)
_BURST_FLAGS = """
burst AS (
  SELECT person_id, ts_s, entry, threshold FROM scored WHERE entry <= threshold
  QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY ts_s, event_id) = 1)"""


# Records carry no event id, so ties of time are broken by what a record says about itself;
# records that lead nowhere to begin with are unreadable and do not take part.
_RECORD_ORDER = (
    "ts_s, id NULLS FIRST, id_kind NULLS FIRST, person_id, parent_kind NULLS FIRST, parent_id NULLS FIRST"
)
_RECORDS = EVENTS + """,
r AS (SELECT *, row_number() OVER (ORDER BY """ + _RECORD_ORDER + """, event_id) AS seq
      FROM e WHERE kind = 'post' OR parent_id IS NOT NULL),"""
_STREAM_SPAM = _RECORDS + RATIOS[len(EVENTS) + 1:RATIOS.index("texts AS")] + """
texts AS (
  SELECT r.seq AS event_id, r.person_id, r.ts_s, coalesce(q.ratio, 1.0::DOUBLE) AS ratio
  FROM r LEFT JOIN doc_ratio AS q USING (doc_id) WHERE r.kind <> 'like')""" + "," + _running(
    "texts", [("ratio", "1")], 10, 0.1, 0.5
).replace("counted", "counted_v").replace("scored", "scored_v") + "," + _LOW_VOCABULARY.replace(
    "scored", "scored_v"
) + f""",
bursts AS (
  SELECT x.seq AS event_id, x.person_id, x.ts_s,
         (SELECT count(*) FROM r AS y WHERE y.person_id = x.person_id AND y.ts_s >= x.ts_s - {SAMPLE_BURST_WINDOW}
            AND y.seq <= x.seq) AS n
  FROM r AS x),
entries AS (SELECT *, greatest(0, 100 - n) AS entry FROM bursts)""" + "," + _running(
    "entries", [("entry", "1"), ("entry + 1", "CASE WHEN n > 1 THEN -1 ELSE 0 END")], 20, 5.0, SAMPLE_BURST_CAP
) + "," + _BURST_FLAGS


def _with(ctes: str, body: str) -> str:
    return f"WITH RECURSIVE {ctes}\n{body}"


ACTIVE_POSTS = _with(TREES + "," + _CLOSED, """
SELECT a.origin + a.w * a.tick AS notify_ts, a.post_id,
       count(*) FILTER (r.kind = 'comment') AS num_comments, count(*) FILTER (r.kind = 'reply') AS num_replies,
       count(DISTINCT r.person_id) AS num_people
FROM active AS a JOIN slotted AS r ON r.post_id = a.post_id AND r.k <= a.tick GROUP BY 1, 2""")

ACTIVE_POSTS_PEOPLE = _with(TREES + "," + _CLOSED, """
SELECT DISTINCT a.origin + a.w * a.tick AS notify_ts, a.post_id, r.person_id
FROM active AS a JOIN slotted AS r ON r.post_id = a.post_id AND r.k <= a.tick""")

RECOMMENDATIONS = _with(DYNAMIC, f"""
SELECT notify_ts, person_id, rank, candidate_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY notify_ts, person_id ORDER BY score DESC, candidate_id) AS rank FROM (
    SELECT t.notify_ts, s.person_id, s.candidate_id,
           s.score + coalesce(p.points, 0)
           + CASE WHEN s.person_id = s.candidate_id THEN 0 ELSE coalesce(a.activity, 0) END AS score
    FROM static_scores AS s CROSS JOIN ticks AS t
    LEFT JOIN personal AS p ON p.notify_ts = t.notify_ts AND p.person_id = s.person_id AND p.candidate_id = s.candidate_id
    LEFT JOIN activity AS a ON a.notify_ts = t.notify_ts AND a.candidate_id = s.candidate_id) AS x) AS y
WHERE rank <= {RECOMMEND_SIZE}""")


SNAPSHOT = """
WITH b AS (SELECT min(epoch_us(ts) // 1000000) AS origin, max(epoch_us(ts) // 1000000) AS until FROM events),
ticks AS (SELECT origin + 21600 * unnest(range(1, 1 + CAST(ceil((until - origin) / 21600) AS BIGINT))) AS notify_ts FROM b)
SELECT notify_ts, event_type, count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
       min(user_id) AS lowest_user, max(epoch_us(ts) // 1000000) AS last_ts
FROM events JOIN ticks ON epoch_us(ts) // 1000000 <= notify_ts GROUP BY 1, 2"""

SLIDING = """
WITH b AS (SELECT min(epoch_us(ts) // 1000000) AS origin, max(epoch_us(ts) // 1000000) AS until FROM events),
ticks AS (SELECT origin + 3600 * unnest(range(1, 1 + CAST(ceil((until - origin) / 3600) AS BIGINT))) AS notify_ts FROM b)
SELECT notify_ts, user_id, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events JOIN ticks ON epoch_us(ts) // 1000000 <= notify_ts AND epoch_us(ts) // 1000000 > notify_ts - 14400 GROUP BY 1, 2"""

# What a record says, and the records that can't be read.
_RECORD_ROWS = """
SELECT kind, id_kind, id, person_id, ts_s, parent_kind, parent_id, forum_id,
       CASE WHEN kind = 'post' THEN concat('[', tag_key % 20, ', ', tag_key % 7, ']') END AS tags,
       CASE WHEN kind <> 'like' THEN md5(coalesce(text, '')) END AS content_md5ARRIVAL
FROM e LEFT JOIN documents USING (doc_id) WHERE kind = 'post' OR parent_id IS NOT NULL
UNION ALL
SELECT 'malformed', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULLARRIVAL
FROM e WHERE kind <> 'post' AND parent_id IS NULL"""


def _active_until_quiet() -> str:
    """The statistics with ticks going on until every post has gone quiet."""
    stop = f"ceil((until - origin) / {ACTIVE_POSTS_EVERY})"
    assert stop in ACTIVE_POSTS
    return ACTIVE_POSTS.replace(stop, f"ceil((until + {ACTIVE_POSTS_HORIZON} - origin) / {ACTIVE_POSTS_EVERY})")


def oracle_sql() -> dict[str, str]:
    return {
        "stream_post_trees": _with(TREES, "SELECT kind, post_id, person_id, ts_s, author_id FROM resolved"),
        "stream_active_posts": _active_until_quiet(),
        "stream_friend_recommendations": RECOMMENDATIONS,
        "stream_spammers": _with(_STREAM_SPAM, """
SELECT 'burst' AS detector, person_id, ts_s, CAST(entry AS DOUBLE) AS value, threshold FROM burst
UNION ALL SELECT 'low_vocabulary', person_id, ts_s, ratio, threshold FROM low_vocabulary"""),
        "parse_events": _with(EVENTS, _RECORD_ROWS.replace("ARRIVAL", "")),
        "event_files": _with(EVENTS, _RECORD_ROWS.replace("text, ''", "translate(text, chr(10) || chr(13), '  '), ''").replace("ARRIVAL", "")),
        "event_files_with_arrival": _with(EVENTS, _RECORD_ROWS.replace("text, ''", "translate(text, chr(10) || chr(13), '  '), ''").replace(
            "ARRIVAL", ", ts_s + event_id % 600 AS arrival_s")),
        "records_with_bad_bytes": _with(EVENTS, """
SELECT CASE WHEN event_id % 100 = 3 OR (kind <> 'post' AND parent_id IS NULL) THEN 'malformed' ELSE kind END AS kind,
       event_id, CASE WHEN event_id % 100 <> 3 AND (kind = 'post' OR parent_id IS NOT NULL) THEN person_id END AS person_id,
       event_id % 100 = 3 AS bad_bytes, event_id % 100 = 3 OR (kind <> 'post' AND parent_id IS NULL) AS kept_raw
FROM e"""),
        "static_tables": _with(STATIC, """
SELECT 'person_knows_person' AS name, person_id1 AS a, person_id2 AS b, NULL::BIGINT AS c FROM knows
UNION ALL SELECT 'person_workAt_organisation', o_custkey, l_partkey, min(year(l_shipdate)) FROM bought GROUP BY 2, 3
UNION ALL SELECT 'person_studyAt_organisation', person_id, organisation_id, NULL FROM study
UNION ALL SELECT 'forum_has_member', forum_id, person_id, epoch(join_date::TIMESTAMP)::BIGINT FROM forum_members"""),
        "stream_late_expiry": _with(
            TREES.replace("FROM e WHERE kind = 'comment' AND parent_id IS NOT NULL", "FROM e WHERE kind = 'comment' AND parent_id IS NOT NULL AND event_id % 7 <> 0"),
            "SELECT kind, post_id, person_id, ts_s, author_id FROM resolved"),
        "stream_likes": _with(TREES, """
SELECT post_id, person_id, ts_s, author_id FROM attached WHERE kind = 'like'"""),
        "stream_snapshot": SNAPSHOT,
        "stream_sliding_sum": SLIDING,
        "classify_engagement": _with(EVENTS, """
SELECT event_id, kind, id_kind, id, person_id, ts_s, coalesce(parent_kind, 'post') AS target_kind,
       CASE WHEN kind = 'post' THEN event_id ELSE parent_id END AS target_id FROM e"""),
        "resolve_likes": _with(TREES, """
SELECT post_id, person_id, ts_s, author_id FROM attached WHERE kind = 'like'"""),
        "post_roots": _with(TREES, """
SELECT event_id, kind, post_id, author_id FROM attached WHERE kind <> 'like'"""),
        "post_roots_recursive": _with(TREES, """
SELECT event_id, kind, post_id, author_id FROM attached WHERE kind <> 'like'"""),
        "engagement_totals": _with(TREES, """
SELECT post_id, count(*) FILTER (kind = 'comment') AS num_comments, count(*) FILTER (kind = 'reply') AS num_replies,
       count(*) FILTER (kind = 'like') AS num_likes, count(DISTINCT person_id) AS num_people, max(ts_s) AS last_ts
FROM resolved GROUP BY 1"""),
        "active_posts": ACTIVE_POSTS,
        "active_posts_approx": ACTIVE_POSTS,
        "active_posts_people": ACTIVE_POSTS_PEOPLE,
        "friends": _with(STATIC, "SELECT person_id, friend_id FROM friends"),
        "in_degree": _with(STATIC, "SELECT person_id2 AS candidate_id, count(*) AS count FROM knows GROUP BY 1"),
        "non_friends": _with(STATIC, "SELECT person_id, candidate_id, count FROM non_friends"),
        "common_friends": _with(STATIC, "SELECT person_id, candidate_id, count FROM common_friends"),
        "shared_work": _with(STATIC, "SELECT person_id, candidate_id, count FROM shared_work"),
        "shared_study": _with(STATIC, "SELECT person_id, candidate_id, count FROM shared_study"),
        "client_forums": _with(STATIC, """
SELECT DISTINCT person_id, forum_id FROM forum_members JOIN clients USING (person_id)"""),
        "forums_per_person": _with(STATIC, """
SELECT person_id, count(DISTINCT forum_id) AS c FROM forum_members GROUP BY 1 ORDER BY c DESC, person_id"""),
        "static_scores": _with(STATIC, "SELECT person_id, candidate_id, score FROM static_scores"),
        "interaction_affinity": _with(DYNAMIC, """
SELECT person_id, candidate_id, ts_s, CAST(points AS BIGINT) AS points FROM interactions"""),
        "tag_affinity": _with(DYNAMIC, """
SELECT person_id, candidate_id, ts_s, CAST(points AS BIGINT) AS points FROM tag_points"""),
        "forum_affinity": _with(DYNAMIC, """
SELECT person_id, candidate_id, ts_s, CAST(points AS BIGINT) AS points FROM forum_points"""),
        "activity_scores": _with(DYNAMIC, "SELECT notify_ts, candidate_id, activity FROM activity"),
        "dynamic_scores": _with(DYNAMIC, """
SELECT p.notify_ts, p.person_id, p.candidate_id, p.points,
       CAST(CASE WHEN p.person_id = p.candidate_id THEN 0 ELSE coalesce(a.activity, 0) END AS BIGINT) AS activity
FROM personal AS p LEFT JOIN activity AS a USING (notify_ts, candidate_id)"""),
        "friend_recommendations": RECOMMENDATIONS,
        "all_common_friends": _for_everybody(_with(STATIC, "SELECT person_id, candidate_id, count FROM common_friends")),
        "all_recommendations": _for_everybody(RECOMMENDATIONS),
        "unique_word_ratio": _with(RATIOS, "SELECT event_id, person_id, ts_s, ratio FROM texts"),
        "vocabulary_histogram": _with(RATIOS, f"""
SELECT bucket, count, CAST(sum(count) OVER (ORDER BY bucket) AS BIGINT) AS upto FROM (
  SELECT CAST({_bucket('ratio', 0.1, 10)} AS INTEGER) AS bucket, count(*) AS count FROM texts GROUP BY 1) AS h"""),
        "vocabulary_threshold": _with(RATIOS + f""",
totals AS (SELECT {', '.join(f"count(*) FILTER ({_bucket('ratio', 0.1, 10)} <= {b}) AS u{b}" for b in range(10))} FROM texts)""",
            f"SELECT u9 AS total, {_threshold(10, 0.1, 0.5)} AS threshold FROM totals"),
        "running_vocabulary_threshold": _with(_VOCABULARY, "SELECT event_id, person_id, ts_s, ratio, threshold FROM scored"),
        "low_vocabulary_spam": _with(_VOCABULARY + "," + _LOW_VOCABULARY, "SELECT person_id, ts_s, ratio, threshold FROM low_vocabulary"),
        "burst_counts": _with(_burst(), "SELECT event_id, person_id, ts_s, n FROM bursts"),
        "burst_spam": _with(_BURST + "," + _BURST_FLAGS, "SELECT person_id, ts_s, CAST(entry AS BIGINT) AS entry, threshold FROM burst"),
        "spammers": _with(
            _VOCABULARY.replace("counted", "counted_v").replace("scored", "scored_v")
            + "," + _LOW_VOCABULARY.replace("scored", "scored_v")
            + _BURST[len(EVENTS):] + "," + _BURST_FLAGS,
            """
SELECT 'burst' AS detector, person_id, ts_s FROM burst
UNION ALL SELECT 'low_vocabulary', person_id, ts_s FROM low_vocabulary"""),
        "periodic_snapshot": SNAPSHOT,
        "sliding_sum": SLIDING,
    }

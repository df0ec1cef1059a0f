import random

import pytest

from crowdpulse.operators import trees
from crowdpulse.plans import api
from scenarios import NESTED, SHARED_IDS, SHORT, WAKES_UP, at, comment, events, june, like, post, reply


def stats(spark, lines, **kw):
    people = {}
    ev = events(spark, lines)
    for r in api.active_posts_people(ev, **kw).collect():
        people.setdefault((r.notify_ts, r.post_id), set()).add(r.person_id)
    out = {}
    for r in api.active_posts(ev, **kw).collect():
        key = (r.notify_ts, r.post_id)
        assert r.num_people == len(people[key])
        out.setdefault(r.notify_ts, {})[r.post_id] = (r.num_comments, r.num_replies, people[key])
    assert {k for k in people} == {(t, p) for t in out for p in out[t]}
    return out


def test_short_golden(spark):
    got = stats(spark, SHORT, until=at("02:35"))
    assert got == {
        1554165300: {100: (3, 2, {0, 1, 2}), 101: (0, 0, {1})},
        1554167100: {100: (3, 2, {0, 1, 2}), 101: (1, 0, {1})},
        1554168900: {100: (3, 2, {0, 1, 2}), 101: (1, 0, {1})},
        1554170700: {100: (3, 3, {0, 1, 2}), 101: (2, 0, {0, 1, 3})},
        1554172500: {100: (3, 4, {0, 1, 2}), 101: (2, 0, {0, 1, 3})},
    }


def test_a_thread_wakes_up_and_goes_quiet(spark):
    got = stats(spark, WAKES_UP, until=june("23:00"))
    assert got[june("06:30")] == {7: (1, 0, {31, 33})}
    assert got[june("07:00")] == {7: (2, 0, {31, 32, 33})}
    assert got[june("07:30")] == got[june("09:30")] == {7: (2, 0, {31, 32, 33, 34})}
    assert got[june("10:00")] == {7: (2, 1, {31, 32, 33, 34}), 8: (1, 0, {31, 32})}
    assert got[june("10:30")] == got[june("21:30")] == {7: (2, 1, {31, 32, 33, 34}), 8: (1, 2, {31, 32, 35})}
    assert got[june("22:00")] == {8: (1, 2, {31, 32, 35})}
    assert june("22:30") not in got


def test_nested_replies(spark):
    got = stats(spark, NESTED, until=june("15:00"))
    everyone = {51, 52, 53, 54}
    assert got[june("00:40")] == {41: (2, 3, everyone)}
    assert got[june("01:10")] == got[june("02:10")] == {41: (2, 3, everyone), 42: (1, 0, {51, 52})}
    assert got[june("02:40")] == got[june("14:10")] == {41: (2, 4, everyone), 42: (2, 1, everyone | {55})}
    assert june("14:40") not in got


def test_shared_ids(spark):
    got = stats(spark, SHARED_IDS, until=june("21:00"))
    assert got[june("08:30")] == got[june("20:00")] == {5: (1, 1, {71, 74}), 6: (1, 1, {72, 73})}
    assert june("20:30") not in got


def test_late_answer_revives_a_post(spark):
    lines = [post(1, 1, "00:00"), comment(2, 2, "13:00", 1)]
    got = stats(spark, lines, every=3600, horizon=7200, until=at("16:00"))
    assert sorted((t - at("00:00")) // 3600 for t in got) == [1, 2, 13, 14, 15]
    assert got[at("15:00")] == {1: (1, 0, {1, 2})}


def test_deep_chain_circle_orphans_and_age(spark):
    chain = [post(1, 1, "00:00"), comment(1, 2, "00:01", 1)]
    chain += [reply(i, 3, "00:02", i - 1) for i in range(2, 201)]
    odd = [
        reply(900, 4, "00:03", 901), reply(901, 4, "00:03", 900),       # a circle
        reply(910, 4, "00:03", 9999), reply(911, 4, "00:04", 910),      # nobody wrote 9999
        comment(920, 4, "00:03", 777), reply(921, 4, "00:03", 920),     # post 777 never came
        like(5, 777, "00:03"),
        comment(930, 6, "00:00", 1), reply(931, 6, "00:05", 930),       # fine
        reply(940, 7, "00:00", 1), reply(941, 7, "00:05", 940),         # 940 is older than what it answers
        comment(950, 8, "00:06", 1), comment(950, 8, "00:07", 1),       # a repeated id counts twice
    ]
    resolved = trees.post_trees(events(spark, chain + odd), ("id",)).collect()
    ids = sorted(r.id for r in resolved if r.kind in ("comment", "reply"))
    assert ids == sorted([*range(1, 201), 930, 931, 941, 950, 950])
    assert {r.post_id for r in resolved} == {1} and {r.author_id for r in resolved} == {1}
    assert not [r for r in resolved if r.kind == "like"]


def test_random_forest_against_walking(spark):
    rng = random.Random(7)
    lines, parent, kind = [], {}, {}
    for i in range(400):
        hhmm = f"{rng.randrange(24):02d}:{rng.randrange(60):02d}"
        roll = rng.random()
        if roll < 0.1:
            lines.append(post(i, i, hhmm)); kind[i] = ("post", hhmm)
        elif roll < 0.4:
            p = rng.randrange(400); lines.append(comment(i, i, hhmm, p)); parent[i] = ("post", p); kind[i] = ("comment", hhmm)
        else:
            p = rng.randrange(400); lines.append(reply(i, i, hhmm, p)); parent[i] = ("comment", p); kind[i] = ("comment", hhmm)
    posts = {i: t for i, (k, t) in kind.items() if k == "post"}
    comments = {i: t for i, (k, t) in kind.items() if k == "comment"}

    def root(i):
        seen = set()
        while i not in seen:
            seen.add(i)
            k, p = parent[i]
            if k == "post":
                return p if p in posts else None
            if p not in comments:
                return None
            i = p
        return None

    expected = sorted(
        (i, root(i)) for i, t in comments.items()
        if root(i) is not None and t >= (posts if parent[i][0] == "post" else comments)[parent[i][1]]
    )
    got = trees.post_trees(events(spark, lines), ("id",)).filter("kind <> 'post'").collect()
    assert sorted((r.id, r.post_id) for r in got) == expected


def test_empty_input(spark):
    nothing = events(spark, ["WATERMARK|5"])
    assert api.active_posts(nothing).count() == 0
    assert trees.post_trees(nothing).count() == 0


def test_roots_by_a_recursive_query(spark):
    lines = [post(1, 10, "00:05"), comment(100, 11, "00:06", 1)] + [reply(101 + i, 12 + i, "00:07", 100 + i) for i in range(30)]
    lines += [reply(500, 1, "00:09", 501), reply(501, 2, "00:09", 500), reply(600, 3, "00:10", 999)]  # a circle and an orphan
    df = events(spark, lines)
    rows = lambda d: sorted(map(tuple, d.select("kind", "post_id", "person_id", "ts_s", "author_id", "parent_author").collect()))
    assert rows(trees.post_trees(df, roots=trees.recursive_comment_roots)) == rows(trees.post_trees(df))
    deep = events(spark, [post(1, 10, "00:05"), comment(100, 11, "00:06", 1)] + [reply(101 + i, 12, "00:07", 100 + i) for i in range(150)])
    assert trees.post_trees(deep).count() == 152
    with pytest.raises(Exception, match="RECURSION_LEVEL_LIMIT_EXCEEDED"):
        trees.post_trees(deep, roots=trees.recursive_comment_roots).count()


def test_people_by_sketches(spark):
    """Against the exact count within four standard errors, without a row for each post and person."""
    from pyspark.sql import functions as F

    from crowdpulse.operators import active_posts as active

    people = spark.range(40_000).select(
        F.lit("like").alias("kind"), (F.col("id") % 4).alias("post_id"), (F.col("id") * 7919 % 9_973).alias("person_id"), (F.col("id") % 20_000).alias("ts_s")
    )
    args = (1800, 43_200, 0, 20_000)
    approx = active.active_posts(people, *args, people="approx")
    both = active.active_posts(people, *args).alias("e").join(approx.alias("a"), ["notify_ts", "post_id"], "full")
    off = both.select(F.max(F.abs(F.col("e.num_people") - F.col("a.num_people")) / F.col("e.num_people"))).first()[0]
    assert off is not None and off <= 4 * 1.04 / 2**6 and both.filter("a.num_people is null or e.num_people is null").count() == 0
    plan = approx._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate [post_id" in plan and "Aggregate [post_id#" in plan and ", person_id" not in plan.split("Aggregate [post_id")[1].split("]")[0]
    with pytest.raises(ValueError):
        active.active_posts(people, *args, people="some")

"""The streams must say what the batch jobs say, whatever the order of arrival within the bound."""

import random

import pytest

from crowdpulse.operators import trees
from crowdpulse.plans import api
from crowdpulse.sources.wire import parse_events, read_text_stream
from crowdpulse.streaming import (
    ActivePostsStream,
    RecommendationStream,
    SpamStream,
    ThreadStream,
    write_stream,
)
from crowdpulse.streaming.tables import BatchTables
from scenarios import (
    BOATS_ORIGIN, CHANTS, FLOOD, SHORT, TWO_OWNERS, WAKES_UP, at, comment, events, june, like, on_june, post, reply,
)

FAR = "WATERMARK|1554400000"


def drop(folder, batches):
    """One file per batch, in order of modification."""
    import os

    folder.mkdir(exist_ok=True)
    for i, lines in enumerate(batches):
        f = folder / f"part-{i:04d}.txt"
        f.write_text("\n".join(lines) + "\n")
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def disordered(lines, seed, bound=600):
    """Arrival order under a delay of less than ``bound`` seconds per event."""
    rng = random.Random(seed)

    def when(line):
        field = line.split("|")[2]
        import datetime as dt

        stamp = dt.datetime.fromisoformat(field.replace("Z", "+00:00")).timestamp()
        return stamp + rng.random() * (bound - 1)

    return sorted(lines, key=when)


def batches(lines, size, *tail):
    return [lines[i:i + size] for i in range(0, len(lines), size)] + [[t] for t in tail]


def run_threads(spark, tmp_path, parts, **kw):
    source = drop(tmp_path / "in", parts)
    threads = ThreadStream(spark, str(tmp_path / "threads"), **kw)
    parsed = parse_events(read_text_stream(spark, source, 1))
    threads.start(parsed, str(tmp_path / "cp-threads")).awaitTermination()
    return threads


def resolved_rows(df):
    return sorted(
        (r.kind, r.post_id, r.person_id, r.ts_s, r.author_id, r.parent_author) for r in df.collect()
    )


def network(seed):
    rng = random.Random(seed)
    lines, nodes = [], []
    for i in range(60):
        minute = 5 + i * 4
        hhmm = f"{minute // 60:02d}:{minute % 60:02d}"
        roll = rng.random()
        if roll < 0.25 or not nodes:
            lines.append(post(i, i % 7, hhmm)); nodes.append(("post", i))
        else:
            kind, target = rng.choice(nodes[-8:])
            if kind == "post" and roll < 0.4:
                lines.append(like(i % 7, target, hhmm))
            elif kind == "post":
                lines.append(comment(i, i % 7, hhmm, target)); nodes.append(("comment", i))
            else:
                lines.append(reply(i, i % 7, hhmm, target)); nodes.append(("comment", i))
    return lines


@pytest.mark.parametrize("seed", [1, 2])
def test_threads_under_disorder(spark, tmp_path, seed):
    lines = network(seed)
    threads = run_threads(spark, tmp_path, batches(disordered(lines, seed), 15))
    assert resolved_rows(threads.resolved(spark)) == resolved_rows(trees.post_trees(events(spark, lines)))


def test_threads_in_given_arrival_order_expire_and_repeat(spark, tmp_path):
    lines = SHORT + [reply(999, 1, "02:12", 12345)]
    threads = run_threads(spark, tmp_path, batches(lines, 3, "WATERMARK|1554176000"))
    assert resolved_rows(threads.resolved(spark)) == resolved_rows(trees.post_trees(events(spark, SHORT)))
    last = len(batches(lines, 3)) - 1
    waiting = threads.tables.previous(spark, "waiting", last + 1)
    assert [r.id for r in waiting.collect()] == [999]
    assert threads.tables.previous(spark, "waiting", last + 2).count() == 0  # punctuation alone expired it
    # A batch that is run again changes nothing.
    before = resolved_rows(threads.resolved(spark))
    threads(parse_events(spark.createDataFrame([(SHORT[0],)], "value string")), 0)
    assert resolved_rows(threads.resolved(spark)) == before


@pytest.mark.parametrize("size", [3, 50])
def test_active_posts_stream(spark, tmp_path, size):
    lines = disordered(SHORT, 3) if size == 50 else SHORT
    threads = ThreadStream(spark, str(tmp_path / "threads"), origin=at("00:05"))
    service = ActivePostsStream(spark, str(tmp_path / "active"), threads)
    for number, part in enumerate(batches(lines, size, "WATERMARK|1554178000", FAR)):
        threads(parse_events(spark.createDataFrame([(x,) for x in part], "value string")), number)
        if size == 50 or number % 2:  # the service need not run in step
            service(spark.range(0), number if size == 50 else number // 2)
    service(spark.range(0), number + 1 if size == 50 else (number + 1) // 2)
    got = sorted(tuple(r) for r in service.reports(spark).collect())
    expected = api.active_posts(events(spark, SHORT), until=at("23:00"))
    assert got == sorted(tuple(r) for r in expected.collect())
    assert len(got) > 40


def test_active_posts_stream_stopped_between_writes(spark, tmp_path, monkeypatch):
    """A post rests, wakes up and is met by a known and a new person; the service is stopped before
    each of its writes and started again while the threads go on."""
    lines = by_time([x for x in WAKES_UP if "|7|" in x or x.startswith(("7|", "3|"))] + [on_june(comment, 9, 33, "23:10", 7), on_june(comment, 10, 36, "23:20", 7)])
    threads = ThreadStream(spark, str(tmp_path / "threads"), origin=june("06:00"))
    service = ActivePostsStream(spark, str(tmp_path / "active"), threads)
    parts = [lines[:3], lines[3:-2], [f"WATERMARK|{june('22:50') + 700}"], lines[-2:], [f"WATERMARK|{june('23:59') + 60 * 60 * 13}"]]
    for number, part in enumerate(parts):
        threads(parse_events(spark.createDataFrame([(x,) for x in part], "value string")), number)
        with monkeypatch.context() as m:
            stop_before(service.tables, m, number)
            try:
                service(spark.range(0), number)
            except Stop:
                pass
        service(spark.range(0), number)
    got = sorted(tuple(r) for r in service.reports(spark).collect())
    expected = api.active_posts(events(spark, lines), until=june("23:59") + 12 * 3600)
    assert got == sorted(tuple(r) for r in expected.collect())
    assert {r[2:] for r in got} >= {(2, 1, 4), (4, 1, 5)}


def test_a_trigger_reads_few_folders(spark, tmp_path):
    """Fifty batches are a handful of blocks, also when one of these is missing."""
    tables = BatchTables(spark, str(tmp_path / "t"), {"rows": "n bigint"})
    most = 0
    for i in range(50):
        tables.write("rows", spark.range(i, i + 1).selectExpr("id as n"), i)
        tables.compact(spark, ("rows",), i)
        if i % 7 == 0 or i == 49:
            rows = tables.earlier(spark, "rows", i + 1)
            most = max(most, len({f.rsplit("/", 1)[0] for f in rows.inputFiles()}))
            assert sorted(r.n for r in rows.collect()) == list(range(i + 1))
            assert tables.last(spark, "rows") == i
    assert most <= 14
    (tmp_path / "t" / "rows_blocks" / "8-15" / "_SUCCESS").rename(tmp_path / "unfinished")
    assert sorted(r.n for r in tables.everything(spark, "rows").collect()) == list(range(50))


def recommendation_tables(spark):
    return {
        "person_knows_person": spark.createDataFrame([(1, 61), (1, 62), (2, 7), (640, 2)], "person_id1 long, person_id2 long"),
        "person_workAt_organisation": spark.createDataFrame([(640, 1, None), (7, 1, None)], "person_id long, organisation_id long, works_from int"),
        "person_studyAt_organisation": spark.createDataFrame([], "person_id long, organisation_id long, class_year int"),
        "forum_has_member": spark.createDataFrame([(77, 640, None)], "forum_id long, person_id long, join_date timestamp"),
    }


def by_time(lines):
    return sorted(lines, key=lambda x: x.split("|")[2])


def served(service, spark):
    return sorted(tuple(r) for r in service.result(spark).collect())


def test_recommendation_stream(spark, tmp_path):
    static = recommendation_tables(spark)
    threads = run_threads(spark, tmp_path, batches(by_time(TWO_OWNERS), 3, "WATERMARK|1623960000"))
    service = RecommendationStream(spark, str(tmp_path / "recs"), threads, static, BOATS_ORIGIN, clients=[640])
    (
        threads.complete(spark).writeStream.foreachBatch(service)
        .option("checkpointLocation", str(tmp_path / "cp-recs")).trigger(availableNow=True).start().awaitTermination()
    )
    got = served(service, spark)
    last = max(r[0] for r in got)
    expected = api.friend_recommendations(events(spark, TWO_OWNERS), static, [640], origin=BOATS_ORIGIN, until=last)
    assert got == sorted(tuple(r) for r in expected.collect())


class Stop(Exception):
    pass


def stop_before(tables, monkeypatch, number):
    """Let the next ``number`` writes of a stream pass and stop it at the one after."""
    write, left = type(tables).write, [number]

    def once(name, df, batch_id):
        if not tables.done(df.sparkSession, name, batch_id):
            if not left[0]:
                raise Stop
            left[0] -= 1
        write(tables, name, df, batch_id)

    monkeypatch.setattr(tables, "write", once)


def test_recommendations_between_any_two_writes(spark, tmp_path, monkeypatch):
    """The thread stream is stopped before each of its writes in turn and the service is run there;
    the service is stopped before each of its own, while the threads go on."""
    static = recommendation_tables(spark)
    lines = by_time(TWO_OWNERS[:2] + TWO_OWNERS[3:])
    parts = [parse_events(spark.createDataFrame([(x,) for x in part], "value string")) for part in (lines[:4], lines[4:], ["WATERMARK|1623785000"])]
    threads = ThreadStream(spark, str(tmp_path / "threads"))
    service = RecommendationStream(spark, str(tmp_path / "recs"), threads, static, BOATS_ORIGIN, clients=[640])
    trigger = 0
    for number, part in enumerate(parts):
        for writes in range(6 if number == 1 else 1):
            if number == 1:  # nodes, posts, waiting, resolved, progress
                with monkeypatch.context() as m:
                    stop_before(threads.tables, m, 1 if writes else 0)
                    try:
                        threads(part, number)
                    except Stop:
                        pass
            else:
                threads(part, number)
            service(spark.range(0), trigger)
            trigger += 1
    for writes in range(3):  # served, first_use, recommendations
        with monkeypatch.context() as m:
            stop_before(service.tables, m, writes and 1)
            try:
                service(spark.range(0), trigger)
            except Stop:
                pass
        threads(parse_events(spark.createDataFrame([(f"WATERMARK|{1623790000 + 4000 * writes}",)], "value string")), 3 + writes)
    service(spark.range(0), trigger)
    service(spark.range(0), trigger + 1)
    got = served(service, spark)
    assert len(got) == len({r[:3] for r in got})
    last = max(r[0] for r in got)
    assert last >= BOATS_ORIGIN + 3600 * ((1623798000 - 600 - BOATS_ORIGIN) // 3600)
    expected = api.friend_recommendations(events(spark, lines), static, [640], origin=BOATS_ORIGIN, until=last)
    assert got == sorted(tuple(r) for r in expected.collect())


def test_sinks(spark, tmp_path):
    source = drop(tmp_path / "in", [SHORT[:4], SHORT[4:]])
    parsed = parse_events(read_text_stream(spark, source)).select("kind", "person_id")
    write_stream(parsed, "memory", "short_events", str(tmp_path / "cp-m")).awaitTermination()
    assert spark.table("short_events").count() == len(SHORT)
    write_stream(parsed, "console", None, str(tmp_path / "cp-c")).awaitTermination()


@pytest.mark.parametrize("lines, size", [(FLOOD, 20), (CHANTS, 24)])
def test_spam_stream(spark, tmp_path, lines, size):
    ordered = disordered(lines, 5)
    source = drop(tmp_path / "in", batches(ordered, size, "WATERMARK|1624000000"))
    spammers = SpamStream(spark, str(tmp_path / "spam"))
    spammers.start(parse_events(read_text_stream(spark, source, 1)), str(tmp_path / "cp")).awaitTermination()
    got = sorted((r.detector, r.person_id, r.ts_s, r.threshold) for r in spammers.flags(spark).collect())
    ev = events(spark, lines)
    expected = sorted(
        [("burst", r.person_id, r.ts_s, r.threshold) for r in api.burst_spam(ev).collect()]
        + [("low_vocabulary", r.person_id, r.ts_s, r.threshold) for r in api.low_vocabulary_spam(ev).collect()]
    )
    assert got == expected and got

"""Streams on the engine's event time against the batch operators, for any arrival within the bound."""

import random

import pytest
from pyspark.sql import functions as F

from crowdpulse.operators import trees
from crowdpulse.operators.timegrid import Running, periodic_snapshot, sliding_sum
from crowdpulse.sources.wire import parse_events
from crowdpulse.streaming import event_time as engine
from scenarios import comment, events, like, post

SCHEMA = "kind string, ts_s long, who string, v long"
AGGS = [Running("n", "count"), Running("total", "sum", "v"), Running("low", "min", "v"), Running("last_ts", "max", "ts_s")]
ORIGIN, EVERY, UNTIL = 1000, 600, 9999
LAST = ORIGIN + 15 * EVERY


def numbers(seed, n=200):
    rng = random.Random(seed)
    rows = [("event", ORIGIN + rng.randrange(9000), rng.choice("abc"), rng.choice([None, rng.randrange(100)])) for _ in range(n)]
    rows += [("event", ORIGIN, "edge", 1), ("event", ORIGIN + EVERY, "edge", 2), ("event", ORIGIN + EVERY + 1, "edge", 3), ("event", UNTIL, "late", 5)]
    return rows, sorted(rows, key=lambda r: r[1] + rng.random() * 590)


class Source:
    """A folder that rows are added to, read in files one by one."""

    def __init__(self, spark, folder, schema):
        folder.mkdir()
        self.spark, self.folder, self.schema = spark, str(folder), schema

    def add(self, rows, parts=1):
        size = -(-len(rows) // parts)
        for at in range(0, len(rows), size):
            self.spark.createDataFrame(rows[at : at + size], self.schema).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.folder)


def run(stream, folder):
    """Run over what there is; returns the progress of the query's batches."""
    query = (
        stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/cp")
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query.recentProgress


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def streams(spark):
    """A session with few state partitions."""
    session = spark.newSession()
    session.conf.set("spark.sql.shuffle.partitions", "2")
    session.conf.set("spark.sql.session.timeZone", "UTC")
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    )
    return session


def test_snapshots_and_sliding_sums_under_disorder(streams, tmp_path):
    rows, arrival = numbers(1)
    source = Source(streams, tmp_path / "in", SCHEMA)
    timed = engine.event_time(source.stream())
    snapshot = engine.stream_snapshot(timed, ["who"], AGGS, EVERY, ORIGIN)
    slide = engine.stream_sliding_sum(engine.event_time(source.stream()), ["who"], {"total": "v"}, EVERY, 4 * EVERY, ORIGIN)
    # Stopped and started again in the middle, and once more for a mark of time alone.
    for part in (arrival[:90], arrival[90:], [("watermark", LAST + 601, None, None)]):
        source.add(part, 2)
        run(snapshot, tmp_path / "snapshot")
        progress = run(slide, tmp_path / "slide")
    batch = streams.createDataFrame(rows, SCHEMA)
    got = streams.read.parquet(str(tmp_path / "snapshot/out")).filter(F.col("notify_ts") <= LAST)
    assert rows_of(got) == rows_of(periodic_snapshot(batch, ["who"], AGGS, EVERY, ORIGIN, UNTIL))
    got = streams.read.parquet(str(tmp_path / "slide/out")).filter(F.col("notify_ts") <= LAST)
    assert rows_of(got) == rows_of(sliding_sum(batch, ["who"], {"total": "v"}, EVERY, 4 * EVERY, ORIGIN, UNTIL))
    # All windows are closed but the three that begin before the mark and end behind it.
    assert progress[-1]["stateOperators"][0]["numRowsTotal"] <= 3 * len({r[2] for r in rows})


def test_punctuation_alone_moves_the_watermark(streams, tmp_path):
    source = Source(streams, tmp_path / "in", SCHEMA)
    counts = engine.stream_slot_totals(engine.event_time(source.stream()), ["who"], [Running("n", "count")], EVERY, ORIGIN)
    source.add([("event", ORIGIN + 10, "a", 1), ("malformed", None, None, None)])
    run(counts, tmp_path / "q")
    assert streams.read.parquet(str(tmp_path / "q/out")).count() == 0
    # Nothing but a mark arrives: too early by a second, then late enough.
    source.add([("watermark", ORIGIN + EVERY + 600, None, None)])
    progress = run(counts, tmp_path / "q")
    assert progress[-1]["eventTime"]["watermark"] == "1970-01-01T00:26:40.000Z"
    assert streams.read.parquet(str(tmp_path / "q/out")).count() == 0
    source.add([("watermark", ORIGIN + EVERY + 601, None, None)])
    progress = run(counts, tmp_path / "q")
    assert max(p["eventTime"].get("watermark", "") for p in progress) == "1970-01-01T00:26:41.000Z"
    assert [(r["who"], r["notify_ts"], r["n"]) for r in streams.read.parquet(str(tmp_path / "q/out")).collect()] == [("a", ORIGIN + EVERY, 1)]
    # What comes after its slot was closed doesn't count.
    source.add([("event", ORIGIN + 20, "a", 1), ("watermark", ORIGIN + 9 * EVERY, None, None)])
    run(counts, tmp_path / "q")
    assert streams.read.parquet(str(tmp_path / "q/out")).count() == 1


def test_a_state_of_the_users_own(streams, tmp_path):
    """The three highest values so far and the number of slots seen, told at every tick."""
    rows, arrival = numbers(2, 80)
    rows = [r for r in rows if r[3] is not None]
    source = Source(streams, tmp_path / "in", SCHEMA)
    slots = engine.stream_slot_totals(engine.event_time(source.stream()), ["who"], [Running("high", "max", "v")], EVERY, ORIGIN)

    def on_input(state, new):
        best, seen = state or ([], 0)
        return sorted([*best, *(r["high"] for r in new)], reverse=True)[:3], seen + len(list(new))

    def on_notify(key, tick, state):
        if state[1] % 2 == 0:  # nothing is said after an odd number of slots
            yield {"who": key["who"], "best": state[0], "seen": state[1]}

    out = engine.window_notify(slots, ["who"], EVERY, "best array<bigint>, seen bigint", "who string, best array<bigint>, seen bigint", on_input, on_notify)
    source.add([r for r in arrival if r[3] is not None], 3)
    run(out, tmp_path / "q")
    source.add([("watermark", LAST + 601, None, None)])
    run(out, tmp_path / "q")
    slot = lambda ts: ORIGIN + -((ORIGIN - ts) // EVERY) * EVERY
    expected = []
    for who in {r[2] for r in rows}:
        highs = {}
        for _, ts, w, v in rows:
            if w == who:
                highs[slot(ts)] = max(highs.get(slot(ts), v), v)
        for tick in range(min(highs), LAST + 1, EVERY):
            seen = [v for t, v in highs.items() if t <= tick]
            if len(seen) % 2 == 0:
                expected.append((tick, who, sorted(seen, reverse=True)[:3], len(seen)))
    got = streams.read.parquet(str(tmp_path / "q/out")).filter(F.col("notify_ts") <= LAST)
    assert rows_of(got) == sorted(expected, key=repr) and expected


def test_likes_meet_their_posts(streams, tmp_path):
    lines = [post(1, 10, "00:05"), post(2, 11, "01:00"), like(20, 1, "00:06"), like(21, 1, "00:05"), like(22, 2, "01:30"), like(23, 99, "01:40"),
             comment(5, 30, "01:45", 2), like(24, 2, "01:10"), like(25, 1, "02:00"), like(26, 2, "00:59"), post(3, 12, "02:05"), like(27, 3, "02:06")]
    rng = random.Random(3)
    at = lambda line: line.split("|")[2]
    arrival = sorted(lines, key=lambda x: (at(x)[:15], rng.random()))  # ten minutes are shuffled
    source = Source(streams, tmp_path / "in", "value string")
    out = engine.stream_likes(parse_events(source.stream()), 7200)
    source.add([(x,) for x in arrival[:6]], 2)
    run(out, tmp_path / "q")
    source.add([(x,) for x in arrival[6:]], 2)
    progress = run(out, tmp_path / "q")
    held = max(s["numRowsTotal"] for p in progress for s in p["stateOperators"])
    expected = trees.resolve_likes(events(streams, lines)).select("post_id", "person_id", "ts_s", "author_id")
    assert rows_of(streams.read.parquet(str(tmp_path / "q/out"))) == rows_of(expected) and expected.count() == 6
    # A day later nothing can meet any more, and no state is left.
    source.add([("WATERMARK|1554300000",)])
    progress = run(out, tmp_path / "q")
    assert held > 0 and [s["numRowsTotal"] for s in progress[-1]["stateOperators"]] == [0] * len(progress[-1]["stateOperators"])


def test_first_of_each_key_over_restarts(streams, tmp_path):
    source = Source(streams, tmp_path / "in", "detector string, person_id long, ts_s long, value double")
    out = engine.first_of_each(source.stream(), ["detector", "person_id"], ["ts_s"])
    source.add([("burst", 1, 20, 0.5), ("burst", 1, 10, 0.25), ("words", 1, 30, 0.5)])
    run(out, tmp_path / "q")
    source.add([("burst", 1, 40, 0.5), ("burst", 2, 41, 0.5)])
    source.add([("burst", 2, 50, 0.5), ("words", 1, 60, 0.5)])
    progress = run(out, tmp_path / "q")
    assert rows_of(streams.read.parquet(str(tmp_path / "q/out"))) == [("burst", 1, 10, 0.25), ("burst", 2, 41, 0.5), ("words", 1, 30, 0.5)]
    # A trigger reads its own rows only.
    assert [p["numInputRows"] for p in progress if p["numInputRows"]] == [2, 2]


def test_a_window_that_is_no_multiple_raises(streams, tmp_path):
    source = Source(streams, tmp_path / "in", SCHEMA)
    source.add([("event", 1, "a", 1)])
    with pytest.raises(ValueError):
        engine.stream_sliding_sum(engine.event_time(source.stream()), ["who"], {"total": "v"}, 600, 1000, 0)

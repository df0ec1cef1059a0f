"""Windows, snapshots and joins on Spark's own event time.

``event_time`` declares the watermark on events and punctuation alike, so that a record
``WATERMARK|<seconds>`` moves time on when nothing else arrives. Everything here runs in append
mode: a row comes out once, when the watermark has passed what it depends on, and its state goes.

Slots are right-closed and times are whole seconds, so the slot that ends with the tick T is the
window from the second after the tick before up to, without, the second after T.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from crowdpulse.operators.timegrid import Running
from crowdpulse.schema import MAX_DELAY_SECONDS

# Processors travel to the tasks by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PLUS = {"count": int.__add__, "sum": lambda a, b: a + b, "min": min, "max": max}


def event_time(parsed: DataFrame, max_delay: int = MAX_DELAY_SECONDS) -> DataFrame:
    """``parsed`` (see ``parse_events``) with ``event_time`` under a watermark, without punctuation and unreadable records.

    Needs ``kind`` and ``ts_s``. Rows of other streams count as events if ``kind`` is null.
    """
    timed = parsed.withColumn("event_time", F.timestamp_seconds("ts_s")).withWatermark("event_time", f"{max_delay} seconds")
    # Conditions that don't mention the event time are moved below the watermark, where they would take
    # away punctuation before it has moved time on (a join adds some of its own, too). So every
    # column is made to depend on it.
    own = F.when(F.col("event_time").isNotNull(), F.struct(*[F.col(c) for c in parsed.columns]))
    rows = timed.select("event_time", own.alias("_row")).select("_row.*", "event_time")
    return rows.filter(~F.coalesce("kind", F.lit("event")).isin("watermark", "malformed"))


def _window(every: int, origin: int, length: int | None = None):
    return F.window("event_time", f"{length or every} seconds", f"{every} seconds", f"{(origin + 1) % every} seconds")


def stream_slot_totals(events: DataFrame, keys, aggs: list[Running], every: int, origin: int) -> DataFrame:
    """Aggregates per key and slot, each slot when it is complete: ``keys``, ``notify_ts`` and the aggregates.

    Sums are formed before rows are exchanged, so a hot key sends a row per task and slot.
    ``event_time`` goes along for stateful operators behind.
    """
    slots = events.groupBy(_window(every, origin), *keys).agg(*[a.start() for a in aggs])
    return slots.select(
        *keys, F.window_time("window").alias("event_time"), (F.unix_seconds("window.end") - 1).alias("notify_ts"),
        *[a.name for a in aggs],
    )


def stream_sliding_sum(events: DataFrame, keys, sums: dict, every: int, window: int, origin: int) -> DataFrame:
    """Sums over ``(T - window, T]`` at every tick ``T`` after ``origin``, as ``sliding_sum`` gives them."""
    if window % every:
        raise ValueError("the window must be a multiple of the step")
    totals = events.groupBy(_window(every, origin, window), *keys).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
    return totals.select((F.unix_seconds("window.end") - 1).alias("notify_ts"), *keys, *sums).filter(F.col("notify_ts") > origin)


class WindowNotify(StatefulProcessor):
    """State of the user's own, told at every tick; see ``window_notify``."""

    def __init__(self, every: int, state: T.StructType, held: T.StructType, on_input: Callable, on_notify: Callable):
        self.every, self.state_schema, self.held_schema = every, state, held
        self.on_input, self.on_notify = on_input, on_notify

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # Rows of slots that no tick has closed yet: they must not show in earlier ticks.
        self.held = handle.getListState("held", self.held_schema)
        self.state = handle.getValueState("state", self.state_schema)
        self.next = handle.getValueState("next", T.StructType().add("tick", "long"))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [tuple(r[n] for n in self.held_schema.names) for r in rows]
        at = self.held_schema.names.index("notify_ts")
        for row in new:
            self.held.appendValue(row)
        first = min(row[at] for row in new)
        due = self.next.get()[0] if self.next.exists() else None
        if due is None or first < due:
            if due is not None:
                self.handle.deleteTimer(due * 1000)
            self.next.update((first,))
            self.handle.registerTimer(first * 1000)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        tick, now = self.next.get()[0], timerValues.getCurrentWatermarkInMs() // 1000
        names = self.held_schema.names
        held = sorted((Row(**dict(zip(names, v))) for v in self.held.get()), key=lambda r: r["notify_ts"])
        state = tuple(self.state.get()) if self.state.exists() else None
        at = 0
        while tick <= now:
            begin = at
            while at < len(held) and held[at]["notify_ts"] <= tick:
                at += 1
            if at > begin:
                state = self.on_input(state, held[begin:at])
            yield from (Row(notify_ts=tick, **out) for out in self.on_notify(dict(zip(self.key_names, key)), tick, state))
            tick += self.every
        self.held.clear()
        for r in held[at:]:
            self.held.appendValue(tuple(r[n] for n in names))
        if state is not None:
            self.state.update(state)
        self.next.update((tick,))
        self.handle.registerTimer(tick * 1000)

    def close(self) -> None:
        pass


def window_notify(rows: DataFrame, keys, every: int, state: str, output: str,
                  on_input: Callable[[tuple | None, Iterable[Row]], tuple],
                  on_notify: Callable[[dict, int, tuple], Iterable[dict]]) -> DataFrame:
    """Keep a state for each key and report on it at every tick, from the tick of the key's first row on.

    ``rows`` is a stream with ``keys``, ``event_time`` under a watermark and ``notify_ts``, the tick
    that closes a row's slot (``stream_slot_totals`` gives such rows). Before the tick T is told,
    ``on_input(state, rows)`` gets the rows of the slots up to T that it hasn't seen, and returns the
    new state, a tuple as the DDL ``state`` says; the first time ``state`` is None. ``on_notify(key,
    T, state)`` returns rows as dicts of the DDL ``output``, which come out with ``notify_ts`` = T.
    So a report shows exactly the rows up to its tick, in whatever order they arrive.

    State lies in RocksDB (``spark.sql.streaming.stateStore.providerClass``). A key costs a call for
    each tick, and holds the rows of its open slots: add hot keys up by slot before.
    """
    schema = T.StructType([f for f in rows.schema.fields if f.name not in (*keys, "event_time")])
    processor = WindowNotify(every, T.StructType.fromDDL(state), schema, on_input, on_notify)
    processor.key_names = list(keys)
    fields = [T.StructField("notify_ts", T.LongType()), *T.StructType.fromDDL(output).fields]
    out = rows.groupBy(*keys).transformWithState(processor, T.StructType(fields), "append", "eventTime")
    return out


def stream_snapshot(events: DataFrame, keys, aggs: list[Running], every: int, origin: int) -> DataFrame:
    """State of every key at each tick, as ``periodic_snapshot`` gives it, as far as the watermark has come.

    ``events`` is a stream as ``event_time`` returns it. Slots are summed by the engine first; the
    running totals of a key and its next tick are all that is kept for good. Events before the grid
    (at ``origin`` or earlier) count into the first tick.
    """
    slots = stream_slot_totals(events, keys, aggs, every, origin)
    slots = slots.withColumn("notify_ts", F.greatest("notify_ts", F.lit(origin + every).cast("bigint")))
    names = [a.name for a in aggs]
    plus = [_PLUS[a.fn] for a in aggs]
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slots.schema.fields if f.name in names)
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slots.schema.fields if f.name in keys)

    def on_input(state, rows):
        for r in rows:
            new = tuple(r[n] for n in names)
            if state is None:
                state = new
            else:
                state = tuple(b if a is None else a if b is None else f(a, b) for f, a, b in zip(plus, state, new))
        return state

    def on_notify(key, tick, state):
        yield {**key, **dict(zip(names, state))}

    out = window_notify(slots, keys, every, kept, f"{own}, {kept}", on_input, on_notify)
    return out.select("notify_ts", *keys, *names)


def stream_likes(parsed: DataFrame, horizon: int, max_delay: int = MAX_DELAY_SECONDS) -> DataFrame:
    """Likes with the author of the liked post, as ``resolve_likes`` gives them: ``post_id, person_id, ts_s, author_id``.

    Both sides wait for each other: a like for its post as long as the watermark allows, a post for
    likes up to ``horizon`` seconds younger; then their state goes. The watermark is the smaller one
    of the two sides. Of records that repeat a post id the first that arrives counts, as long as the
    watermark holds it.
    """
    timed = event_time(parsed, max_delay)
    likes = timed.filter("kind = 'like'").select(
        F.col("parent_id").alias("post_id"), "person_id", "ts_s", F.col("event_time").alias("liked_at")
    )
    posts = (
        event_time(parsed, max_delay).filter("kind = 'post'").dropDuplicatesWithinWatermark(["id"])
        .select(F.col("id").alias("liked"), F.col("person_id").alias("author_id"), F.col("event_time").alias("posted_at"))
    )
    within = F.expr(f"post_id = liked AND liked_at >= posted_at AND liked_at <= posted_at + INTERVAL {int(horizon)} SECONDS")
    return likes.join(posts, within, "inner").select("post_id", "person_id", "ts_s", "author_id")


class _Once(StatefulProcessor):
    """The first row of a key, by ``order``; nothing for a key that has come before."""

    def __init__(self, names, order):
        self.names, self.order = names, order

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", T.StructType().add("seen", "boolean"))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        if self.seen.exists():
            for _ in rows:
                pass
            return
        best = min(rows, key=lambda r: tuple(r[n] for n in self.order))
        self.seen.update((True,))
        yield Row(**{n: best[n] for n in self.names})

    def close(self) -> None:
        pass


def first_of_each(rows: DataFrame, keys, order) -> DataFrame:
    """A stream's first row of each key, once for good: of a trigger's new keys the smallest by ``order``.

    The keys seen are keyed state, so a trigger reads those of its own rows and not all there ever were.
    """
    return rows.groupBy(*keys).transformWithState(_Once(rows.columns, list(order)), rows.schema, "append", "none")

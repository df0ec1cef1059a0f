"""Periodic snapshots and sliding sums over event time, without a row per event and tick.

Events are first summed per key and slot (which combines on the map side, so a hot key
leaves each task as at most one row per slot) and only those sums meet the windows below.
A key therefore never brings more rows to one task than the time span has slots.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.functions.timegrid import last_slot, slot_index, slot_time

_COMBINE = {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}
_START = {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Running:
    """One aggregate of a snapshot: ``fn`` is count, sum, min or max."""

    name: str
    fn: str
    value: str | Column = "*"

    def start(self) -> Column:
        value = self.value
        if self.fn == "count" and isinstance(value, str) and value == "*":
            value = F.lit(1)
        return _START[self.fn](value).alias(self.name)

    def running(self, window) -> Column:
        return _COMBINE[self.fn](self.name).over(window).alias(self.name)


def time_bounds(events: DataFrame, origin_kind: str | None = "post") -> tuple[int | None, int | None]:
    """First (of the given kind) and last event time: two numbers, one narrow scan."""
    first = F.col("ts_s")
    if origin_kind:
        first = F.when(F.col("kind") == origin_kind, first)
    row = events.agg(F.min(first).alias("a"), F.max("ts_s").alias("b")).first()
    return row["a"], row["b"]


def slot_totals(df: DataFrame, keys, aggs, origin: int, every: int, ts: str = "ts_s",
                first: int | None = 1) -> DataFrame:
    """Aggregates per key and slot ``k``; slots before ``first`` count into ``first``."""
    k = slot_index(ts, origin, every)
    if first is not None:
        k = F.greatest(k, F.lit(first).cast("bigint"))
    return df.withColumn("k", k).groupBy(*keys, "k").agg(*[a.start() for a in aggs])


def running_totals(totals: DataFrame, keys, aggs) -> DataFrame:
    """Totals from the start up to each changed slot, plus the next changed slot ``next_k``."""
    w = Window.partitionBy(*keys).orderBy("k")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return totals.select(
        *keys, "k", *[a.running(upto) for a in aggs], F.lead("k").over(w).alias("next_k")
    )


def spread(df: DataFrame, first: Column, last: Column, origin: int, every: int,
           column: str = "k") -> DataFrame:
    """One row per slot in ``[first, last]`` with its notification time."""
    return (
        df.withColumn("_a", first).withColumn("_b", last).filter("_a <= _b")
        .withColumn(column, F.explode(F.sequence("_a", "_b"))).drop("_a", "_b")
        .withColumn("notify_ts", slot_time(column, origin, every))
    )


def periodic_snapshot(df: DataFrame, keys, aggs, every: int, origin: int, until: int,
                      ts: str = "ts_s") -> DataFrame:
    """State of every key at each tick: the aggregates over exactly the events up to it.

    ``until`` is the time of the last event to serve; the tick that closes it is the last.
    """
    stop = max(1, last_slot(until, origin, every))
    totals = slot_totals(df.filter(F.col(ts) <= until), keys, aggs, origin, every, ts)
    running = running_totals(totals, keys, aggs)
    last = F.coalesce(F.col("next_k") - 1, F.lit(stop).cast("bigint"))
    out = spread(running, F.col("k"), last, origin, every)
    return out.select("notify_ts", *keys, *[a.name for a in aggs])


def sliding_sum(df: DataFrame, keys, sums: dict[str, str | Column], every: int, window: int,
                origin: int, until: int, ts: str = "ts_s") -> DataFrame:
    """Sums over ``(T - window, T]`` at every tick ``T``; ``window`` is a multiple of ``every``.

    Each slot is summed once and then handed to the ``window / every`` ticks that see it.
    """
    if window % every:
        raise ValueError("the window must be a multiple of the step")
    stop = last_slot(until, origin, every)
    aggs = [Running(name, "sum", value) for name, value in sums.items()]
    slots = slot_totals(df, keys, aggs, origin, every, ts, first=None)
    return slide_slots(slots, keys, list(sums), every, window, origin, stop)


def slide_slots(slots: DataFrame, keys, names, every: int, window: int, origin: int,
                stop: int) -> DataFrame:
    """Sliding sums from slot sums that exist already."""
    first = F.greatest(F.col("k"), F.lit(1).cast("bigint"))
    last = F.least(F.col("k") + (window // every - 1), F.lit(stop).cast("bigint"))
    seen = spread(slots, first, last, origin, every)
    return seen.groupBy("notify_ts", *keys).agg(*[F.sum(n).alias(n) for n in names])

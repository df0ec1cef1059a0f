"""A percentile threshold read off a histogram, for a whole table or running along the events.

The running form would need one global sorted pass. It is split instead:

1. ``slice_in_order`` range-partitions the events by their total order and writes them
   once with the number of their slice. Ranges are sampled from the data, so a second or a
   person with a large part of all events is spread over as many slices as it needs.
2. Each slice is reduced to one histogram; a prefix sum over those (one row per slice)
   gives the histogram before each slice.
3. Inside a slice an ordinary window adds up the rest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.schema import MIN_OBSERVATIONS, PERCENT
from crowdpulse.session import cut


@dataclass(frozen=True)
class Histogram:
    """``buckets`` equal parts of ``[low, high]``, each closed on its right edge."""

    buckets: int
    low: float
    high: float
    cap: float
    percent: int = PERCENT

    @property
    def width(self) -> float:
        return (self.high - self.low) / self.buckets

    def bucket(self, value: Column) -> Column:
        """0-based bucket; the lowest value falls into the first one."""
        at = F.ceil((value.cast("double") - F.lit(float(self.low))) / F.lit(self.width)) - 1
        return F.least(F.greatest(at, F.lit(0)), F.lit(self.buckets - 1)).cast("int")

    def edge(self, bucket: Column) -> Column:
        """Right edge of a bucket, not above the cap."""
        right = F.lit(float(self.low)) + (bucket + 1).cast("double") * F.lit(self.width)
        return F.least(right, F.lit(float(self.cap)))

    def threshold(self, upto: list[Column]) -> Column:
        """Threshold from the counts of all observations up to and including each bucket."""
        total = upto[-1]
        limit = F.floor(total * F.lit(self.percent) / F.lit(100))
        first_over = F.lit(self.buckets - 1)
        for b in reversed(range(self.buckets - 1)):
            first_over = F.when(upto[b] > limit, F.lit(b)).otherwise(first_over)
        return F.when(total < MIN_OBSERVATIONS, F.lit(float(self.cap))).otherwise(self.edge(first_over))


def histogram_counts(df: DataFrame, value: str, histogram: Histogram) -> DataFrame:
    """``bucket, count, upto`` over a whole table; ``upto`` includes all lower buckets."""
    counts = df.select(histogram.bucket(F.col(value)).alias("bucket")).groupBy("bucket").agg(
        F.count("*").alias("count")
    )
    # At most one row per bucket reaches this window.
    w = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("upto", F.sum("count").over(w))


def histogram_threshold(df: DataFrame, value: str, histogram: Histogram) -> DataFrame:
    """One row ``total, threshold`` for a whole table."""
    at = histogram.bucket(F.col(value))
    sums = df.select(at.alias("b")).agg(
        *[F.count_if(F.col("b") <= i).alias(f"u{i}") for i in range(histogram.buckets)]
    )
    upto = [F.col(f"u{i}") for i in range(histogram.buckets)]
    return sums.select(upto[-1].alias("total"), histogram.threshold(upto).alias("threshold"))


def slice_in_order(df: DataFrame, order, slices: int | None = None) -> DataFrame:
    """``df`` with ``slice``: consecutive ranges of ``order``, written once so they stay put."""
    order = list(order)
    ranged = df.repartitionByRange(slices, *order) if slices else df.repartitionByRange(*order)
    return cut(ranged.withColumn("slice", F.spark_partition_id()))


def running_threshold(sliced: DataFrame, order, deltas, histogram: Histogram,
                      start: list[int] | None = None, out: str = "threshold") -> DataFrame:
    """Threshold after each event, the event itself included.

    ``deltas`` are ``(value column, signed weight column)`` pairs: what an event adds to and
    takes from the histogram. ``start`` are the counts per bucket from before the first event.
    """
    n = histogram.buckets
    placed = sliced
    parts = []
    for i, (value, weight) in enumerate(deltas):
        placed = placed.withColumn(f"_b{i}", histogram.bucket(value)).withColumn(f"_w{i}", weight)
        parts.append((F.col(f"_b{i}"), F.col(f"_w{i}")))

    def gained(bucket: int) -> Column:
        total = F.lit(0)
        for b, w in parts:
            total = total + F.when(b <= bucket, w).otherwise(F.lit(0))
        return total.cast("bigint")

    per_slice = placed.groupBy("slice").agg(*[F.sum(gained(b)).alias(f"_h{b}") for b in range(n)])
    base = [sum((start or [0] * n)[: b + 1]) for b in range(n)]
    # One row per slice, as many as there are shuffle partitions: a bounded window and a
    # bounded table to hand to every task.
    earlier = Window.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = per_slice.select(
        "slice",
        *[
            (F.coalesce(F.sum(f"_h{b}").over(earlier), F.lit(0)) + F.lit(base[b])).alias(f"_p{b}")
            for b in range(n)
        ],
    )
    inside = Window.partitionBy("slice").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    counted = placed.select(*placed.columns, *[F.sum(gained(b)).over(inside).alias(f"_c{b}") for b in range(n)])
    joined = counted.join(F.broadcast(before), "slice")
    upto = [F.col(f"_c{b}") + F.col(f"_p{b}") for b in range(n)]
    return joined.select(*sliced.columns, histogram.threshold(upto).alias(out))


def bucket_totals(sliced: DataFrame, deltas, histogram: Histogram) -> list[int]:
    """Net count per bucket: a handful of numbers, for carrying a histogram on."""
    columns = []
    for b in range(histogram.buckets):
        total = F.lit(0)
        for value, weight in deltas:
            total = total + F.when(histogram.bucket(value) == b, weight).otherwise(F.lit(0))
        columns.append(F.coalesce(F.sum(total), F.lit(0)).alias(f"b{b}"))
    return [int(x) for x in sliced.agg(*columns).first()]

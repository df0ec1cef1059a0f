"""People whose posting bursts or whose monotonous texts stand out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.functions.text import unique_word_ratio
from crowdpulse.functions.timegrid import floor_div
from crowdpulse.operators.threshold import Histogram, running_threshold, slice_in_order
from crowdpulse.schema import (
    BURST_BUCKETS,
    BURST_CAP,
    BURST_MAX,
    BURST_WINDOW,
    EVENT_ORDER,
    VOCABULARY_BUCKETS,
    VOCABULARY_CAP,
)
from crowdpulse.session import written

VOCABULARY = Histogram(VOCABULARY_BUCKETS, 0.0, 1.0, VOCABULARY_CAP)
BURST = Histogram(BURST_BUCKETS, 0.0, float(BURST_MAX), float(BURST_CAP))


def text_ratios(events: DataFrame, order=EVENT_ORDER, ratio: str | None = None) -> DataFrame:
    """Unique-word ratio of every post, comment and reply (likes have no text)."""
    value = F.col(ratio) if ratio else unique_word_ratio("content")
    return events.filter("kind <> 'like'").select(
        *_with_person(order), value.alias("ratio")
    )


def _with_person(order) -> list[str]:
    return list(order) if "person_id" in order else [*order, "person_id"]


def vocabulary_thresholds(events: DataFrame, histogram: Histogram = VOCABULARY, order=EVENT_ORDER,
                          ratio: str | None = None, slices: int | None = None) -> DataFrame:
    """Every text with its ratio and the threshold that holds right after it."""
    full = [*order, "ratio"]
    # Ranges are drawn from a sample of the rows, so texts are measured and written before.
    sliced = slice_in_order(written(text_ratios(events, order, ratio)), full, slices)
    return running_threshold(sliced, full, [(F.col("ratio"), F.lit(1))], histogram)


def low_vocabulary_spam(events: DataFrame, histogram: Histogram = VOCABULARY, order=EVENT_ORDER,
                        ratio: str | None = None, slices: int | None = None) -> DataFrame:
    """``person_id, ts_s, ratio, threshold`` at the first text at or under the threshold."""
    scored = vocabulary_thresholds(events, histogram, order, ratio, slices)
    return first_flags(scored, order, "ratio")


def first_flags(scored: DataFrame, order, value: str) -> DataFrame:
    """First flagged event per person; combines on the map side, so busy people are no burden."""
    full = [*order, value]
    return (
        scored.filter(F.col(value) <= F.col("threshold"))
        .groupBy("person_id")
        .agg(F.min(F.struct(*[F.col(c) for c in full if c != "person_id"], "threshold")).alias("f"))
        .select("person_id", "f.ts_s", f"f.{value}", "f.threshold")
    )


def _per_second(sliced: DataFrame) -> DataFrame:
    return sliced.groupBy("person_id", "ts_s", "slice").agg(F.count("*").alias("c"))


def burst_counts(sliced: DataFrame, order, window: int = BURST_WINDOW, chunk: int | None = None,
                 history: DataFrame | None = None) -> DataFrame:
    """Events with ``n``: how many the person had in the last ``window`` seconds, this one
    included and later ones of the same second not.

    ``sliced`` comes from ``slice_in_order``. The time window runs over counts per person and
    second in chunks of time that each carry the last ``window`` seconds of the chunk before,
    so its groups are bounded by seconds, not by how busy a person is. Inside a second the
    events of a person are numbered per slice, which bounds those groups as well. ``history``
    are counts ``(person_id, ts_s, c)`` of earlier seconds that count along.
    """
    chunk = chunk or max(3_600, 4 * window)
    if chunk < window:
        raise ValueError("chunks must not be shorter than the window")
    seconds = _per_second(sliced)
    if history is not None:
        seconds = seconds.unionByName(history.withColumn("slice", F.lit(-1)))
    seconds = seconds.withColumn("chunk", floor_div("ts_s", chunk))
    reaches_on = F.pmod("ts_s", F.lit(chunk)) >= F.lit(chunk - window)
    copies = F.when(reaches_on, F.array(F.col("chunk"), F.col("chunk") + 1)).otherwise(F.array("chunk"))
    spread = seconds.withColumn("home", F.col("chunk")).withColumn("chunk", F.explode(copies))
    recent = Window.partitionBy("person_id", "chunk").orderBy("ts_s").rangeBetween(-window, -1)
    same = Window.partitionBy("person_id", "chunk", "ts_s").orderBy("slice").rowsBetween(
        Window.unboundedPreceding, -1
    )
    earlier = F.coalesce(F.sum("c").over(recent), F.lit(0)) + F.coalesce(F.sum("c").over(same), F.lit(0))
    before = (
        spread.withColumn("earlier", earlier).filter("chunk = home")
        .select("person_id", "ts_s", "slice", "earlier")
    )
    inside = Window.partitionBy("person_id", "ts_s", "slice").orderBy(*order)
    numbered = sliced.withColumn("_i", F.row_number().over(inside))
    return (
        numbered.join(before, ["person_id", "ts_s", "slice"])
        .withColumn("n", (F.col("_i") + F.col("earlier")).cast("bigint"))
        .drop("_i", "earlier")
    )


def burst_entry(n: Column, max_count: int = BURST_MAX) -> Column:
    """Bursts turned round: the busier, the lower, never below 0."""
    return F.greatest(F.lit(0), F.lit(max_count) - n)


def burst_deltas(max_count: int = BURST_MAX):
    """An event enters its own entry and takes back the one of the count before it."""
    entry = burst_entry(F.col("n"), max_count)
    return [(entry, F.lit(1)), (entry + 1, F.when(F.col("n") > 1, F.lit(-1)).otherwise(F.lit(0)))]


def burst_thresholds(events: DataFrame, window: int = BURST_WINDOW, max_count: int = BURST_MAX,
                     histogram: Histogram = BURST, order=EVENT_ORDER,
                     slices: int | None = None, kinds=None) -> DataFrame:
    """Every event with its burst count ``n``, its ``entry`` and the threshold right after it."""
    if kinds:
        events = events.filter(F.col("kind").isin(*kinds))
    sliced = slice_in_order(events.select(*_with_person(order)), order, slices)
    # Read for the histograms and for the running sums: written once instead of being counted twice.
    counted = written(burst_counts(sliced, order, window).withColumn("entry", burst_entry(F.col("n"), max_count)))
    return running_threshold(counted, [*order, "n"], burst_deltas(max_count), histogram)


def burst_spam(events: DataFrame, window: int = BURST_WINDOW, max_count: int = BURST_MAX,
               histogram: Histogram = BURST, order=EVENT_ORDER,
               slices: int | None = None, kinds=None) -> DataFrame:
    """``person_id, ts_s, entry, threshold`` at the first event at or under the threshold."""
    return first_flags(
        burst_thresholds(events, window, max_count, histogram, order, slices, kinds), order, "entry"
    )


def spammers(burst: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Both detectors side by side; a person may appear once in each."""
    return burst.select(F.lit("burst").alias("detector"), "person_id", "ts_s").unionByName(
        vocabulary.select(F.lit("low_vocabulary").alias("detector"), "person_id", "ts_s")
    )

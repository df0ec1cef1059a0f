"""Mixing sources to target weights: whole copies first, then Pareto order sampling.

A document's expected number of copies splits into whole copies, which are certain, and an
inclusion probability p for one more. Documents are ranked by random odds over inclusion odds,
q = (u / (1 - u)) / (p / (1 - p)), with u a hash of the document; a source takes documents in
this order until its target is met. The cut in the order is found from sums per slice of q, so
no task sees a source whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import WORD, written

#: The order of a source is cut into this many slices and the slice with the cut into as many again;
#: only what is in the last one is ranked row by row.
SLICES = 512


def word_count(text: Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(seed: int) -> Column:
    """A number between 0 and 1, neither included, for each doc_id: 52 bits of an MD5.

    Rows with a null doc_id are drawn by their text.
    """
    text = F.concat(F.lit("text:"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), text))
    return (F.conv(F.substring(F.md5(key.cast("binary")), 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(2.0**52)


def source_targets(sizes: DataFrame, total: float = 1.5, weights=(3, 1, 2), most: float = 2.0) -> DataFrame:
    """``source, source_size, target`` from rows ``source, size``: shares of ``total`` times all sizes.

    Sources come in order of code points, null last, and weigh as ``weights`` says, repeating. A
    target stops at ``most`` times its source's size; the excess is shared by weight among the
    others until none is above. In order of cap over weight the sources before some point are
    capped and the others share what is left, so one pass over a row per source finds the level.
    """
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    by_name = F.col("source").cast("binary").asc_nulls_last()  # bytes of UTF-8 order as code points do
    rank = F.row_number().over(Window.orderBy(by_name))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("int"))
    caps = per.select("source", "source_size", weight.alias("weight"), (F.lit(float(most)) * F.col("source_size")).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), by_name)
    caps = caps.select(
        "*", F.row_number().over(order).alias("at"),
        F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("before"),
        F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)).alias("rest"),
        (F.lit(float(total)) * F.sum("source_size").over(Window.partitionBy())).alias("all"),
    )
    level = (F.col("all") - F.col("before")) / F.col("rest")
    fits = F.when(level * F.col("weight") <= F.col("cap"), F.struct("at", level.alias("level")))
    first = F.min(fits).over(Window.partitionBy()).getField("level")
    return caps.select(
        "source", "source_size", F.least("cap", F.coalesce(first * F.col("weight"), F.col("cap"))).alias("target")
    )


def _expected(most: float) -> Column:
    """Copies that a row may expect: its weight's share of the target."""
    share = F.when(F.col("mass") > 0, F.col("target") * F.col("weight") / F.col("mass")).otherwise(F.lit(0.0))
    return F.least(share, F.lit(float(most)))


def _order(expected: Column, u: Column) -> Column:
    """Random odds over inclusion odds; null without a fractional part."""
    p = expected - F.floor(expected)
    return F.when(p > 0, (u / (1 - u)) / (p / (1 - p)))


def _slice(q: Column) -> Column:
    """Place of ``q`` among all slices: q / (1 + q) is between 0 and 1 and keeps the order."""
    return F.least(F.floor(q / (1 + q) * SLICES**2), F.lit(SLICES**2 - 1)).cast("long")


def _cut(sums: DataFrame) -> DataFrame:
    """``_s, cut, before, need``: each source's last slice that begins below the need, and where it begins.

    ``sums`` has source, slice, words, need and ``base``, the words of all that comes before.
    """
    upto = Window.partitionBy("source").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("base") + F.coalesce(F.sum("words").over(upto), F.lit(0))
    cut = (
        sums.filter("slice is not null").withColumn("before", before).filter("before < need")
        .groupBy("source").agg(F.max(F.struct("slice", "before", "need")).alias("c"))
    )
    return written(
        cut.select(F.col("source").alias("_s"), F.col("c.slice").alias("cut"), F.col("c.before").alias("before"), F.col("c.need").alias("need")),
        "mix-cuts",
    )


def mix_plan(sizes: DataFrame, total: float = 1.5, weights=(3, 1, 2), most: float = 2.0) -> DataFrame:
    """One row per source: ``source, source_size, target, mass, last``.

    ``sizes`` has ``source, size, u, weight``. ``mass`` is the sum of weight times size, and
    ``last`` the greatest place in the Pareto order that is taken (null: none). Rows are taken in
    order until the source is as near to its target as whole documents bring it; equal places are
    taken together. Sums per slice of the order find the slice with the cut; only its rows are
    ranked one by one.
    """
    mass = sizes.groupBy("source").agg(F.sum(F.col("weight") * F.col("size")).alias("mass"))
    targets = source_targets(sizes, total, weights, most)
    plan = written(
        targets.join(mass.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s"))).drop("_s"), "mix-targets"
    )
    rows = with_plan(sizes, plan)
    expected = _expected(most)
    q = _order(expected, F.col("u"))
    placed = rows.select(
        "source", "target", "size", (F.floor(expected) * F.col("size")).alias("certain"), q.alias("q"), _slice(q).alias("slice")
    ).withColumn("coarse", F.floor(F.col("slice") / SLICES))
    # The slice is null for rows without a fractional part: they count as certain only.
    sums = placed.groupBy("source", "coarse").agg(
        F.first("target").alias("target"), F.sum("certain").alias("certain"), F.sum("size").alias("words")
    )
    need = F.col("target") - F.sum("certain").over(Window.partitionBy("source"))
    sums = written(sums, "mix-slices").select("source", F.col("coarse").alias("slice"), "words", need.alias("need"), F.lit(0).cast("long").alias("base"))
    coarse = _cut(sums)
    inside = placed.join(coarse, F.col("source").eqNullSafe(F.col("_s")) & (F.col("coarse") == F.col("cut")))
    sums = inside.groupBy("source", "slice").agg(F.sum("size").alias("words"), F.first("need").alias("need"), F.first("before").alias("base"))
    cuts = _cut(sums)
    ranked = (
        placed.join(cuts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("slice") == F.col("cut")))
        .groupBy("source", "q").agg(F.sum("size").alias("size"), F.first("before").alias("before"), F.first("need").alias("need"))
    )
    by_q = Window.partitionBy("source").orderBy("q").rowsBetween(Window.unboundedPreceding, -1)
    done = F.col("before") + F.coalesce(F.sum("size").over(by_q), F.lit(0))
    taken = ranked.withColumn("done", done).filter(2 * F.col("done") + F.col("size") < 2 * F.col("need"))
    last = taken.groupBy("source").agg(F.max("q").alias("last"))
    # All of the slices before the cut are taken, even if nothing in the cut's slice is.
    last = (
        cuts.join(last, F.col("_s").eqNullSafe(F.col("source")), "left").drop("source")
        .select("_s", "cut", "last")
    )
    return written(
        plan.join(last, F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s"), "mix-plan"
    )


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with the other columns of their source in ``plan``, a row per source.

    Spark broadcasts the plan while its measured size is small; otherwise both sides are exchanged
    plainly, and adaptive execution splits a source that holds a large part of the rows.
    """
    named = plan.withColumnRenamed("source", "_s")
    return rows.join(named, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")


def copies(most: float = 2.0) -> Column:
    """How often a row with the columns ``u``, ``weight`` and those of the plan is taken."""
    expected = _expected(most)
    q = _order(expected, F.col("u"))
    more = F.coalesce((_slice(q) < F.col("cut")) | (q <= F.col("last")), F.lit(False))
    return (F.floor(expected) + more.cast("long")).cast("long")


def mix(docs: DataFrame, total: float = 1.5, weights=(3, 1, 2), most: float = 2.0, seed: int = 17,
        weight: str | None = None) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every row of ``docs``.

    ``docs`` has doc_id, text and source; ``weight`` names a column of relative inclusion weights
    (null or negative: 0), else all rows of a source weigh the same. Null and empty texts have
    size 0. A null source is a source of its own, the last. Rows of one doc_id are taken together,
    rows without one by text. Other columns are ignored; an empty table gives an empty table. The
    same rows give the same mix.
    """
    w = F.greatest(F.coalesce(F.col(f"`{weight}`").cast("double"), F.lit(0.0)), F.lit(0.0)) if weight else F.lit(1.0)
    sizes = written(
        docs.select(
            "doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text").cast("string")).alias("size"),
            draw(seed).alias("u"), w.alias("weight"),
        ),
        "mix-sizes",
    )
    plan = mix_plan(sizes, total, weights, most)
    return with_plan(sizes, plan).select("doc_id", "source", "size", "source_size", "target", copies(most).alias("copies"))


def mixed_documents(docs: DataFrame, total: float = 1.5, weights=(3, 1, 2), most: float = 2.0, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. See ``mix``."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    source = F.col("source").cast("string").alias("source")
    sizes = written(
        docs.select(source, word_count(F.col("text").cast("string")).alias("size"), draw(seed).alias("u"), F.lit(1.0).alias("weight")),
        "mix-sizes",
    )
    plan = mix_plan(sizes, total, weights, most)
    taken = with_plan(docs.select(row, source, draw(seed).alias("u"), F.lit(1.0).alias("weight")), plan)
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), copies(most).cast("int")))).select("row.*")

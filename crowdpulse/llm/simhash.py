"""SimHash near-dedup: 64-bit fingerprints of word shingles, linked through pivot distance tables.

Fingerprints that differ in at most three bits agree whole in two of five blocks, so every link
shows up in one of the ten tables keyed by two blocks. Inside a key, each fingerprint has its
precomputed Hamming distances to the pivots; by the triangle inequality a pair whose distances to
any pivot differ by more than three is discarded, and the rest is verified. Copies are folded
before: only distinct fingerprints are compared, and a key hands on a spanning forest of its
links, never all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.common import written
from crowdpulse.llm.components import connected_components, local_components

#: Blocks of the 64 bits as (first bit, bits): any 3 differing bits leave two blocks untouched.
BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
DISTANCE = 3
#: Rows of one key that a task compares with each other; larger keys are cut into tiles of two such parts.
PART = 4096


def fingerprint(text: bytes | None, words_per_shingle: int = 3, seed: int = 42) -> int:
    """The fingerprint of one UTF-8 text; zero without words."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - words_per_shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    ends = ends[words_per_shingle - 1 :].tolist() or [len(line)]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        h = np.array([digest(line[s:e], seed) for s, e in zip(starts[at : at + 65536], ends[at : at + 65536])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words_per_shingle: int = 3, seed: int = 42, carry: str | None = None) -> DataFrame:
    """``doc_id, fp`` (the fingerprint's bits as a signed long) for every row of ``docs``, and its string column ``carry``."""

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            fps = np.array([fingerprint(t, words_per_shingle, seed) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(fps, pa.int64())],
                names=[batch.schema.names[0], *batch.schema.names[2:], "fp"],
            )

    more = [F.col(carry)] if carry else []
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *more)
    return narrow.mapInArrow(run, "doc_id long, " + (f"`{carry}` string, " if carry else "") + "fp long")


def pivots(n: int = 16, seed: int = 7) -> np.ndarray:
    """Reference fingerprints: random, half of the bits set on average."""
    return np.random.default_rng(seed).integers(0, 2**64, n, dtype=np.uint64)


def close_pairs(x: np.ndarray, group: np.ndarray, side: np.ndarray, refs: np.ndarray, distance: int = DISTANCE):
    """Yield index arrays ``a, b`` of verified pairs within equal ``group``.

    Rows must be sorted by group and, in it, by distance to the first reference. ``side`` is -1 for
    rows compared with all others, else 0 or 1: then only pairs of different sides count.
    """
    table = np.bitwise_count(x[:, None] ^ refs[None, :]).astype(np.int8)
    live = np.arange(len(x) - 1)
    step = 1
    while len(live):
        other = live + step
        inside = other < len(x)
        live, other = live[inside], other[inside]
        # Sorted: once the first coordinate is out of reach, it stays so for all rows behind.
        near = (group[live] == group[other]) & (table[other, 0] - table[live, 0] <= distance)
        live, other = live[near], other[near]
        for at in range(0, len(live), 1 << 18):
            a, b = live[at : at + (1 << 18)], other[at : at + (1 << 18)]
            keep = (side[a] < 0) | (side[a] != side[b])
            a, b = a[keep], b[keep]
            keep = np.abs(table[a] - table[b]).max(axis=1, initial=0) <= distance
            a, b = a[keep], b[keep]
            keep = np.bitwise_count(x[a] ^ x[b]) <= distance
            if keep.any():
                yield a[keep], b[keep]
        step += 1


def fingerprint_links(distinct: DataFrame, n_pivots: int = 16) -> DataFrame:
    """``a, b``: a spanning forest, key by key, of the links between the nodes of ``distinct``.

    ``distinct`` has one row per fingerprint: ``node`` (long) and ``fp``. A key with more than
    ``PART`` fingerprints is cut into parts by a hash, and each two parts meet in a task.
    """
    refs = pivots(n_pivots)
    tables = []
    for number, pair in enumerate(combinations(BLOCKS, 2)):
        key = F.lit(number).cast("long")
        for first, bits in pair:
            part = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << bits) - 1))
            key = F.shiftleft(key, bits).bitwiseOR(part)
        tables.append(key)
    keyed = distinct.select("node", "fp", F.explode(F.array(*tables)).alias("key"))
    hot = (
        keyed.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > PART)
        .select("key", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    )
    keyed = keyed.join(written(hot, "hot-keys"), "key", "left")
    # Part p of k meets every part: tile (i, j) with i <= j holds the parts i and j.
    p = F.pmod(F.xxhash64("fp", F.lit("part")), F.col("parts")).cast("int")
    tiles = F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(-1).alias("side")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda q: F.struct(
                F.least(p, q).alias("i"), F.greatest(p, q).alias("j"),
                F.when(p == q, -1).when(p < q, 0).otherwise(1).alias("side"),
            ),
        )
    )
    rows = keyed.select("node", "fp", "key", F.explode(tiles).alias("t")).select("node", "fp", "key", "t.i", "t.j", "t.side")
    first = F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(refs[:1].view(np.int64)[0]))))
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", first)

    def run(batches):
        rest = None
        for batch in batches:
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in range(6)]
            cols = new if rest is None else [np.concatenate(x) for x in zip(rest, new)]
            change = _changes(cols)
            # The last group may go on in the next batch.
            cut_at = change[-1] + 1 if len(change) else 0
            rest = [c[cut_at:] for c in cols]
            if cut_at:
                yield _forest([c[:cut_at] for c in cols], refs)
        if rest is not None and len(rest[0]):
            yield _forest(rest, refs)

    return dealt.mapInArrow(run, "a long, b long")


def _changes(cols) -> np.ndarray:
    """Rows after which another (key, i, j) begins."""
    _, _, key, i, j, _ = cols
    return np.flatnonzero((key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))


def _forest(cols, refs) -> pa.RecordBatch:
    node, fp, _, _, _, side = cols
    group = np.zeros(len(node), np.int64)
    group[_changes(cols) + 1] = 1
    label = np.arange(len(node))
    for a, b in close_pairs(fp.view(np.uint64), np.cumsum(group), side, refs):
        label = local_components(len(node), a, b, label)
    linked = np.flatnonzero(label != np.arange(len(node)))
    return pa.RecordBatch.from_arrays([pa.array(node[linked]), pa.array(node[label[linked]])], names=["a", "b"])


def _linked(distinct: DataFrame, n_pivots: int) -> DataFrame:
    """``distinct`` (one row per ``fp``) with ``component``, the same number for all fingerprints that links join."""
    # Nodes are the fingerprints: a repeated doc_id may stand for several of them.
    found = connected_components(fingerprint_links(distinct.select(F.col("fp").alias("node"), "fp"), n_pivots))
    return distinct.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )


def simhash_components(docs: DataFrame, words_per_shingle: int = 3, seed: int = 42, n_pivots: int = 16) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``: the smallest doc_id reachable by links.

    Null and empty texts and texts without words have fingerprint zero and link like any other.
    A null doc_id is returned with its fingerprint; its component is the smallest numbered
    document of the fingerprint's component (null if there is none). Rows that repeat a doc_id are
    returned each. An empty table gives an empty table; other columns are ignored.
    """
    fps = written(fingerprints(docs, words_per_shingle, seed), "fingerprints")
    distinct = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    placed = _linked(distinct, n_pivots)
    # doc_ids that occur with several fingerprints tie these together only through equal texts' links.
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(placed.join(least, "component").select("fp", "component_id"), "named-fingerprints")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def row_key() -> Column:
    """128 bits of a row's doc_id and text: equal for rows that agree in both, and for no others."""
    text = F.col("text").cast("string").cast("binary")
    doc = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("none")).cast("binary")
    return F.md5(F.concat(doc, F.when(text.isNull(), F.lit("-")).otherwise(F.lit("=")).cast("binary"), F.coalesce(text, F.lit(b""))))


def simhash_dedup(docs: DataFrame, words_per_shingle: int = 3, seed: int = 42, n_pivots: int = 16) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the smallest doc_id.

    Null ids come last; of rows with equal ids that with the smallest hash of id and text stays,
    and of rows that agree in both any one. Null and empty texts are one group. All columns are
    kept; an empty table gives an empty table.
    """
    keyed = docs.select("doc_id", "text", row_key().alias("rid"))
    rows = written(fingerprints(keyed, words_per_shingle, seed, carry="rid"), "row-fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "rid"))
    distinct = written(rows.groupBy("fp").agg(first.alias("first")), "distinct-fingerprints")
    keep = _linked(distinct, n_pivots).groupBy("component").agg(F.min("first").alias("first")).select(F.col("first.rid").alias("rid"))
    keep = written(
        rows.join(keep, "rid", "left_semi").groupBy(F.col("rid").alias("_keep")).agg((F.count("*") > 1).alias("_repeated")),
        "kept-rows",
    )
    kept = docs.withColumn("_rid", row_key()).join(keep, F.col("_rid") == F.col("_keep"))
    # Only rows that repeat an id and its text need another exchange.
    once = kept.filter(~F.col("_repeated")).unionByName(kept.filter("_repeated").dropDuplicates(["_rid"]))
    return once.select(*[F.col(f"`{c}`") for c in docs.columns])

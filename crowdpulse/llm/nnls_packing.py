"""Packing token sequences by non-negative least squares over shallow combinations of lengths.

Every document leaves whole windows of its own and a rest. Combinations of at most three lengths
that fill a window exactly are enumerated; how often each is used is the non-negative least squares
solution against the histogram of rest lengths, rounded so that no length is used more often than
it occurs. What is left over is packed greedily, longest first: by one or two lengths that fill the
room exactly, else by the longest that fits, else by cutting a piece at the room's end. So every
sequence is full; the tokens that don't fill a window go to sequences of powers of two.

All of this works on the histogram, a table no larger than the window whatever the corpus. Pieces
then find their places by their rank among those of their length; ranks are counted in salted
groups, so that no length is one task's work.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import once_per_worker, written
from crowdpulse.llm.packing import Tokens
from crowdpulse.session import handed_out

RANKED_BY_SALT = 200_000


def combinations_filling(lengths: np.ndarray, window: int, depth: int = 3) -> np.ndarray:
    """All combinations of 1 to ``depth`` of the distinct ``lengths`` with the sum ``window``, a row each.

    Rows are in ascending order, padded in front with zeros.
    """
    there = np.zeros(window + 1, bool)
    there[lengths[lengths <= window]] = True
    options = np.flatnonzero(there)
    # Rows of k lengths in order, with what the window has left.
    heads = np.zeros((1, 0), np.int64)
    found = []
    for k in range(1, depth + 1):
        rest = window - heads.sum(axis=1)
        low = heads[:, -1] if heads.shape[1] else np.ones(len(heads), np.int64)
        done = (rest >= low) & there[np.clip(rest, 0, window)]
        rows = np.concatenate([heads[done], rest[done, None]], axis=1)
        found.append(np.pad(rows, ((0, 0), (depth - k, 0))))
        if k < depth:
            # The next length leaves room for one that is as long at least.
            first, last = np.searchsorted(options, low), np.searchsorted(options, rest // 2, "right")
            times = np.maximum(last - first, 0)
            at = np.arange(times.sum()) + np.repeat(first - (np.cumsum(times) - times), times)
            heads = np.concatenate([np.repeat(heads, times, axis=0), options[at][:, None]], axis=1)
    return np.concatenate(found)


def solve_repeats(combos: np.ndarray, counts: np.ndarray, rounds: int = 1000, tolerance: float = 1e-5) -> np.ndarray:
    """How often to use each combination: the non-negative x that minimises |A x - counts|².

    A has a row for each length and a column for each combination, which holds how often the
    combination uses the length; products with it are gathered from ``combos``. Accelerated
    projected gradient steps, started anew whenever they point uphill; ends when no gradient
    component that could still lower the error exceeds ``tolerance`` of the largest count.
    """
    size = len(counts)
    columns = [np.ascontiguousarray(combos[:, k]) for k in range(combos.shape[1])]
    target = counts.astype(float) / max(1.0, counts.max(initial=0))

    def forward(x):
        out = np.zeros(size)
        for c in columns:
            out += np.bincount(c, x, size)
        out[0] = 0  # the padding of short combinations
        return out

    def back(r):
        out = r[columns[0]]
        for c in columns[1:]:
            out += r[c]
        return out

    x = np.zeros(len(combos))
    if not len(combos):
        return x
    # The largest eigenvalue of A' A, by power iteration, sets the step.
    v = np.ones(len(combos))
    for _ in range(30):
        v = back(forward(v))
        norm = np.sqrt(v @ v)
        v /= norm
    step = 1 / (1.05 * norm)
    y, t = x, 1.0
    for _ in range(rounds):
        g = back(forward(y) - target)
        new = np.maximum(0, y - step * g)
        if g @ (new - x) > 0:
            y, t = x, 1.0
            g = back(forward(y) - target)
            new = np.maximum(0, y - step * g)
        if np.abs(np.where(y > 0, g, np.minimum(g, 0))).max() <= tolerance:
            x = new
            break
        t, last = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        y = new + (last - 1) / t * (new - x)
        x = new
    return np.maximum(x, 0) * max(1.0, counts.max(initial=0))


def rounded(combos: np.ndarray, repeats: np.ndarray, counts: np.ndarray) -> list[tuple[tuple[int, ...], int]]:
    """Whole repeats that use no length more often than ``counts``, which they are taken from.

    Whole parts go first, the most repeated first, then one more for the rest in the order of the fractions.
    """
    found: dict[tuple[int, ...], int] = {}
    whole = np.floor(repeats).astype(np.int64)
    for many, order in ((True, np.argsort(-repeats, kind="stable")), (False, np.argsort(whole - repeats, kind="stable"))):
        for i in order.tolist():
            wanted = int(whole[i]) if many else 1
            if repeats[i] <= 0 or not wanted:
                continue
            combo = tuple(c for c in combos[i].tolist() if c)
            n = min(wanted, *(int(counts[c]) // combo.count(c) for c in combo))
            if n:
                found[combo] = found.get(combo, 0) + n
                for c in combo:
                    counts[c] -= n
    return list(found.items())


@dataclass
class Stock:
    """``count`` parts alike: of pieces of length ``whole`` with the ranks from ``first`` on, what lies behind ``start``."""

    whole: int
    first: int
    count: int
    start: int

    @property
    def length(self) -> int:
        return self.whole - self.start


@dataclass
class Plan:
    """Places: of the pieces of ``length`` with ranks from ``first`` on, ``count`` in number, the tokens from ``start``
    to ``stop`` lie at ``offset`` and behind, ``each`` in a sequence, in sequences from ``sequence`` on."""

    sequences: int = 0
    rows: list[tuple[int, ...]] = field(default_factory=list)

    def put(self, parts: list[tuple[Stock, int, int]], times: int) -> None:
        """``times`` sequences that each hold ``each`` parts of every stock, cut behind ``stop`` tokens of the piece."""
        offset = 0
        for stock, each, stop in parts:
            self.rows.append((stock.whole, stock.first, each * times, stock.start, stop, each, self.sequences, offset))
            offset += each * (stop - stock.start)
        self.sequences += times


class Shelf:
    """Stocks by the length of their parts."""

    def __init__(self, window: int):
        self.by_length: dict[int, list[Stock]] = {}
        self.there = np.zeros(window + 1, bool)
        self.lengths: list[int] = []

    def add(self, stock: Stock) -> None:
        if stock.count and stock.length:
            if not self.there[stock.length]:
                self.by_length[stock.length] = []
                self.there[stock.length] = True
                insort(self.lengths, stock.length)
            self.by_length[stock.length].append(stock)

    def drop(self, stock: Stock) -> None:
        own = self.by_length[stock.length]
        own.remove(stock)
        if not own:
            self.there[stock.length] = False
            self.lengths.pop(bisect_left(self.lengths, stock.length))


def _pattern(shelf: Shelf, window: int) -> list[tuple[Stock, int, int]]:
    """Parts that fill ``window`` exactly: (stock, how many, where they end in their pieces). Only the last may be cut."""
    taken: dict[int, list] = {}

    def free(length: int) -> Stock | None:
        for s in shelf.by_length.get(length, ()):
            if id(s) not in taken or taken[id(s)][1] < s.count:
                return s
        return None

    def take(length: int) -> None:
        s = free(length)
        taken.setdefault(id(s), [s, 0])[1] += 1

    room = window
    while room:
        if shelf.there[room] and free(room):
            take(room)
            room = 0
            continue
        if taken and room > 1:
            # Two lengths that fill the room, the longer one as long as possible.
            half = np.flatnonzero(shelf.there[1 : room // 2 + 1]) + 1
            for low in half[shelf.there[room - half]].tolist():
                high = room - low
                if free(low) and free(high) and (low != high or sum(s.count - (taken[id(s)][1] if id(s) in taken else 0) for s in shelf.by_length[low]) > 1):
                    take(high), take(low)
                    room = 0
                    break
            if not room:
                continue
        at = bisect_left(shelf.lengths, room) - 1
        while at >= 0 and not free(shelf.lengths[at]):
            at -= 1
        if at >= 0:
            take(shelf.lengths[at])
            room -= shelf.lengths[at]
            continue
        # Nothing fits: the longest part that is left gives what the room holds.
        long = next(s for length in reversed(shelf.lengths) if (s := free(length)))
        parts = [(s, k, s.whole) for s, k in taken.values()]
        if id(long) in taken:
            # Ranks of one stock are dealt in one go, so its cut part is a stock of its own.
            rest = Stock(long.whole, long.first + long.count - 1, 1, long.start)
            long.count -= 1
            shelf.add(rest)
            long = rest
        return [*parts, (long, 1, long.start + room)]
    return [(s, k, s.whole) for s, k in taken.values()]


def greedy(stocks: list[Stock], window: int, plan: Plan) -> None:
    """Pack ``stocks`` into full windows, and what doesn't fill one into sequences of powers of two."""
    shelf = Shelf(window)
    for s in stocks:
        shelf.add(s)
    total = sum(s.count * s.length for s in stocks)
    tail = total % window
    todo = [[window, total // window]] + [[1 << k, 1] for k in reversed(range(window.bit_length())) if tail >> k & 1]
    for size, times in todo:
        while times:
            parts = _pattern(shelf, size)
            n = min(times, *(s.count // k for s, k, _ in parts))
            plan.put(parts, n)
            times -= n
            for s, k, stop in parts:
                used = Stock(s.whole, s.first, k * n, s.start)
                shelf.drop(s)
                shelf.add(Stock(s.whole, s.first + k * n, s.count - k * n, s.start))
                if stop < s.whole:
                    shelf.add(Stock(used.whole, used.first, used.count, stop))


def plan_packing(counts: dict[int, int], window: int = 1024, depth: int = 3) -> Plan:
    """Where the pieces of each length go: ``counts[length]`` pieces of 1 to ``window`` tokens."""
    left = np.zeros(window + 1, np.int64)
    for length, n in counts.items():
        left[length] = n
    plan, next_rank = Plan(), np.zeros(window + 1, np.int64)
    combos = combinations_filling(np.flatnonzero(left), window, depth)
    for combo, n in rounded(combos, solve_repeats(combos, left), left):
        parts = []
        for length in sorted(set(combo), reverse=True):
            parts.append((Stock(length, int(next_rank[length]), n * combo.count(length), 0), combo.count(length), length))
            next_rank[length] += n * combo.count(length)
        plan.put(parts, n)
    greedy([Stock(int(m), int(next_rank[m]), int(left[m]), 0) for m in np.flatnonzero(left)], window, plan)
    return plan


def _tables(plan: Plan) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length, the rows of whole pieces by rank, and those of cut ones."""
    by_length: dict[int, tuple[list, list]] = {}
    for length, first, count, start, stop, each, sequence, offset in plan.rows:
        whole, cut = by_length.setdefault(length, ([], []))
        (whole if stop - start == length else cut).append((first, count, start, stop, each, sequence, offset))
    return {
        length: tuple(np.array(sorted(rows), np.int64).reshape(-1, 7) for rows in both) for length, both in by_length.items()
    }


def document_pieces(docs: DataFrame, tokenizer: str, window: int = 1024, end: int = 0) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, ids`` of every document's whole windows and its rest.

    ``ids`` holds the ids as little-endian unsigned 32-bit numbers.
    """

    def run(batches):
        tokens = once_per_worker(f"tokens {tokenizer}", lambda: Tokens(tokenizer))
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.array(tokens.ids(text or "") + [end], "<u4")
                for start in range(0, len(ids), window):
                    raw = ids[start : start + window].tobytes()
                    rows.append((doc, start, len(raw) // 4, zlib.crc32(raw), len(ids), raw))
            kinds = [pa.int64()] * 5 + [pa.binary()]
            columns = list(zip(*rows)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    text = F.make_valid_utf8(F.col("text").cast("string"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary")


def pack_by_least_squares(docs: DataFrame, tokenizer: str | None = None, window: int = 1024, end: int = 0, depth: int = 3,
                          with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``) for every piece of ``docs``.

    ``docs`` has doc_id and text; a document is its token ids and ``end``. A null text is empty,
    bytes that are not UTF-8 are replaced, a null doc_id is kept, rows that repeat a doc_id are
    packed each, other columns are ignored; an empty table gives an empty table. Each id lies in
    exactly one piece. Offsets within a sequence run from 0 without gaps; a sequence holds
    ``window`` tokens, a power of two, or a smaller power of two.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    if window & (window - 1):
        raise ValueError("the window must be a power of two")
    spark = docs.sparkSession
    pieces = written(
        document_pieces(docs, tokenizer, window, end).withColumn("row", F.monotonically_increasing_id()), "document-pieces"
    )
    narrow = pieces.drop("ids")
    salts = max(64, -(-pieces.count() // RANKED_BY_SALT))
    salt = F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int")
    salted = narrow.withColumn("salt", salt)
    sums = written(salted.groupBy("length", "salt").agg(F.count("*").alias("n")), "length-counts")
    counts = {int(r[0]): int(r[1]) for r in sums.groupBy("length").agg(F.sum("n")).collect()}
    # At most a row for each part of a combination in use and for each step of the greedy rest.
    table = spark.sparkContext.broadcast(_tables(plan_packing(counts, window, depth)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    ranked = (
        salted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("row")) - 1)
        .join(starts, ["length", "salt"])
        .select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "row", (F.col("rank") + F.col("begin")).alias("rank"))
    )
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row", "sequence_id", "offset", "cut"]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            start, lengths, rank = (batch.column(c).to_numpy() for c in (1, 2, 6))
            order = np.argsort(lengths, kind="stable")
            picks = []
            for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1):
                whole, cut = table.value[int(lengths[part[0]])]
                if len(whole):
                    g = np.searchsorted(whole[:, 0], rank[part], "right") - 1
                    ok = (g >= 0) & (rank[part] < whole[g, 0] + whole[g, 1])
                    picks.append((part[ok], whole[g[ok]], False))
                for row in cut:
                    ok = (rank[part] >= row[0]) & (rank[part] < row[0] + row[1])
                    picks.append((part[ok], np.repeat(row[None], ok.sum(), axis=0), True))
            at = np.concatenate([p[0] for p in picks])
            rows = np.concatenate([p[1] for p in picks])
            first, _, begin, stop, each, sequence, offset = rows.T
            within = rank[at] - first
            out = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [out.column(0), pa.array(start[at] + begin), pa.array(stop - begin), out.column(3), out.column(4), out.column(5),
                 pa.array(sequence + within // each), pa.array(offset + within % each * (stop - begin)),
                 pa.array(np.where(np.repeat([p[2] for p in picks], [len(p[0]) for p in picks]), start[at], -1))],
                names=names,
            )

    kinds = ", ".join(f"{n} long" for n in names)
    placed = ranked.mapInArrow(run, kinds)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    if with_ids:
        begin = F.col("start") - F.col("cut")
        both = placed.join(pieces.select("row", "ids"), "row").withColumn(
            "ids", F.when(F.col("cut") < 0, F.col("ids")).otherwise(F.substring("ids", (begin * 4 + 1).cast("int"), (F.col("length") * 4).cast("int")))
        )
        return both.withColumn("ids_crc32", F.crc32("ids")).select(*columns, "ids")
    placed = written(placed, "placed-pieces")
    # Few pieces are cut as a rule: these are counted and go to the ids, else both sides are exchanged.
    cut = pieces.select("row", "ids").join(handed_out(placed.filter("cut >= 0")), "row")
    own = F.substring("ids", ((F.col("start") - F.col("cut")) * 4 + 1).cast("int"), (F.col("length") * 4).cast("int"))
    return placed.filter("cut < 0").select(*columns).unionByName(cut.withColumn("ids_crc32", F.crc32(own)).select(*columns))

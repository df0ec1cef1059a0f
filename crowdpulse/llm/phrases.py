"""Phrase collocations on a weighted de Bruijn graph of words.

The longest grams are the edges of the graph: an edge of ``order`` words leads from the node of its
first words to the node of its last ones. Every word of a piece begins one edge; near the end of
the piece, where words are missing, end marks take their places. Edges are added up in blocks of
texts, exchanged and added up again. Shorter counts come from the flow of the nodes: a shorter
phrase is counted as often as edges leave its node, those with an end mark (the corrections for
ends of pieces) included, so no shorter gram is ever read from the text. Frequent edges are then
compacted: nodes with one edge in and one out and no other flow join these to one path.

Between tasks grams travel as packed rows: the distinct words of a slice once, the grams as numbers
of these words, and their counts. Slices are cut by a hash of the whole gram, so neither a frequent
word nor a frequent pair is one task's work.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import written

#: Characters that end a piece, fixed by the contract; words are parted by space and tab.
MARKS = b".,;:!?\n\x0b\x0c\r"
FOLD = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ\t" + MARKS, b"abcdefghijklmnopqrstuvwxyz " + b"." * len(MARKS)
)
#: Bytes of text that a task reads into numbers and adds up at a time, and of all text for one slice of the exchange.
CHUNK, BLOCK, SLICE = 1 << 20, 8 << 20, 8 << 20
PACKED = "level int, lang string, slice int, words binary, grams binary, counts binary"
COLUMNS = ["level", "lang", "slice", "words", "grams", "counts"]


class Numbers:
    """Numbers of the distinct words of texts, lower-cased; 0 stands for no word and ends a piece."""

    def __init__(self):
        self.of = defaultdict(count().__next__)
        self.of[b"."]

    def read(self, texts: list[bytes]) -> np.ndarray:
        """The texts as numbers of their words, a 0 behind each."""
        line = b".".join([*texts, b""]).translate(FOLD).replace(b".", b" . ")
        return np.fromiter(map(self.of.__getitem__, line.split()), np.int32)

    def words(self) -> list[bytes]:
        return [b"", *list(self.of)[1:]]


def edges_of(found: np.ndarray, order: int) -> list[np.ndarray]:
    """The edge that each word begins, as ``order`` columns; columns behind the end of a piece are 0."""
    padded = np.concatenate([found, np.zeros(order, found.dtype)])
    starts = np.flatnonzero(found)
    columns = [padded[starts]]
    for k in range(1, order):
        columns.append(np.where(columns[-1] == 0, 0, padded[starts + k]))
    return columns


def added_up(columns: list[np.ndarray], size: int, weights: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of ``columns`` (numbers below ``size``) in order, and the sum of their weights (1 each)."""
    if not len(columns[0]):
        return columns, np.zeros(0, np.int64)
    code, span = columns[0].astype(np.int64), size
    for c in columns[1:]:
        if span * size >= 1 << 63:
            distinct, code = np.unique(code, return_inverse=True)
            span = len(distinct)
        code, span = code * size + c, span * size
    by = np.argsort(code, kind="stable")
    code = code[by]
    first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
    sums = np.diff(np.append(first, len(code))) if weights is None else np.add.reduceat(weights[by], first)
    return [c[by[first]] for c in columns], sums


def slice_of(prints: np.ndarray, columns: list[np.ndarray], slices: int) -> np.ndarray:
    """The slice of each gram by a hash of all its words, whose own hashes are ``prints``."""
    h = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        h = (h ^ prints[c]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return ((h >> np.uint64(20)) % np.uint64(slices)).astype(np.int64)


def packed(level: int, lang: str, words: list[bytes], columns: list[np.ndarray], counts: np.ndarray, slices: int):
    """Packed rows of the grams, one per slice."""
    if not len(counts):
        return
    used = np.unique(np.concatenate(columns))
    prints = np.zeros(len(words), np.uint64)
    prints[used] = [xxhash.xxh64_intdigest(words[i]) for i in used.tolist()]
    at = slice_of(prints, columns, slices)
    by = np.argsort(at, kind="stable")
    ends = np.searchsorted(at[by], np.arange(slices + 1))
    local = np.zeros(len(words), np.int64)
    for s in range(slices):
        rows = by[ends[s] : ends[s + 1]]
        if not len(rows):
            continue
        own = [c[rows] for c in columns]
        names = np.unique(np.concatenate(own))
        local[names] = np.arange(len(names))
        kind = "<u2" if len(names) <= 1 << 16 else "<u4"
        yield (
            level, lang, s, b" ".join([words[i] for i in names.tolist()]),
            b"".join(local[c].astype(kind).tobytes() for c in own), counts[rows].astype("<i8").tobytes(),
        )


def unpacked(level: int, words: bytes, grams: bytes, counts: bytes):
    """Words, columns and counts of a packed row. Words hold no space; an end mark is an empty word."""
    n = np.frombuffer(counts, "<i8")
    flat = np.frombuffer(grams, "<u2" if len(grams) == 2 * level * len(n) else "<u4")
    return words.split(b" "), flat.reshape(level, len(n)), n


def _batch(rows: list[tuple]) -> pa.Table:
    kinds = [pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    columns = list(zip(*rows)) or [()] * len(kinds)
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names=COLUMNS)


def _edges(docs: DataFrame, order: int, slices: int) -> DataFrame:
    def run(batches):
        texts, numbers, read, size, held = defaultdict(list), defaultdict(Numbers), defaultdict(list), 0, 0

        def to_numbers():
            for lang, own in texts.items():
                read[lang].append(numbers[lang].read(own))
            texts.clear()

        def flush():
            for lang in list(read):
                words = numbers.pop(lang).words()
                columns, counts = added_up(edges_of(np.concatenate(read.pop(lang)), order), len(words))
                # One slice at a time, so that rows leave the task in small batches.
                for row in packed(order, lang, words, columns, counts, slices):
                    yield from _batch([row]).to_batches()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                texts[lang].append(text)
                held += len(text) + 64
                if held >= CHUNK:
                    to_numbers()
                    size, held = size + held, 0
                    if size >= BLOCK:
                        yield from flush()
                        size = 0
        to_numbers()
        yield from flush()

    text = F.coalesce(F.col("text").cast("string").cast("binary"), F.lit(b""))
    lang = F.make_valid_utf8(F.coalesce(F.col("lang").cast("string"), F.lit("und")))
    return docs.select(lang.alias("lang"), text.alias("text")).mapInArrow(run, PACKED)


def _reduce(rows: DataFrame, level: int, least: int, slices: int) -> DataFrame:
    """Whole counts of the grams of ``level`` words.

    Grams counted ``least`` times or more come out with their level negative, which later rounds
    pass on; the flow of all grams' nodes comes out as grams that are a word shorter, to be added up.
    """

    def run(key, table):
        lang, own_slice = (k.as_py() for k in key)
        out, number = [], defaultdict(count().__next__)
        number[b""]
        columns, counts = [], []
        # Row by row: a packed row is unpacked into numbers before the next is looked at.
        for i in range(table.num_rows):
            at, *row = (table.column(c)[i].as_py() for c in ("level", "words", "grams", "counts"))
            if at < 0:
                out.append((at, lang, own_slice, *row))
                continue
            words, grams, n = unpacked(level, *row)
            own = np.fromiter(map(number.__getitem__, words), np.int32, len(words))
            columns.append(own[grams])
            counts.append(n)
        del table
        if columns:
            words = list(number)
            columns, counts = added_up(list(np.concatenate(columns, axis=1)), len(words), np.concatenate(counts))
            often = (counts >= least) & (columns[-1] > 0)
            found = packed(-level, lang, words, [c[often] for c in columns], counts[often], 1)
            out += [(at, lang, own_slice, *row) for at, _, _, *row in found]
            if level > 1:
                nodes, flow = added_up(columns[:-1], len(words), counts)
                out += packed(level - 1, lang, words, nodes, flow, slices)
            else:
                # The flow of no words: all word occurrences.
                out.append((0, lang, own_slice, b"", b"", np.array([counts.sum()], "<i8").tobytes()))
        return _batch(out)

    return rows.groupBy("lang", "slice").applyInArrow(run, PACKED)


def phrase_counts(docs: DataFrame, order: int = 3, least: int = 10) -> DataFrame:
    """``lang, words, n``: how often each phrase of 1 to ``order`` words occurs, if ``least`` times or more.

    ``docs`` has text and lang (null: ``und``). A-Z count as a-z, pieces end at ``MARKS``, phrases
    lie within a piece and may overlap. An empty array of words has the number of all word
    occurrences of its lang. Null and empty texts hold no word; repeated rows count each; other
    columns are ignored; an empty table gives an empty table. Written once.
    """
    if order < 2:
        raise ValueError("edges join two nodes, so they have two words at least")
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    slices = max(1, -(-size // SLICE))
    rows = _edges(docs, order, slices)
    for level in range(order, 0, -1):
        rows = _reduce(rows, level, least, slices)

    def run(batches):
        for batch in batches:
            for level, lang, row in zip(batch.column(0).to_pylist(), batch.column(1), zip(*(c.to_pylist() for c in batch.columns[2:]))):
                if not level:
                    n = np.frombuffer(row[2], "<i8")
                    grams = [[]]
                else:
                    words, columns, n = unpacked(-level, *row)
                    grams = [[words[i] for i in g] for g in columns.T.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang.as_py()] * len(n), pa.string()), pa.array(grams, pa.list_(pa.binary())), pa.array(n, pa.int64())],
                    names=["lang", "words", "n"],
                )

    plain = rows.select("level", "lang", "words", "grams", "counts").mapInArrow(run, "lang string, words array<binary>, n long")
    plain = written(plain.withColumn("words", F.transform("words", lambda w: w.cast("string"))), "phrase-counts")
    totals = plain.filter(F.size("words") == 0).groupBy("lang", "words").agg(F.sum("n").alias("n"))
    return plain.filter(F.size("words") > 0).unionByName(totals)


def compact_paths(grams: DataFrame, order: int, max_rounds: int = 40) -> DataFrame:
    """``lang, words, n``: the frequent edges among ``grams`` (as ``phrase_counts`` gives them), unary paths as one row.

    A node is inside a path if one frequent edge enters it and one leaves it, both as often as the
    node's own phrase occurs: whoever reads the phrase reads the whole path. Other edges are paths
    of their own. Positions on the paths are found by pointer doubling, log2(longest path) joins;
    a path is no longer than the longest piece of text.
    """
    edges = written(
        grams.filter(F.size("words") == order).select(
            F.monotonically_increasing_id().alias("id"), "lang", "words", "n",
            F.slice("words", 1, order - 1).alias("source"), F.slice("words", 2, order - 1).alias("target"),
        ),
        "phrase-edges",
    )

    def side(column: str, name: str) -> DataFrame:
        return edges.groupBy("lang", F.col(column).alias("words")).agg(
            F.count("*").alias(f"{name}_degree"), F.max("n").alias(f"{name}_n"), F.max("id").alias(name)
        )

    inner = (
        side("target", "before").join(side("source", "after"), ["lang", "words"])
        .filter("before_degree = 1 and after_degree = 1 and before_n = after_n")
        .join(grams.filter(F.size("words") == order - 1), ["lang", "words"]).filter("n = before_n")
    )
    # Pieces begin and end, so unary nodes never close a circle.
    links = written(inner.select(F.col("after").alias("id"), F.col("before").alias("head"), F.lit(1).alias("steps")), "path-links")
    for _ in range(max_rounds):
        ahead = links.select(F.col("id").alias("head"), F.col("head").alias("next"), F.col("steps").alias("more"))
        links = written(
            links.join(ahead, "head", "left").select(
                "id", F.coalesce("next", "head").alias("head"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"),
                F.col("next").isNotNull().alias("moved"),
            ),
            "path-links",
        )
        if not links.filter("moved").limit(1).count():
            break
    else:
        raise RuntimeError(f"paths did not settle in {max_rounds} rounds")
    placed = edges.join(links, "id", "left").select(
        F.coalesce("head", "id").alias("head"), F.coalesce("steps", F.lit(0)).alias("steps"), "lang", "words", "n"
    )
    alone = placed.join(links.select("head").distinct(), "head", "left_anti").select("lang", "words", "n")
    rest = F.struct("steps", F.element_at("words", -1).alias("word"))
    joined = (
        placed.join(links.select("head").distinct(), "head", "left_semi").groupBy("head").agg(
            F.first("lang").alias("lang"), F.first("n").alias("n"),
            F.max(F.when(F.col("steps") == 0, F.col("words"))).alias("first"),
            F.sort_array(F.collect_list(F.when(F.col("steps") > 0, rest))).alias("rest"),
        )
        .select("lang", F.concat("first", F.col("rest.word")).alias("words"), "n")
    )
    return alone.unionByName(joined)


def path_counts(grams: DataFrame, paths: DataFrame, order: int) -> DataFrame:
    """``grams`` with the counts of edges, and of nodes inside paths, read off the paths."""
    def windows(size: int, first: int, last):
        starts = F.when(last >= first, F.sequence(F.lit(first), last)).otherwise(F.array().cast("array<int>"))
        return paths.select("lang", "words", "n", F.explode(starts).alias("_at")).select(
            "lang", F.slice("words", F.col("_at"), F.lit(size)).alias("words"), "n"
        )

    edges = windows(order, 1, F.size("words") - order + 1)
    inside = windows(order - 1, 2, F.size("words") - order + 1)
    others = grams.filter(F.size("words") < order).join(inside.select("lang", "words"), ["lang", "words"], "left_anti")
    return edges.unionByName(inside).unionByName(others)


def collocations(docs: DataFrame, order: int = 3, least: int = 10, absorbed: int = 50, top: int = 2000) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of 2 to ``order`` words of each lang.

    ``a`` is the count of the phrase, at least ``least``. Cut after its first k words it scores
    floor(1000000 * a * a / (l * r)), with ``l`` and ``r`` the counts of the two parts; the cut with
    the lowest score counts, of equal ones the first. A phrase that lies inside a longer candidate
    with ``absorbed`` percent of its count or more is dropped. Order: score and ``a`` descending,
    then the phrase by its bytes. ``n`` is the number of words of the lang. Arithmetic is exact, in
    38 digits. For nulls, repeats and empty tables see ``phrase_counts``.
    """
    counted = phrase_counts(docs, order, least)
    paths = written(compact_paths(counted, order), "phrase-paths")
    grams = written(path_counts(counted.filter(F.size("words") > 0), paths, order), "phrase-grams")
    long = grams.filter(F.size("words") > 1)
    cuts = long.select("lang", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k")).select(
        "lang", "words", "a", "k", F.slice("words", F.lit(1), F.col("k")).alias("left"),
        F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")).alias("right"),
    )
    # A phrase's parts occur as often as it does at least, so both are among the grams.
    cuts = cuts.join(grams.select("lang", F.col("words").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(grams.select("lang", F.col("words").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    a, l, r = (F.col(c).cast("decimal(38,0)") for c in "alr")
    score = F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(38,0)"), l * r).cast("long")
    best = cuts.groupBy("lang", "words").agg(
        F.first("a").alias("a"), F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    )
    inside = (
        long.filter(F.size("words") > 2)
        .select("lang", "words", "n", F.explode(F.sequence(F.lit(2), F.size("words") - 1)).alias("size"))
        .select("lang", "words", "n", "size", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
        .groupBy("lang", F.slice("words", F.col("at"), F.col("size")).alias("words")).agg(F.max("n").alias("longer"))
    )
    kept = best.join(inside, ["lang", "words"], "left").filter(F.expr(f"longer is null or 100 * longer < {absorbed} * a"))
    kept = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    totals = counted.filter(F.size("words") == 0).select("lang", "n")
    return kept.withColumn("rank", place.cast("long")).filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )

"""Cross-tokenizer alignment: links between the tokens of two tokenizations of one text.

Each tokenization is an incidence matrix with a row for every token and a column for every byte,
in compressed sparse rows (CSR) built here. Gustavson's row products of one matrix with the
transpose of the other give the links: on all bytes of the tokens, the pairs that overlap, with the
number of bytes they share; on their last bytes alone, the pairs that end together. Byte offsets
where tokens of both end cut the text into groups, and the product of token-group incidences gives
the pairs that share a group. The texts of a block stand one behind the other in one matrix.

Counts of linked id pairs over the whole corpus go back to the texts block by block: a block keeps
its links as a CSR matrix of texts and distinct pairs, the counts of all blocks are added up pair
by pair, and each block gets those of its own pairs.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.common import once_per_worker, written
from crowdpulse.llm.packing import Tokens

#: Bytes of text in a block, and of matrix entries that a product expands at a time.
BLOCK, STRIP = 1 << 20, 1 << 20
KINDS = ("end", "overlap", "group")


@dataclass
class Csr:
    """A sparse matrix: row i has ``data`` in the columns ``indices``, both from ``indptr[i]`` to ``indptr[i + 1]``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    def rows(self) -> np.ndarray:
        """The row of each entry."""
        return np.repeat(np.arange(len(self.indptr) - 1), np.diff(self.indptr))

    def transposed(self) -> Csr:
        by = np.argsort(self.indices, kind="stable")
        counts = np.bincount(self.indices, minlength=self.columns)
        return Csr(np.concatenate([[0], np.cumsum(counts)]), self.rows()[by], self.data[by], len(self.indptr) - 1)

    def times(self, vector: np.ndarray) -> np.ndarray:
        """The product with a vector."""
        sums = np.concatenate([[0], np.cumsum(self.data * vector[self.indices])])
        return sums[self.indptr[1:]] - sums[self.indptr[:-1]]


def from_pairs(rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int], data: np.ndarray | None = None) -> Csr:
    """The matrix of (row, column) entries; entries of one place are added up."""
    code = rows * shape[1] + columns
    distinct, at = np.unique(code, return_inverse=True)
    sums = np.bincount(at, data, len(distinct)).astype(np.int64) if len(code) else np.zeros(0, np.int64)
    place, width = distinct // max(shape[1], 1), max(shape[1], 1)
    counts = np.bincount(place, minlength=shape[0])
    return Csr(np.concatenate([[0], np.cumsum(counts)]), distinct % width, sums, shape[1])


def spans(starts: np.ndarray, ends: np.ndarray, size: int) -> Csr:
    """Token-byte incidence: row i has a 1 in every column from ``starts[i]`` up to, without, ``ends[i]``."""
    indptr = np.concatenate([[0], np.cumsum(ends - starts)])
    indices = np.arange(indptr[-1]) + np.repeat(starts - indptr[:-1], ends - starts)
    return Csr(indptr, indices, np.ones(len(indices), np.int64), size)


def row_products(a: Csr, b: Csr) -> Csr:
    """``a`` times ``b`` by Gustavson's rule: row i is the sum of the rows of ``b`` that row i of ``a`` names.

    Rows are worked on in strips whose products have at most about ``STRIP`` entries before they
    are added up (a single row may have more).
    """
    width = np.diff(b.indptr)
    # Entries that the rows of a expand to, row by row.
    grown = np.concatenate([[0], np.cumsum(width[a.indices])])[a.indptr]
    parts, first = [], 0
    while first < len(a.indptr) - 1:
        last = max(first + 1, int(np.searchsorted(grown, grown[first] + STRIP, "right")) - 1)
        lo, hi = a.indptr[first], a.indptr[last]
        named = a.indices[lo:hi]
        times = width[named]
        row = np.repeat(np.repeat(np.arange(last - first), np.diff(a.indptr[first : last + 1])), times)
        begin = np.cumsum(times) - times
        at = np.arange(times.sum()) + np.repeat(b.indptr[named] - begin, times)
        parts.append(from_pairs(row, b.indices[at], (last - first, b.columns), np.repeat(a.data[lo:hi], times) * b.data[at]))
        first = last
    if not parts:
        return Csr(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), b.columns)
    indptr = np.concatenate([[0], *(p.indptr[1:] for p in parts)])
    at = 1
    for k, p in enumerate(parts):
        n = len(p.indptr) - 1
        indptr[at : at + n] += sum(len(q.indices) for q in parts[:k])
        at += n
    return Csr(indptr, np.concatenate([p.indices for p in parts]), np.concatenate([p.data for p in parts]), b.columns)


def links(ends_a: np.ndarray, ends_b: np.ndarray, kind: str = "end") -> Csr:
    """Rows are the tokens of A, columns those of B; an entry is a link.

    ``ends_a`` and ``ends_b`` are the byte offsets behind the tokens, in order, and finish at the
    same one. ``end``: both tokens end there. ``overlap``: they share the bytes that the entry counts.
    ``group``: they lie in one group; as many entries as a group has pairs.
    """
    if kind not in KINDS:
        raise ValueError(f"unknown kind of links {kind}")
    size = int(ends_a[-1]) if len(ends_a) else 0
    if kind == "overlap":
        a, b = (spans(np.concatenate([[0], e[:-1]]), e, size) if len(e) else spans(e, e, size) for e in (ends_a, ends_b))
    elif kind == "end":
        # Column k is the offset k, so that tokens without bytes have a place too.
        a, b = (Csr(np.arange(len(e) + 1), e, np.ones(len(e), np.int64), size + 1) for e in (ends_a, ends_b))
    else:
        common = cuts(ends_a, ends_b)
        a, b = (
            Csr(np.arange(len(e) + 1), np.searchsorted(common, e), np.ones(len(e), np.int64), len(common)) for e in (ends_a, ends_b)
        )
    return row_products(a, b.transposed())


def cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The offsets where tokens of both end, in order."""
    marked = np.zeros((ends_a[-1] if len(ends_a) else 0) + 1, bool)
    marked[ends_a] = True
    both = ends_b[marked[ends_b]]
    return both[np.append(both[1:] != both[:-1], True)] if len(both) else both


class TwoTokenizers:
    """Ids and bytes of the tokens of A (a ``tokenizers`` byte-level file) and B (a ``sentencepiece`` file).

    A reads space + text and B, which puts a space before a text itself, the text; strings of
    special tokens are plain text to both.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = Tokens(path_a)
        self.a.full.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [n for n in range(256) if n not in set(shown)]
        byte_of = {chr(n): n for n in shown} | {chr(256 + i): n for i, n in enumerate(hidden)}
        vocabulary = self.a.full.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [(i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces
        ]
        self.sizes = tuple(np.array([len(x) for x in table], np.int64) for table in (self.bytes_a, self.bytes_b))
        # Each id as text with what may follow it within the groups: another of its side, the other side, the next group.
        n = max(len(self.bytes_a), len(self.bytes_b))
        self.written = [b"%d%s" % (i, mark) for mark in (b",", b"|", b";") for i in range(n)]
        self.n = n

    def ids(self, texts: list[bytes | None]) -> tuple[list[list[int]], list[list[int]]]:
        """The ids of each text by A and by B; none for texts that either can't give back, and for null and empty ones."""
        plain = []
        for text in texts:
            try:
                plain.append((text or b"").decode())
            except UnicodeDecodeError:
                plain.append("")
        a = [self.a.ids(" " + t) if t else [] for t in plain]
        b = self.b.encode(plain, num_threads=1) if plain else []
        for k, t in enumerate(plain):
            whole = b" " + texts[k] if t else b""
            if not t or b"".join(map(self.bytes_a.__getitem__, a[k])) != whole or b"".join(map(self.bytes_b.__getitem__, b[k])) != whole:
                a[k], b[k] = [], []
        return a, b


@dataclass
class Aligned:
    """A block of texts: its tokens, groups and links, the rows of each text one behind the other."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    link_text: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray


def align(tokens: TwoTokenizers, texts: list[bytes | None], kind: str = "end") -> Aligned:
    """Groups as text (``a1,a2|b1;a3|b2,b3``) and links of ``kind`` as pairs of ids, for each text of a block."""
    ids = tokens.ids(texts)
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in ids)
    a, b = (np.fromiter(chain.from_iterable(side), np.int64, n.sum()) for side, n in zip(ids, (n_a, n_b)))
    ends_a, ends_b = np.cumsum(tokens.sizes[0][a]), np.cumsum(tokens.sizes[1][b])
    text_a = np.repeat(np.arange(len(texts)), n_a)
    common = cuts(ends_a, ends_b)
    group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
    # A text's last tokens end together, so no group reaches over two texts.
    text_of_group = np.zeros(len(common), np.int64)
    text_of_group[group_a] = text_a
    n_groups = np.bincount(text_of_group, minlength=len(texts))

    last_a, last_b = (np.append(g[1:] != g[:-1], True) if len(g) else np.zeros(0, bool) for g in (group_a, group_b))
    code = np.concatenate([a + tokens.n * last_a, b + 2 * tokens.n * last_b])
    order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
    names = list(map(tokens.written.__getitem__, code[order].tolist()))
    ends = np.concatenate([[0], np.cumsum(n_a + n_b)]).tolist()
    groups = [b"".join(names[i:j])[:-1] for i, j in zip(ends, ends[1:])]

    found = links(ends_a, ends_b, kind)
    row = found.rows()
    text = text_a[row]
    return Aligned(n_a, n_b, n_groups, np.bincount(text, minlength=len(texts)), groups, text, a[row], b[found.indices])


def _blocks(docs: DataFrame, path_a: str, path_b: str, kind: str) -> DataFrame:
    """One row a block: the columns of its texts as arrays, its distinct id pairs and counts, and its text-pair matrix."""

    def run(batches):
        tokens = once_per_worker(f"two tokenizers {path_a} {path_b}", lambda: TwoTokenizers(path_a, path_b))
        docs_held, texts, size = [], [], 0

        def flush():
            found = align(tokens, texts, kind)
            pair = found.link_a << 32 | found.link_b
            distinct, at = np.unique(pair, return_inverse=True)
            matrix = from_pairs(found.link_text, at, (len(texts), len(distinct)))
            totals = np.bincount(at, minlength=len(distinct)).astype(np.int64)
            sha = [hashlib.sha256(g).hexdigest() if n else "" for g, n in zip(found.groups, found.n_a)]
            lists = [docs_held, found.n_a, found.n_b, found.n_groups, found.n_links]
            columns = [pa.array([x], pa.list_(pa.int64())) for x in lists] + [pa.array([sha], pa.list_(pa.string()))]
            raw = [distinct, totals, matrix.indptr, matrix.indices.astype("<u4"), matrix.data.astype("<u4")]
            columns += [pa.array([x.tobytes()], pa.binary()) for x in raw]
            return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in fields])

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                docs_held.append(doc), texts.append(text)
                size += len(text or b"") + 64
                if size >= BLOCK:
                    yield flush()
                    docs_held, texts, size = [], [], 0
        if texts:
            yield flush()

    fields = [
        "doc_id array<long>", "n_a array<long>", "n_b array<long>", "n_groups array<long>", "n_links array<long>", "sha array<string>",
        "pairs binary", "totals binary", "indptr binary", "indices binary", "times binary",
    ]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, ", ".join(fields)).withColumn("block", F.monotonically_increasing_id())


def pair_counts(blocks: DataFrame) -> DataFrame:
    """``a_id, b_id, n, best``: links of each id pair over all blocks, and whether it has the most of its B id (ties too)."""
    total = _block_pairs(blocks).groupBy("pair").agg(F.sum("n").alias("n")).select(
        "pair", F.shiftright("pair", 32).alias("a_id"), F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)).alias("b_id"), "n"
    )
    total = written(total, "pair-counts")
    most = total.groupBy("b_id").agg(F.max("n").alias("most"))
    return total.join(most, "b_id").select("pair", "a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("best"))


def _block_pairs(blocks: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, pairs, totals in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                pair, n = np.frombuffer(pairs, np.int64), np.frombuffer(totals, np.int64)
                for at in range(0, len(pair), 1 << 16):
                    part = slice(at, at + (1 << 16))
                    size = len(pair[part])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(size, block)), pa.array(np.arange(at, at + size, dtype=np.int32)), pa.array(pair[part]), pa.array(n[part])],
                        names=["block", "place", "pair", "n"],
                    )

    return blocks.select("block", "pairs", "totals").mapInArrow(run, "block long, place int, pair long, n long")


def token_links(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, kind: str = "end") -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs`` (doc_id, text).

    ``n_best`` counts the links whose id pair is linked as often, over the whole corpus, as any
    pair of the same B id; ``count_sum`` adds up the pairs' corpus counts over the links. The hash
    is that of the groups as text, '' without tokens. Texts that are null, empty, not UTF-8, or
    that one of the tokenizers can't give back byte for byte have no tokens: zeros. Null ids are
    kept and repeated rows count each; other columns are ignored; an empty table gives an empty
    table. ``path_a`` and ``path_b`` must be open to every executor.
    """
    if path_a is None or path_b is None:
        import public_tokenizers

        path_a = path_a or public_tokenizers.path("byte_bpe_50k.json")
        path_b = path_b or public_tokenizers.path("piece_bpe_32k.model")
    blocks = written(_blocks(docs, path_a, path_b, kind), "token-blocks")
    counts = pair_counts(blocks).select("pair", "n", "best")
    named = _block_pairs(blocks).select("block", "place", "pair").join(counts, "pair").select("block", "place", "n", "best")

    def gathered(key, table):
        by = np.argsort(table.column("place").to_numpy(), kind="stable")
        n, best = table.column("n").to_numpy()[by], table.column("best").to_numpy()[by]
        return pa.table({"block": [key[0].as_py()], "n": [n.tobytes()], "best": [best.astype(np.uint8).tobytes()]})

    # A block holds a bounded stretch of text, so its pairs are a bounded group.
    told = named.groupBy("block").applyInArrow(gathered, "block long, n binary, best binary")

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                raw = {k: np.frombuffer(row[k] or b"", d) for k, d in (
                    ("indptr", np.int64), ("indices", "<u4"), ("times", "<u4"), ("n", np.int64), ("best", np.uint8))}
                matrix = Csr(raw["indptr"], raw["indices"].astype(np.int64), raw["times"].astype(np.int64), len(raw["n"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row[k], pa.int64()) for k in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
                    + [pa.array(matrix.times(raw["best"].astype(np.int64))), pa.array(matrix.times(raw["n"])), pa.array(row["sha"], pa.string())],
                    names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                )

    whole = blocks.drop("pairs", "totals").join(told, "block", "left").drop("block")
    return whole.mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )

"""Packing token sequences: vector best-fit under token, document-count and attention capacities.

Texts become token pieces of at most the sequence's capacity. Pieces of one length are alike, so
the packing is worked out on the number of pieces of each length, a table no larger than the
capacity whatever the corpus: bins of equal content are one group with a multiplicity, and a
length goes to the group with the smallest weighted residual norm (or the largest weighted dot
product) that all capacities allow. Every piece then finds its place by its rank among the pieces
of its length; ranks are counted in salted groups, so that no length is one task's work.
"""

from __future__ import annotations

import json
import re
import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import once_per_worker, written

#: The byte-level pre-tokenizer's pattern, a fixed value of this kind of vocabulary, but for its
#: alternative ``\s+(?!\S)``: that one matters only where white space characters meet.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
RANKED_BY_SALT = 200_000


class Tokens:
    """Token ids as ``tokenizers`` gives them for the vocabulary file ``path`` (no special tokens added).

    For byte-level BPE whose ids follow the order of merges, texts without neighbouring white
    space and without a special token's string take a shorter way to the same ids (four times the
    speed); all others, and other kinds of vocabulary, go through ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        added = [re.escape(t["content"]) for t in spec.get("added_tokens", [])]
        self.slow_text = re.compile("|".join([r"\s\s", *added]))
        self.quick = self._quick(spec, {t["content"] for t in spec.get("added_tokens", [])})

    @staticmethod
    def _quick(spec: dict, added: set):
        before, model = spec.get("pre_tokenizer") or {}, spec["model"]
        plain = spec.get("normalizer") is None and not any(model.get(k) for k in ("dropout", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        if model["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not plain:
            return None
        # Byte-level vocabularies write each byte as a printable character.
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        merged = [ranks[bytes(byte_of[c] for c in "".join(m if isinstance(m, list) else m.split(" ")))] for m in model["merges"]]
        if merged != sorted(merged):
            return None
        import tiktoken

        return tiktoken.Encoding("quick", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> list[int]:
        if self.quick is None or self.slow_text.search(text):
            return self.full.encode(text, add_special_tokens=False).ids
        return self.quick.encode_ordinary(text)


def cut_points(n: int, capacity: int) -> list[tuple[int, int]]:
    """``start, length`` of a document's pieces: whole capacities, the first piece holds the rest."""
    first = n if n <= capacity else n % capacity or capacity
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = 1024, end: int = 2, with_ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` (and ``ids``) for every piece of every row's text."""

    def run(batches):
        tokens = once_per_worker(f"tokens {tokenizer}", lambda: Tokens(tokenizer))
        for batch in batches:
            doc, piece, start, length, crc, ids = [], [], [], [], [], []
            for d, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.array(tokens.ids(text or "") + [end], "<u4")
                for k, (s, n) in enumerate(cut_points(len(found), capacity)):
                    doc.append(d), piece.append(k), start.append(s), length.append(n)
                    crc.append(zlib.crc32(found[s : s + n].tobytes()))
                    if with_ids:
                        ids.append(found[s : s + n].astype(np.int32))
            columns = [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(ids, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names + ["ids"] * with_ids)

    text = F.make_valid_utf8(F.col("text").cast("string"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, schema)


@dataclass
class Group:
    """``count`` bins that all hold ``content``, a list of (length, how often)."""

    count: int
    left: np.ndarray
    content: list[tuple[int, int]] = field(default_factory=list)


def vector_best_fit(counts: dict[int, int], capacity: int, max_documents: int | None = None,
                    max_attention: int | None = None, rule: str = "norm", weights=(1.0, 1.0, 1.0)) -> list[Group]:
    """Pack ``counts[length]`` pieces of each length into groups of equal bins.

    A piece takes (length, 1, length squared) of a bin's (capacity, max_documents, max_attention).
    Longest first, a piece goes to the open bin that fits it and, by ``rule``, leaves the smallest
    residual norm (``norm``) or has the largest dot product of need and residual (``dot``), each
    dimension as a share of its capacity and with its weight; a new bin is opened if none fits. By
    default the documents may be as many as the tokens and the attention as much as one piece of
    all tokens has: these never keep a piece out then, but still take part in the choice of the
    bin. A piece that no empty bin holds raises.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"unknown rule {rule}")
    caps = np.array([capacity, max_documents or capacity, max_attention or capacity**2], float)
    weight = np.array(weights, float)
    left = np.zeros((0, 3))
    groups: list[Group] = []

    def open_group(count, room, content):
        nonlocal left
        groups.append(Group(count, room, content))
        left = np.vstack([left, room])

    def put(content, length, k):
        if content and content[-1][0] == length:
            return [*content[:-1], (length, content[-1][1] + k)]
        return [*content, (length, k)]

    for length in sorted(counts, reverse=True):
        todo, need = counts[length], np.array([length, 1, length**2], float)
        if (need > caps).any():
            raise ValueError(f"a piece of {length} tokens exceeds the capacities of an empty sequence")
        while todo:
            fits = np.flatnonzero((left >= need).all(axis=1)) if len(left) else np.zeros(0, int)
            if len(fits):
                room = (left[fits] - need) / caps
                cost = (weight * room**2).sum(axis=1) if rule == "norm" else -(weight * (need / caps) * (left[fits] / caps)).sum(axis=1)
                g = int(fits[cost.argmin()])
                n = min(todo, groups[g].count)
                after, content = left[g] - need, put(groups[g].content, length, 1)
                if n == groups[g].count:
                    groups[g].content, groups[g].left, left[g] = content, after, after
                else:
                    groups[g].count -= n
                    open_group(n, after, content)
                todo -= n
            else:
                each = int((caps // need).min())
                n, k = (todo // each, each) if todo >= each else (1, todo)
                open_group(n, caps - k * need, [(length, k)])
                todo -= n * k
    return groups


def places(groups: list[Group]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, pieces per bin, first sequence and offset of every group holding it."""
    found: dict[int, list] = {}
    sequence = 0
    for g in groups:
        offset = 0
        for length, k in g.content:
            rows = found.setdefault(length, [])
            rank = rows[-1][0] + rows[-1][4] if rows else 0
            rows.append((rank, k, sequence, offset, k * g.count))
            offset += length * k
        sequence += g.count
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows)) for length, rows in found.items()}


def pack(pieces: DataFrame, capacity: int = 1024, max_documents: int | None = None,
         max_attention: int | None = None, rule: str = "norm") -> DataFrame:
    """``pieces`` (doc_id, piece, length and more) with ``sequence_id`` and ``offset``.

    Offsets within a sequence run without gaps from 0, longest piece first. Null and repeated ids
    are pieces like any other. An empty table gives an empty table.
    """
    numbered = written(pieces.withColumn("_row", F.monotonically_increasing_id()), "numbered-pieces")
    return _packed(numbered, capacity, max_documents, max_attention, rule)


def _packed(pieces: DataFrame, capacity: int, max_documents: int | None, max_attention: int | None, rule: str) -> DataFrame:
    """``pack`` for pieces that are written with a number ``_row`` of their own, which comes out no more."""
    spark = pieces.sparkSession
    salts = max(64, -(-pieces.count() // RANKED_BY_SALT))
    # By number, so that pieces without an id, or with one and the same, spread as well.
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(salts)).cast("int"))
    # One row per length and salt, kept so that every reader sees the same numbers.
    sums = written(salted.groupBy("length", "_salt").agg(F.count("*").alias("n")), "length-counts")
    counts = {int(r[0]): int(r[1]) for r in sums.groupBy("length").agg(F.sum("n")).collect()}
    table = spark.sparkContext.broadcast(places(vector_best_fit(counts, capacity, max_documents, max_attention, rule)))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        F.col("length").alias("_l"), F.col("_salt").alias("_s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")
    )
    mine = Window.partitionBy("length", "_salt").orderBy("_row")
    ranked = salted.withColumn("_rank", F.row_number().over(mine) - 1).join(
        starts, (F.col("length") == F.col("_l")) & (F.col("_salt") == F.col("_s"))
    )
    kept = [f for f in pieces.schema.fields if f.name != "_row"]
    rows = ranked.select(*[F.col(f"`{f.name}`") for f in kept], (F.col("_rank") + F.col("_start")).alias("_rank"))
    at = [f.name for f in kept].index("length")

    def run(batches):
        for batch in batches:
            lengths = batch.column(at).to_numpy()
            ranks = batch.column(batch.num_columns - 1).to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            order = np.argsort(lengths, kind="stable")
            for part in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(order) else []:
                length = int(lengths[part[0]])
                first, k, seq, base, _ = table.value[length]
                g = np.searchsorted(first, ranks[part], "right") - 1
                within = ranks[part] - first[g]
                sequence[part] = seq[g] + within // k[g]
                offset[part] = base[g] + within % k[g] * length
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(sequence), pa.array(offset)],
                names=[*batch.schema.names[:-1], "sequence_id", "offset"],
            )

    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return rows.mapInArrow(run, f"{columns}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end: int = 2,
                   max_documents: int | None = None, max_attention: int | None = None, rule: str = "norm",
                   with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place: the columns of ``token_pieces`` and ``pack``.

    ``docs`` has doc_id and text; a null text is empty, which is one piece that holds the end
    token; bytes that are not UTF-8 are replaced. A null doc_id is kept. Rows that repeat a doc_id are packed each. Other columns are
    ignored. ``tokenizer`` is the path of a vocabulary file that every executor can open.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    pieces = token_pieces(docs, tokenizer, capacity, end, with_ids).withColumn("_row", F.monotonically_increasing_id())
    return _packed(written(pieces, "pieces"), capacity, max_documents, max_attention, rule)

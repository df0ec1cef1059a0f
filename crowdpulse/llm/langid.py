"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts over all training texts are summed task by task into one vector per language, so what is
shuffled grows with tasks and languages, not with n-grams. The model is a matrix of
log-probabilities (buckets x languages, a size fixed by parameters and the number of languages),
which is broadcast; a text's score is the sum of the matrix rows of its n-grams.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNDETERMINED = "und"
#: Code points hashed at a time: bounds the memory that one very long text takes.
STEP = 1 << 18
BLANK = 32


def letter_table() -> np.ndarray:
    """For each code point: the lower-case letter, or a blank for what is no letter."""
    table = np.full(0x110000, BLANK, np.uint32)
    for point in range(0x110000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            table[point] = ord(low) if len(low) == 1 else point
    return table


def letters(text: str, table: np.ndarray) -> np.ndarray:
    """Lower-cased letters with single blanks between and around words; empty without a letter."""
    codes = table[np.frombuffer(text.encode("utf-32-le"), np.uint32)]
    blank = codes == BLANK
    if blank.all():
        return codes[:0]
    blank[1:] &= blank[:-1]
    blank[:1] = codes[:1] == BLANK
    codes = codes[~blank]
    edge = np.array([BLANK], np.uint32)
    return np.concatenate((edge, codes, edge[: int(codes[-1] != BLANK)]))


def ngram_buckets(codes: np.ndarray, orders: int, bits: int):
    """Yield arrays of buckets, one for each n-gram of 1 to ``orders`` letters."""
    for at in range(0, len(codes), STEP):
        part = codes[at : at + STEP + orders - 1]
        h = np.zeros(len(part), np.uint32)
        for n in range(orders):
            h = h[: len(part) - n] * np.uint32(0x01000193) + part[n:]
            g = h[:STEP] + np.uint32(n * 0x3C6EF372 & 0xFFFFFFFF)
            g ^= g >> np.uint32(16)
            g *= np.uint32(0x7FEB352D)
            g ^= g >> np.uint32(15)
            g *= np.uint32(0x9E3779B1)
            yield g >> np.uint32(32 - bits)


#: Texts whose bucket counts make one sparse matrix.
SCORED = 256


@dataclass
class LanguageModel:
    """``weights[bucket, k]`` is the log-probability of a bucket in language ``names[k]``."""

    names: list[str]
    weights: np.ndarray
    prior: np.ndarray
    orders: int
    bits: int


def fit(rows: DataFrame, orders: int = 4, bits: int = 16, alpha: float = 0.5, max_languages: int = 512) -> LanguageModel:
    """The model from all rows (``text``, ``lang``); rows where either is null are passed over.

    Languages beyond ``max_languages`` raise: the matrix is broadcast and its size must be bounded.
    """
    spark = rows.sparkSession
    table = spark.sparkContext.broadcast(letter_table())

    def count(batches):
        counts, docs = {}, {}
        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if lang not in counts:
                    counts[lang], docs[lang] = np.zeros(1 << bits, np.int64), 0
                docs[lang] += 1
                for buckets in ngram_buckets(letters(text, table.value), orders, bits):
                    counts[lang] += np.bincount(buckets, minlength=1 << bits)
        for lang, c in counts.items():
            yield pa.RecordBatch.from_pylist(
                [{"lang": lang, "docs": docs[lang], "counts": c.tobytes()}], schema=schema
            )

    schema = pa.schema([("lang", pa.string()), ("docs", pa.int64()), ("counts", pa.binary())])
    text, lang = (F.make_valid_utf8(F.col(c).cast("string")).alias(c) for c in ("text", "lang"))
    train = rows.select(text, lang).dropna()
    # Counted before any task keeps a vector for each language it meets.
    if train.select("lang").distinct().limit(max_languages + 1).count() > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    partial = train.mapInArrow(count, "lang string, docs long, counts binary")

    def total(batches):
        out = {}
        for batch in batches:
            for lang, docs, c in zip(*(batch.column(i).to_pylist() for i in range(3))):
                c = np.frombuffer(c, np.int64)
                out[lang] = (out[lang][0] + docs, out[lang][1] + c) if lang in out else (docs, c)
        for lang, (docs, c) in out.items():
            yield pa.RecordBatch.from_pylist([{"lang": lang, "docs": docs, "counts": c.tobytes()}], schema=schema)

    # A task's vectors are summed in two steps: first spread by a salt, then by language.
    for salt in (F.spark_partition_id() % 8, F.lit(0)):
        partial = partial.withColumn("salt", salt).repartition("lang", "salt").drop("salt").mapInArrow(
            total, "lang string, docs long, counts binary"
        )
    found = sorted(tuple(r) for r in partial.collect())
    if not found:
        return LanguageModel([], np.zeros((1 << bits, 0), np.float32), np.zeros(0), orders, bits)
    counts = np.stack([np.frombuffer(c, np.int64) for _, _, c in found], axis=1) + alpha
    docs = np.array([d for _, d, _ in found], float)
    weights = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    return LanguageModel([name for name, _, _ in found], weights, np.log(docs / docs.sum()), orders, bits)


def posteriors(texts: list[str], model: LanguageModel, table: np.ndarray) -> np.ndarray:
    """Posterior probabilities, a row for each text; a row of zeros without a letter or a language.

    The texts' bucket counts are a sparse matrix, row by row, and its product with the weights scores
    all of them at once.
    """
    rows, indices, counts = [], [], []
    out = np.zeros((len(texts), len(model.names)))
    for k, text in enumerate(texts):
        codes = letters(text, table)
        if not len(codes) or not model.names:
            continue
        row = np.zeros(1 << model.bits, np.int64)
        for buckets in ngram_buckets(codes, model.orders, model.bits):
            row += np.bincount(buckets, minlength=1 << model.bits)
        found = np.flatnonzero(row)
        rows.append(k), indices.append(found), counts.append(row[found])
    if rows:
        starts = np.cumsum([0] + [len(i) for i in indices[:-1]])
        terms = model.weights[np.concatenate(indices)] * np.concatenate(counts)[:, None].astype(np.float64)
        total = np.add.reduceat(terms, starts, axis=0) + model.prior
        p = np.exp(total - total.max(axis=1, keepdims=True))
        out[rows] = p / p.sum(axis=1, keepdims=True)
    return out


def predict(docs: DataFrame, model: LanguageModel, *carry: Column) -> DataFrame:
    """The columns ``carry``, ``lang_pred`` and ``score`` (its posterior) for every row of ``docs``.

    Only ``text`` is read. A text that is null or has no letter is ``und`` with score 0; so are all
    texts when no language was learned. Equal posteriors go to the first language by code point.
    Repeated rows are scored each; an empty table gives an empty table.
    """
    sc = docs.sparkSession.sparkContext
    # Plain values: broadcasts are not shipped by value as functions and classes are.
    shared = sc.broadcast((model.names, model.weights, model.prior, model.orders, model.bits, letter_table()))

    def run(batches):
        *parts, table = shared.value
        fitted = LanguageModel(*parts)
        for batch in batches:
            names, scores = [], []
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for at in range(0, len(texts), SCORED):
                for p in posteriors(texts[at : at + SCORED], fitted, table):
                    names.append(fitted.names[int(p.argmax())] if p.any() else UNDETERMINED)
                    scores.append(float(p.max(initial=0.0)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*batch.schema.names[:-1], "lang_pred", "score"],
            )

    rows = docs.select(*carry, F.make_valid_utf8(F.col("text").cast("string")).alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, lang_pred string, score double".lstrip(", "))

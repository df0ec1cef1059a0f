"""Quality classifier by positive-unlabelled learning.

Trusted positives and unlabelled web text are all that the weights are fitted on: they minimise
the non-negative unbiased risk  pi * R_P(+) + max(0, R_U(-) - pi * R_P(-))  of a logistic model,
with pi the estimated share of positives in the web text. The fit uses a bounded sample (see
``fit``); every text is read whole and scored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PUNCTUATION = np.frombuffer(bytes(range(33, 48)) + bytes(range(58, 65)) + bytes(range(91, 97)) + bytes(range(123, 127)), np.uint8)
N_SHAPE = 16 + len(PUNCTUATION)


def shape(text: bytes, out: np.ndarray) -> None:
    """Fill ``out`` with the shape of a whole UTF-8 text: sizes, kinds of characters, repetition, punctuation."""
    words = text.split()
    n = len(words)
    if not n:
        return
    size = len(text)
    b = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    counts = Counter(words)
    lines = text.split(b"\n")
    upper, lower, digits = b[65:91].sum(), b[97:123].sum(), b[48:58].sum()
    repeats = sum(map(bytes.__eq__, words, words[1:]))
    most = max(counts.values())
    out[:16] = (
        np.log1p(n), np.log1p(size), size / n / 10, upper / size, lower / size, digits / size, b[128:].sum() / size,
        b[32] / size, len(counts) / n, len(counts) / np.sqrt(n) / 10, repeats / n, most / n,
        np.log1p(len(lines)), len(set(lines)) / len(lines), np.log1p(n / len(lines)), upper / n,
    )
    out[16:] = np.sqrt(b[PUNCTUATION] / n)


def features(texts: list[bytes | None]) -> np.ndarray:
    x = np.zeros((len(texts), N_SHAPE), np.float32)
    for row, text in zip(x, texts):
        shape(text or b"", row)
    return x


@dataclass
class QualityModel:
    """Logistic model on standardised features and on steps at their quantiles."""

    mean: np.ndarray
    scale: np.ndarray
    steps: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def expand(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -6, 6)
        over = [x > s for s in self.steps]
        return np.concatenate([z, *over], axis=1).astype(np.float32)

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.expand(x).astype(np.float64) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


def estimate_prior(p: np.ndarray, u: np.ndarray, delta: float = 0.1) -> float:
    """Share of positives in the unlabelled, from scores of a positive-against-unlabelled model.

    Above any threshold the unlabelled hold at least the prior times the positives' share, and
    about that much where only positives score so high: the smallest ratio, with a margin for
    small samples, is the estimate.
    """
    cuts = np.unique(p)
    above = lambda s: 1 - np.searchsorted(np.sort(s), cuts) / len(s)
    share = above(p)
    margin = np.sqrt(np.log(4 / delta) / 2) * (len(p) ** -0.5 + len(u) ** -0.5)
    good = share > 2 * margin
    bound = (above(u)[good] + margin) / share[good]
    best = int(bound.argmin()) if good.any() else None
    return float(np.clip(above(u)[good][best] / share[good][best], 0.01, 0.99)) if best is not None else 0.5


def risk_slopes(fp: np.ndarray, fu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the non-negative risk by the outputs ``fp`` of positives and ``fu`` of unlabelled rows.

    The risk is prior * mean(l(fp)) + max(0, mean(l(-fu)) - prior * mean(l(-fp))) with the logistic
    loss l(f) = log(1 + e^-f). Where the second part is below zero the slopes lead back up to it
    (the negative of its own), and the first part rests, as the method has it.
    """
    sp, su = 1 / (1 + np.exp(-np.clip(fp, -30, 30))), 1 / (1 + np.exp(-np.clip(fu, -30, 30)))
    if np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean() >= 0:
        # d/df of log(1 + e^-f) is s - 1, of log(1 + e^f) is s.
        return (prior * (sp - 1) - prior * sp) / len(fp), su / len(fu)
    return prior * sp / len(fp), -su / len(fu)


def _descend(z: np.ndarray, positive: np.ndarray, prior: float | None, rounds: int, l2: float, seed: int):
    """Weights by Adam on small batches. Without a prior: positives against unlabelled."""
    rng = np.random.default_rng(seed)
    p, u = np.flatnonzero(positive), np.flatnonzero(~positive)
    w, b = np.zeros(z.shape[1]), 0.0
    m1, m2, step = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    size = 256
    for epoch in range(rounds):
        rate = 0.02 * (1 - epoch / rounds) + 0.0005
        for _ in range(max(20, len(u) // size)):
            i, j = rng.choice(p, min(size, len(p)), replace=False), rng.choice(u, min(size, len(u)), replace=False)
            zi, zj = z[i], z[j]
            fi, fj = zi @ w + b, zj @ w + b
            if prior is None:
                si, sj = 1 / (1 + np.exp(-np.clip(fi, -30, 30))), 1 / (1 + np.exp(-np.clip(fj, -30, 30)))
                ci, cj = (si - 1) / len(i), sj / len(j)
            else:
                ci, cj = risk_slopes(fi, fj, prior)
            g = np.append(zi.T @ ci + zj.T @ cj + l2 * w, ci.sum() + cj.sum())
            step += 1
            m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
            d = rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
            w, b = w - d[:-1], b - d[-1]
    return w, float(b)


def train(x: np.ndarray, positive: np.ndarray, prior: float | None = None, rounds: int = 25, l2: float = 1e-3,
          seed: int = 5) -> QualityModel | None:
    """Fit on rows of ``features``; ``positive`` marks the trusted ones, the rest is unlabelled.

    None without a positive or an unlabelled row. The prior is estimated if it isn't given.
    """
    if not positive.any() or positive.all():
        return None
    steps = np.unique(np.quantile(x, [0.02, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.98], axis=0), axis=0)
    model = QualityModel(x.mean(axis=0), x.std(axis=0) + 1e-3, steps, np.zeros(0), 0.0, 0.5)
    z = model.expand(x)
    if prior is None:
        half = np.random.default_rng(seed).random(len(z)) < 0.5
        w, b = _descend(z[half], positive[half], None, rounds, l2, seed)
        s = z[~half] @ w + b
        prior = estimate_prior(s[positive[~half]], s[~positive[~half]])
    model.prior = float(np.clip(prior, 0.01, 0.99))
    model.weights, model.bias = _descend(z, positive, model.prior, rounds, l2, seed)
    return model


def _sampled(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """About ``most`` of the ids, chosen by a hash of the id; all if there are fewer."""
    n = ids.count()
    limit = int(min(1.0, most / max(n, 1)) * 2**31)
    return ids.filter(F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(2**31)) < limit)


def fit(docs: DataFrame, labels: DataFrame, max_positives: int = 10_000, max_unlabelled: int = 10_000, seed: int = 11) -> QualityModel | None:
    """The model from ``docs`` (doc_id, text) and ``labels`` (doc_id, quality).

    Trusted positives are documents of quality 1; web text is any document, its label unseen.
    About ``max_positives`` and ``max_unlabelled`` of them are sampled by a hash of the id: the
    bound of the rows that the driver fits on, as of rows that repeat an id one is taken. Rows of quality 0 are never used: the prior too is
    estimated from positives and web text (``estimate_prior``). Null ids, texts and labels are
    passed over. None if there is no positive.
    """
    positives = labels.filter("quality = 1 and doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"))
    rows = docs.filter("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    good = _sampled(positives.distinct(), max_positives, seed)
    web = _sampled(rows.select("doc_id"), max_unlabelled, seed + 1).distinct()
    chosen = good.withColumn("positive", F.lit(True)).union(web.withColumn("positive", F.lit(False)))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                x = features(part.column(2).cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([r.tobytes() for r in x], pa.binary())], names=["doc_id", "positive", "x"]
                )

    # The sample is bounded by the two parameters, so it may be broadcast; an id stands for one row, however many repeat it.
    sample = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "positive", "text")
    found = (
        sample.mapInArrow(run, "doc_id long, positive boolean, x binary")
        .groupBy("doc_id", "positive").agg(F.min("x").alias("x")).select("positive", "x").collect()
    )
    if not found:
        return None
    found.sort(key=lambda r: (r[0], bytes(r[1])))  # the order of arrival must not matter
    x = np.stack([np.frombuffer(r[1], np.float32) for r in found])
    return train(x, np.array([r[0] for r in found]))


def score(docs: DataFrame, model: QualityModel | None, *carry: Column) -> DataFrame:
    """The columns ``carry`` and ``score`` (0 to 1, probability of quality 1) for every row of ``docs``.

    Only ``text`` is read; null counts as empty, and an empty text has the features zero. Without a
    model every score is 0.5. Repeated rows are scored each; an empty table gives an empty table.
    """
    # Plain values: broadcasts are not shipped by value as functions and classes are.
    parts = model and (model.mean, model.scale, model.steps, model.weights, model.bias, model.prior)
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches):
        fitted = shared.value and QualityModel(*shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            found = []
            for at in range(0, batch.num_rows, 256):
                x = features(texts.slice(at, 256).cast(pa.binary()).to_pylist())
                found.append(np.full(len(x), 0.5) if fitted is None else fitted.score(x))
            out = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(out, pa.float64())], names=[*batch.schema.names[:-1], "score"]
            )

    rows = docs.select(*carry, F.col("text").cast("string").alias("_text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{kept}, score double".lstrip(", "))

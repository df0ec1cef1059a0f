import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import quality
from crowdpulse.llm.common import fold
from crowdpulse.llm.quality import QualityModel, estimate_prior, features, train


def test_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    held_out = fold("doc_id", 3) == 1
    model = quality.fit(docs.filter(~held_out), labels.filter(~held_out))
    rows = quality.score(docs.filter(held_out), model, F.col("doc_id")).join(labels, "doc_id").select("score", "quality").collect()
    good = [r[0] for r in rows if r[1] == 1]
    bad = [r[0] for r in rows if r[1] == 0]
    above = np.mean([g > b for g in good for b in bad])
    right = np.mean([(s >= 0.5) == (q == 1) for s, q in rows])
    assert above > 0.99 and right > 0.95
    assert np.mean([g >= 0.5 for g in good]) > 0.98


def two_kinds(n, share, seed=0):
    """Texts of which ``share`` are prose and the others one word over and over."""
    rng = np.random.default_rng(seed)
    prose = lambda: " ".join("".join(rng.choice(list("abcdefgh"), rng.integers(2, 8))) for _ in range(60)).capitalize() + "."
    kind = rng.random(n) < share
    return kind, [(prose() if k else "spam! " * int(rng.integers(20, 90))).encode() for k in kind]


def test_labels_of_the_unlabelled_are_not_needed():
    kind, texts = two_kinds(1500, 0.7)
    _, trusted = two_kinds(600, 1.0, seed=1)
    x = features(trusted + texts)
    model = train(x, np.arange(len(x)) < len(trusted))
    assert abs(model.prior - 0.7) < 0.08
    assert np.mean((model.score(x[len(trusted) :]) >= 0.5) == kind) > 0.97


def test_prior_from_scores():
    rng = np.random.default_rng(1)
    p = rng.normal(2, 1, 5000)
    u = np.concatenate([rng.normal(2, 1, 3000), rng.normal(-3, 1, 2000)])
    assert abs(estimate_prior(p, u) - 0.6) < 0.05


def numeric_slopes(f, mask, value):
    return np.array([(value(f + e) - value(f - e)) / 2e-6 for e in np.eye(len(f)) * 1e-6])


@pytest.mark.parametrize("shift", [1.0, -6.0])
def test_risk_slopes_against_numeric_gradients(shift):
    """With the clamp inactive, the gradient of the unbiased risk; with it active, back up the part that fell below zero."""
    rng = np.random.default_rng(2)
    fp, fu, prior = rng.normal(2, 1, 15), rng.normal(shift, 1, 25), 0.4

    def below(fp, fu):
        return np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()

    active = below(fp, fu) < 0
    assert active == (shift < 0)

    def aim(fp, fu):
        return -below(fp, fu) if active else prior * np.logaddexp(0, -fp).mean() + below(fp, fu)

    got_p, got_u = quality.risk_slopes(fp, fu, prior)
    assert np.allclose(got_p, numeric_slopes(fp, None, lambda f: aim(f, fu)), atol=1e-6)
    assert np.allclose(got_u, numeric_slopes(fu, None, lambda f: aim(fp, f)), atol=1e-6)


def test_descent_lowers_the_risk_and_keeps_to_the_clamp():
    rng = np.random.default_rng(3)
    positive = np.arange(900) < 300
    good = positive | (rng.random(900) < 0.3)
    z = np.where(good[:, None], 1.0, -1.0) + rng.normal(size=(900, 2))
    w, b = quality._descend(z, positive, 0.3, 30, 1e-3, 1)
    f = z @ w + b
    clamped = max(0.0, np.logaddexp(0, f[~positive]).mean() - 0.3 * np.logaddexp(0, f[positive]).mean())
    assert 0.3 * np.logaddexp(0, -f[positive]).mean() + clamped < 0.3  # 0.69 at the start
    assert np.mean((f > 0) == good) > 0.85
    # A prior that is far too high would drive the second part below zero without end: the clamp holds the weights.
    w, b = quality._descend(z, positive, 0.95, 60, 0.0, 1)
    f = z @ w + b
    assert np.logaddexp(0, f[~positive]).mean() - 0.95 * np.logaddexp(0, f[positive]).mean() > -1.0
    assert np.abs(w).max() < 20


def test_an_id_on_very_many_rows_is_one_row_of_the_sample(spark, monkeypatch):
    _, texts = two_kinds(300, 0.5)
    rows = [(i, t.decode()) for i, t in enumerate(texts)] + [(7, f"copy {i % 3} of one id") for i in range(600)]
    labels = spark.createDataFrame([(i, int(not t.startswith(b"spam"))) for i, t in enumerate(texts)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda x, positive: seen.append((len(x), int(positive.sum()))))
    quality.fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), labels)
    # All 300 ids as web text, at most one row each, and the good ones once more as positives.
    n_good = sum(not t.startswith(b"spam") for t in texts)
    assert seen == [(300 + n_good, n_good)]


def test_odd_texts_and_tables(spark, crowd):
    _, texts = two_kinds(60, 0.5)
    rows = [(i, t.decode()) for i, t in enumerate(texts)] + [(100, None), (101, ""), (102, "\n"), (None, "x"), (103, "long words " * 200_000), (0, texts[0].decode())]
    docs = crowd(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(not t.startswith(b"spam")), 0) for i, t in enumerate(texts)] + [(100, None, None), (None, 1, 1), (555, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    out = quality.score(docs, model, F.col("doc_id")).collect()
    assert len(out) == len(rows) and all(0 <= r["score"] <= 1 for r in out)
    same = {r["score"] for r in out if r["doc_id"] in (100, 101)}
    assert len(same) == 1
    assert quality.score(docs.limit(0), model, F.col("doc_id")).collect() == []
    nothing = quality.fit(docs, labels.limit(0))
    assert nothing is None and {r["score"] for r in quality.score(docs, nothing).collect()} == {0.5}
    assert quality.fit(docs.limit(0), labels) is None


def test_features_of_an_empty_text_are_zero():
    assert not features([None, b"", b" \n\t"]).any()
    assert isinstance(train(features([b"a b c", b"d e", b"x", b"y z"]), np.array([True, True, False, False])), QualityModel)

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdpulse.llm import neighbours
from crowdpulse.llm.neighbours import build_tree, chi_square_cdf, chi_square_quantile, nearest

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, queries, k=20):
    """query -> [(vec_id, score)], by all products."""
    good = [(p, np.float32(v).astype(float)) for p, v in rows if p is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    out = {}
    for at, (q, x) in enumerate(good):
        if queries(q):
            found = sorted((-np.einsum("ij,j->i", y[None], x)[0], p) for other, (p, y) in enumerate(good) if other != at and len(y) == len(x))
            out[q] = [(p, -s) for s, p in found[:k]]
    return out


def run(df, condition, **options):
    out = {}
    for r in nearest(df, condition, **options).orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 300)
    monkeypatch.setattr(neighbours, "BLOCK", 7)
    rows = [(r[0], list(r[1])) for r in spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding").collect()]
    truth = plain(rows, lambda q: q % 40 == 0)
    got = run(spark.createDataFrame(rows, SCHEMA).repartition(4), F.col("vec_id") % 40 == 0)
    assert set(got) == set(truth)
    hits = sum(len({p for p, _ in got[q]} & {p for p, _ in truth[q]}) for q in truth)
    assert hits / sum(map(len, truth.values())) > 0.93
    x = {p: np.float32(v).astype(float) for p, v in rows}
    for q, found in got.items():
        assert found == sorted(found, key=lambda f: (-f[1], f[0])) and len(found) == 20
        assert all(s == np.einsum("ij,j->i", x[p][None], x[q])[0] for p, s in found)


def test_unequal_lengths_and_ties(crowd):
    rng = np.random.default_rng(1)
    rows = [(i, (rng.normal(size=6) * rng.choice([0.1, 1, 10])).tolist()) for i in range(500)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # equal vectors, more than are asked for
    rows += [(2000, None), (2020, [0.0] * 6), (2040, [None] * 6), (2060, [float("nan")] * 6), (2080, [1.0]), (None, rows[0][1])]
    # As many vectors of another length.
    rows += [(3000 + i, (rng.normal(size=4)).tolist()) for i in range(550)]
    truth = plain(rows, lambda q: q % 20 == 0)
    got = run(crowd(rows, SCHEMA), F.col("vec_id") % 20 == 0)
    assert set(got) == {q for q in truth if truth[q]}  # 2080 is alone with its length
    hits = sum(len(set(got.get(q, ())) & set(truth[q])) for q in truth)
    assert hits / sum(map(len, truth.values())) > 0.93
    assert [p for p, _ in got[0]][:5] == [p for p, _ in truth[0]][:5]


def test_few_candidates_and_empty_tables(crowd):
    rows = [(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0]), (40, [0.0, 1.0])]
    assert run(crowd(rows, SCHEMA), F.col("vec_id") % 20 == 0) == plain(rows, lambda q: q % 20 == 0)
    assert nearest(crowd([], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest(crowd(rows[1:3], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []
    assert nearest(crowd(rows[:1], SCHEMA), F.col("vec_id") % 20 == 0).collect() == []


def test_rows_that_repeat_a_query_id(crowd):
    rows = [(20, [1.0, 0.0]), (20, [0.9, 0.1]), (1, [0.5, 0.5])]
    got = sorted(map(tuple, nearest(crowd(rows, SCHEMA), F.col("vec_id") % 20 == 0).collect()))
    f = [np.float32(v).astype(float) for _, v in rows]
    expected = sorted((q, i + 1, p, s) for q, own in ((20, 0), (20, 1)) for i, (s, p) in enumerate(sorted(((f[own] @ f[o], rows[o][0]) for o in range(3) if o != own), reverse=True)))
    assert got == [pytest.approx(e) for e in expected]


def test_the_search_stops_before_the_whole_shard():
    """On a shard of full size, made from the sample with noise, under three quarters are verified at a recall of 0.95."""
    import duckdb

    base = np.array([r[0] for r in duckdb.sql("SELECT embedding FROM '/root/testdata/sf0.1/embeddings.parquet' ORDER BY vec_id").fetchall()], float)
    rng = np.random.default_rng(6)
    x = base[rng.integers(0, len(base), neighbours.SHARD)] + 0.05 * rng.normal(size=(neighbours.SHARD, base.shape[1]))
    m, dim, k = 12, x.shape[1], 20
    radius2 = (x * x).sum(axis=1).max() * (1 + 1e-9)
    axes = np.random.default_rng([3, dim]).standard_normal((dim + 1, m))
    points = x @ axes[:dim] + np.sqrt(np.maximum(radius2 - (x * x).sum(axis=1), 0))[:, None] * axes[dim]
    ids = np.arange(len(x))
    shard = neighbours.Shard(ids, ids, x, points)
    hits = verified = 0
    queries = range(0, len(x), 400)
    for i in queries:
        found, score, n = shard.search(x[i], i, x[i] @ axes[:dim], radius2 + x[i] @ x[i], k, chi_square_quantile(0.95, m))
        true = np.einsum("ij,j->i", x, x[i])
        true[i] = -np.inf
        hits += len(set(shard.ids[found].tolist()) & set(np.argsort(-true, kind="stable")[:k].tolist()))
        verified += n
        # A score that others reach already cuts the search short and leaves what is better.
        better, _, fewer = shard.search(x[i], i, x[i] @ axes[:dim], radius2 + x[i] @ x[i], k, chi_square_quantile(0.95, m), score[4])
        assert fewer <= n and set(better.tolist()) <= set(found[:5].tolist())
    assert hits / (k * len(queries)) >= 0.95
    assert verified / (len(x) * len(queries)) < 0.75


def test_blocks_of_one_shard_are_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(2000)], SCHEMA)
    out = nearest(df, F.col("vec_id") % 20 == 0, k=3)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "part" in plan and "group" in plan and out.count() == 300


def test_tree_boxes_hold_their_points():
    points = np.concatenate([np.random.default_rng(2).normal(size=(1000, 4)), np.ones((500, 4))])
    order, starts, low, high = build_tree(points)
    assert sorted(order) == list(range(1500)) and np.diff(starts).max() <= neighbours.LEAF
    for k in range(len(low)):
        own = points[order[starts[k] : starts[k + 1]]]
        assert (own >= low[k]).all() and (own <= high[k]).all()


def test_chi_square():
    # Known values of the distribution.
    assert chi_square_cdf(2.0, 2) == pytest.approx(1 - np.exp(-1))
    assert chi_square_quantile(0.95, 8) == pytest.approx(15.507, abs=1e-3)
    sample = (np.random.default_rng(3).normal(size=(200_000, 6)) ** 2).sum(axis=1)
    assert np.mean(sample <= 5) == pytest.approx(float(chi_square_cdf(5, 6)), abs=0.005)

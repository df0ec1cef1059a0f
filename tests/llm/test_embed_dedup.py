import random

import numpy as np
import pytest

from crowdpulse.llm import embed_dedup
from crowdpulse.llm.embed_dedup import embedding_components, rotation, suffix_steps, tile_links

from test_simhash import classes

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, threshold=0.9):
    """(vec_id, links, component) per row, by all pairs."""
    ok = [p is not None and v is not None and all(c is not None and np.isfinite(c) for c in v) and any(v) for p, v in rows]
    x = [np.array(np.float32(v), float) / np.abs(np.float32(v)).max().astype(float) if g else None for (_, v), g in zip(rows, ok)]
    n = len(rows)
    links = [(i, j) for i in range(n) for j in range(i) if ok[i] and ok[j] and len(x[i]) == len(x[j]) and x[i] @ x[j] / np.sqrt((x[i] @ x[i]) * (x[j] @ x[j])) >= threshold]
    count = [sum(k in link for link in links) for k in range(n)]
    of = classes(range(n), links)
    low = {}
    for k in range(n):
        if ok[k]:
            low[of[k]] = min(low.get(of[k], rows[k][0]), rows[k][0])
    return sorted(((rows[k][0], count[k], low[of[k]] if ok[k] else rows[k][0]) for k in range(n)), key=repr)


def vectors(seed=1, n=300, dim=12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, dim))
    rows = [(i, (centres[rng.integers(20)] + rng.normal(size=dim) * rng.choice([0.05, 0.3, 1.0])).tolist()) for i in range(n)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # equal vectors
    other = rng.normal(size=(8, 5))
    rows += [(4000 + i, (other[rng.integers(8)] + 0.1 * rng.normal(size=5)).tolist()) for i in range(n)]  # as many of another length
    rows += [(5000 + i, [1.0] * (20 + i // 2)) for i in range(24)]  # more lengths than have directions of their own
    rows += [(2000, [2 * c for c in rows[5][1]]), (2001, [-c for c in rows[5][1]]), (2002, [1e30 * c for c in rows[6][1]])]
    rows += [(3000, None), (3001, []), (3002, [0.0] * dim), (3003, [None] + [1.0] * (dim - 1)), (3004, [float("nan")] + [1.0] * (dim - 1)),
             (3005, [float("inf")] + [1.0] * (dim - 1)), (3006, [1.0, 2.0]), (None, rows[3][1]), (7, rows[8][1])]
    random.Random(seed).shuffle(rows)
    return rows


@pytest.mark.parametrize("tile,strip", [(4096, 512), (16, 5)])
def test_against_all_pairs(crowd, monkeypatch, tile, strip):
    monkeypatch.setattr(embed_dedup, "TILE", tile)
    monkeypatch.setattr(embed_dedup, "STRIP", strip)
    rows = vectors()
    got = embedding_components(crowd(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


@pytest.mark.parametrize("threshold", [0.3, 0.9, 0.999])
def test_pairs_at_the_threshold(threshold):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(80, 16))
    x = x / np.sqrt((x**2).sum(axis=1, keepdims=True))
    y = np.concatenate([x[:30], x[:30] + 0.02 * rng.normal(size=(30, 16)), rng.normal(size=(30, 16))])
    y = y / np.sqrt((y**2).sum(axis=1, keepdims=True))
    basis = rotation(x)
    pairs = set()
    for i, j in tile_links(x @ basis, y @ basis, threshold, False, suffix_steps(16)):
        pairs |= set(zip(i.tolist(), j.tolist()))
    assert pairs == set(zip(*(k.tolist() for k in np.nonzero((x @ basis) @ (y @ basis).T >= threshold))))


def test_tables_without_links(crowd):
    assert embedding_components(crowd([], SCHEMA)).collect() == []
    assert sorted(map(tuple, embedding_components(crowd([(2, None), (1, [0.0])], SCHEMA)).collect())) == [(1, 0, 1), (2, 0, 2)]
    assert list(map(tuple, embedding_components(crowd([(1, [1.0, 2.0])], SCHEMA)).collect())) == [(1, 0, 1)]


def test_a_threshold_without_bound_raises(crowd):
    with pytest.raises(ValueError):
        embedding_components(crowd([], SCHEMA), 0.0)


def test_whole_small_table(spark, small):
    from crowdpulse.llm.queries import QUERIES

    rows = [(r[0], list(r[1])) for r in spark.read.parquet(f"{small}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = QUERIES["op4_embedding_near_dedup"](spark, small).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in got), key=repr) == plain(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)

"""Nearest neighbours by inner product: low-dimensional stable projections indexed by kd-trees.

A vector x becomes (x, sqrt(M^2 - |x|^2)) with M the largest length, a query q becomes (q, 0): the
largest inner product is then the smallest distance. Points are projected to a few dimensions by
Gaussian directions (2-stable, so the squared projected distance is the squared distance times a
chi-square variable) and put in a kd-tree. A query takes up points by rising projected distance,
which the tree hands out leaf by leaf, and verifies them on the original vectors; it stops when a
point nearer than the k-th best so far would, by the chi-square law, have shown up with the wanted
probability.

Candidates are dealt into shards of bounded size with a tree each, queries into blocks. A block
first searches one shard, and takes the k-th best score found there along to all others, so that
most of them stop early; the best of the shards are merged per query. Vectors of each length are
a search of their own.
"""

from __future__ import annotations

from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crowdpulse.llm.common import written
from crowdpulse.llm.vectors import matrix, usable

#: Rows of a shard and of a query block, points of a leaf, leaves taken up and points verified at first (then twice as many, and so on).
SHARD, BLOCK, LEAF, STEP, VERIFIED = 16_384, 1024, 64, 128, 1024


def chi_square_cdf(x: np.ndarray | float, degrees: int):
    """Distribution function of chi-square with an even number of degrees."""
    half = np.asarray(x, float) / 2
    return 1 - np.exp(-half) * sum(half**i / factorial(i) for i in range(degrees // 2))


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1.0
    while chi_square_cdf(high, degrees) < p:
        high *= 2
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_cdf(mid, degrees) < p else (low, mid)
    return high


def build_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order of the points by leaf, the leaves' starts, and the corners of their boxes.

    Halves are cut by rank along the widest dimension, so leaves stay small when points coincide.
    """
    leaves, todo = [], [np.arange(len(points))]
    while todo:
        part = todo.pop()
        if len(part) <= LEAF:
            leaves.append(part)
            continue
        own = points[part]
        wide = int((own.max(axis=0) - own.min(axis=0)).argmax())
        halves = np.argpartition(own[:, wide], len(part) // 2)
        todo += [part[halves[: len(part) // 2]], part[halves[len(part) // 2 :]]]
    order = np.concatenate(leaves)
    starts = np.cumsum([0] + [len(leaf) for leaf in leaves])
    low = np.stack([points[leaf].min(axis=0) for leaf in leaves])
    high = np.stack([points[leaf].max(axis=0) for leaf in leaves])
    return order, starts, low, high


class Shard:
    """Candidates with their projections in a tree, leaf by leaf. ``far2`` of a query is M^2 + |q|^2: a squared
    distance is that less twice the inner product."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, x: np.ndarray, projected: np.ndarray):
        order, self.starts, self.low, self.high = build_tree(projected)
        self.rows, self.ids, self.x, self.projected = rows[order], ids[order], x[order], projected[order]
        # Single precision looks over the points; what may be good enough is worked out in double.
        self.quick = self.x.astype(np.float32)
        self.room = np.empty_like(self.quick)
        self.size2 = np.einsum("ij,ij->i", self.projected, self.projected)
        self.slack = 1e-5 * np.sqrt(np.einsum("ij,ij->i", self.x, self.x).max(initial=0))

    def search(self, query: np.ndarray, own_row: int, projected: np.ndarray, far2: float, k: int, reach: float,
               floor: float = -np.inf) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions and inner products of the ``k`` best found, best first, and how many points were verified.

        ``reach`` is the chi-square quantile of the stopping test, ``floor`` a score that ``k`` other
        candidates reach, so that only as good ones matter.
        """
        gap = np.maximum(np.maximum(self.low - projected, projected - self.high), 0)
        bound = np.einsum("ij,ij->i", gap, gap)
        by = np.argsort(bound, kind="stable")
        best, score, verified, worst = np.zeros(0, np.int64), np.zeros(0), 0, floor
        waiting, distance = np.zeros(0, np.int64), np.zeros(0)
        quick, slack = query.astype(np.float32), self.slack * np.sqrt(query @ query)
        at, step, ring = 0, STEP, VERIFIED
        from_query = np.maximum(self.size2 - 2 * (self.projected @ projected) + projected @ projected, 0)

        def limit():
            return reach * max(0.0, far2 - 2 * worst) if worst > -np.inf else np.inf

        while at < len(by) and bound[by[at]] < limit():
            leaves = np.sort(by[at : at + step])
            at, step = at + step, 2 * step
            begin, size = self.starts[leaves], self.starts[leaves + 1] - self.starts[leaves]
            taken = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
            waiting, distance = np.concatenate([waiting, taken]), np.concatenate([distance, from_query[taken]])
            # No point that is still in the tree is nearer than the next leaf.
            ahead = bound[by[at]] if at < len(by) else np.inf
            while True:
                ready = np.flatnonzero(distance < min(limit(), np.nextafter(ahead, np.inf)))
                if not len(ready):
                    break
                if len(ready) > ring:
                    ready = ready[np.argpartition(distance[ready], ring)[:ring]]
                rows = waiting[ready]
                distance[ready] = np.inf  # done with
                ring *= 2
                verified += len(rows)
                rows = rows[np.take(self.quick, rows, axis=0, out=self.room[: len(rows)], mode="clip") @ quick >= worst - slack]
                rows = rows[self.rows[rows] != own_row]
                # Row by row, so that equal vectors get equal scores wherever they stand.
                found = np.einsum("ij,j->i", self.x[rows], query)
                good = found >= worst
                best, score = np.concatenate([best, rows[good]]), np.concatenate([score, found[good]])
                top = np.lexsort((self.ids[best], -score))[:k]
                best, score = best[top], score[top]
                if len(best) == k:
                    worst = max(worst, score[-1])
            keep = distance < limit()
            waiting, distance = waiting[keep], distance[keep]
        return best, score, verified


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, projections: int = 12, certainty: float = 0.95,
            seed: int = 3) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query row its ``k`` largest inner products found.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on its columns. Candidates
    are all other rows with a vector of the query's length, also those that repeat its vec_id;
    query rows that repeat a vec_id are answered each. Scores are inner products in double
    precision on the original vectors, equal ones ordered by vec_id; ranks begin at 1. With fewer
    than ``k`` candidates all are returned. Vectors that are null, empty, zero or hold null or
    non-finite components take no part, nor do rows with a null vec_id. ``projections`` is even. An
    empty table gives an empty table.
    """
    spark = vectors.sparkSession
    if projections % 2:
        raise ValueError("the stopping test needs an even number of projections")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("is_query"),
    )
    rows = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    # Written once, a row's number is the same for every reader.
    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), F.size("vector").alias("dim"), "*"), "usable-vectors")
    length2 = F.aggregate("vector", F.lit(0.0), lambda s, c: s + c * c)
    # A row for each length of vectors there is.
    sizes = rows.groupBy("dim").agg(F.count("*"), F.count_if("is_query"), F.max(length2)).orderBy("dim").collect()
    plan, first, block = [], 0, 0
    for dim, total, queries, longest in sizes:
        if queries:
            shards, blocks = -(-total // SHARD), -(-queries // BLOCK)
            # Where shards are few, their blocks are dealt to several tasks, each with the shard.
            groups = min(blocks, max(1, -(-2 * spark.sparkContext.defaultParallelism // shards)))
            # A radius that rounding cannot undercut.
            plan.append((dim, first, shards, block, blocks, groups, float(longest) * (1 + 1e-9)))
            first, block = first + shards, block + blocks
    if not plan:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    plan = F.broadcast(spark.createDataFrame(plan, "dim int, first long, shards long, block0 long, blocks long, groups long, radius2 double"))
    placed = rows.join(plan, "dim")

    def packed(key, part):
        x = matrix(part.column("vector").combine_chunks(), part.column("dim")[0].as_py())
        return pa.table({
            "part": [key[0].as_py()], "dim": pa.array([x.shape[1]], pa.int32()), "radius2": [part.column("radius2")[0].as_py()],
            "rows": [part.column("row").to_numpy().tobytes()], "ids": [part.column("vec_id").to_numpy().tobytes()], "x": [x.tobytes()],
        })

    def deal(df, base, parts, salt):
        part = F.col(base) + F.pmod(F.xxhash64("row", F.lit(salt)), F.col(parts))
        dealt = df.select(part.alias("part"), "dim", "radius2", "row", "vec_id", "vector").groupBy("part")
        return dealt.applyInArrow(packed, "part long, dim int, radius2 double, rows binary, ids binary, x binary")

    candidates = written(deal(placed, "first", "shards", 1), "shards")
    asked = written(deal(placed.filter("is_query"), "block0", "blocks", 2), "query-blocks").select(
        F.col("part").alias("block"), "dim", F.col("rows").alias("query_rows"), F.col("ids").alias("query_ids"), F.col("x").alias("queries")
    )
    asked = asked.join(plan.drop("radius2"), "dim").withColumn("group", F.col("block") % F.col("groups"))
    home = F.col("first") + F.col("block") % F.col("shards")
    shared = candidates.join(plan.select("dim", "groups"), "dim").withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)))
    reach = chi_square_quantile(certainty, projections)

    def run(batches):
        seen, shard = None, None
        for batch in batches:
            for row in range(batch.num_rows):
                block, part, dim, radius2, *raw = (batch.column(c)[row].as_py() for c in range(11))
                q_rows, q_ids = (np.frombuffer(r, np.int64) for r in raw[:2])
                q = np.frombuffer(raw[2], np.float64).reshape(-1, dim)
                axes = np.random.default_rng([seed, dim]).standard_normal((dim + 1, projections))
                if seen != part:
                    x = np.frombuffer(raw[6], np.float64).reshape(-1, dim)
                    lift = np.sqrt(np.maximum(radius2 - np.einsum("ij,ij->i", x, x), 0))
                    points = x @ axes[:dim] + lift[:, None] * axes[dim]
                    shard, seen = Shard(np.frombuffer(raw[4], np.int64), np.frombuffer(raw[5], np.int64), x, points), part
                floors = np.frombuffer(raw[3], np.float64) if raw[3] else np.full(len(q), -np.inf)
                projected, size = q @ axes[:dim], np.einsum("ij,ij->i", q, q)
                found = [shard.search(q[i], q_rows[i], projected[i], radius2 + size[i], k, reach, floors[i]) for i in range(len(q))]
                last = np.array([s[-1] if len(s) == k else -np.inf for _, s, _ in found])
                counts = np.array([len(s) for _, s, _ in found])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block]), pa.array([np.maximum(last, floors).tobytes()], pa.binary()),
                     pa.array([np.repeat(q_rows, counts).tobytes()], pa.binary()), pa.array([np.repeat(q_ids, counts).tobytes()], pa.binary()),
                     pa.array([shard.ids[np.concatenate([r for r, _, _ in found])].tobytes()], pa.binary()),
                     pa.array([np.concatenate([s for _, s, _ in found]).tobytes()], pa.binary())],
                    names=["block", "floors", "query_row", "query_id", "vec_id", "score"],
                )

    def searched(blocks):
        pairs = blocks.join(shared.select("part", "group", "radius2", "rows", "ids", "x"), ["part", "group"])
        return pairs.select("block", "part", "dim", "radius2", "query_rows", "query_ids", "queries", "floors", "rows", "ids", "x").mapInArrow(
            run, "block long, floors binary, query_row binary, query_id binary, vec_id binary, score binary"
        )

    one = written(searched(asked.withColumn("part", home).withColumn("floors", F.lit(None).cast("binary"))), "first-shards")
    others = F.filter(F.sequence(F.col("first"), F.col("first") + F.col("shards") - 1), lambda p: p != home)
    rest = searched(asked.join(one.select("block", "floors"), "block").withColumn("part", F.explode(others)))

    def unpacked(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.frombuffer(batch.column(c)[row].as_py(), np.float64 if c == 3 else np.int64)) for c in range(4)],
                    names=["query_row", "query_id", "vec_id", "score"],
                )

    names = ["query_row", "query_id", "vec_id", "score"]
    best = one.select(*names).unionByName(rest.select(*names)).mapInArrow(unpacked, "query_row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )

"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.session import cut


def _star(pairs: DataFrame, upper_only: bool) -> DataFrame:
    """Tie the neighbours of every node to the smallest among them and the node.

    ``pairs`` has node ``u`` and neighbour ``v``. With ``upper_only`` just the neighbours above
    the node are tied (large star), else all of them and the node itself (small star). The minima
    are cut first, so that the join has a plain exchange on either side and adaptive execution can
    split the rows of a node that holds a large part of all links.
    """
    low = cut(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
    tied = pairs.filter("v > u") if upper_only else pairs
    tied = tied.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not upper_only:
        tied = tied.union(low.select("u", F.col("m").alias("v")))
    return tied.filter("u <> v").distinct()


def connected_components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``node, component`` for every node of ``links`` (columns ``a``, ``b``, long).

    ``component`` is the smallest node that can be reached. Links may repeat, point either way and
    join a node with itself; links with a null end are ignored. No links give an empty table.
    Every round is written to the checkpoint folder. Raises if ``max_rounds`` do not settle it
    (the number of rounds grows with the logarithm of the longest path).
    """
    edges = cut(
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    mark = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = cut(_star(_star(both, True), False))
        # The links are final when a round leaves them as they were.
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def local_components(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable index for each of ``n`` nodes, given links ``a``–``b`` between indices.

    ``label`` carries the result for links seen before.
    """
    label = np.arange(n) if label is None else label
    while len(a):
        la, lb = label[a], label[b]
        differ = la != lb
        if not differ.any():
            break
        a, b, la, lb = a[differ], b[differ], la[differ], lb[differ]
        low, high = np.minimum(la, lb), np.maximum(la, lb)
        np.minimum.at(label, high, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
    return label

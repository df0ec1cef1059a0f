"""Near-duplicate vectors: PCA-ordered tiled comparison.

Vectors are scaled to unit length and turned into the directions of their principal components,
largest first; a rotation keeps every dot product. Tiles of bounded size are compared pair by
pair: dot products over the leading dimensions come first, what the others can still add is at
most the product of the two suffix norms, and a pair is dropped as soon as that cannot reach the
threshold. Equal vectors are folded before and counted by multiplicity, and a tile pair hands on
link counts and a spanning forest, never its pairs. Tiles are cut along the first component, so
whole tile pairs that lie too far apart are never formed. Vectors of each length have tiles of
their own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdpulse.llm.common import written
from crowdpulse.llm.components import connected_components, local_components
from crowdpulse.llm.vectors import matrix, unit, usable

#: Most rows that a tile is meant to hold, and rows compared at a time in a task.
TILE, STRIP = 4096, 512
#: Slabs along the first component, rows of the sample that fixes directions and slabs, and for how
#: many lengths (the most frequent) there are such; vectors of others are compared as they are, in one slab.
SLABS, SAMPLE, ROTATED = 32, 20_000, 8


def rotation(sample: np.ndarray) -> np.ndarray:
    """Orthonormal columns, the directions of most spread about the origin first."""
    values, axes = np.linalg.eigh(sample.T @ sample)
    return axes[:, np.argsort(values)[::-1]]


def suffix_steps(dim: int) -> list[int]:
    """Numbers of leading dimensions after which hopeless pairs are dropped."""
    return sorted({max(1, dim * 3 // 8), max(1, dim * 5 // 8), dim})


def tile_links(x: np.ndarray, y: np.ndarray, threshold: float, same: bool, steps: list[int]):
    """Yield index arrays ``i, j`` of the rows of ``x`` and ``y`` whose dot product reaches ``threshold``.

    Rows are unit vectors in PCA order. With ``same`` the tiles are one, and only i < j counts.
    """
    slack = 1e-5  # the first dimensions are compared in single precision
    rest = [(np.sqrt((x[:, s:] ** 2).sum(axis=1)), np.sqrt((y[:, s:] ** 2).sum(axis=1))) for s in steps]
    lead_x, lead_y = x[:, : steps[0]].astype(np.float32), y[:, : steps[0]].T.astype(np.float32).copy()
    for at in range(0, len(x), STRIP):
        part = lead_x[at : at + STRIP] @ lead_y
        part += np.outer(rest[0][0][at : at + STRIP], rest[0][1]).astype(np.float32)
        i, j = np.nonzero(part >= threshold - slack)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for cut in range(0, len(i), 1 << 16):
            a, b = i[cut : cut + (1 << 16)], j[cut : cut + (1 << 16)]
            dot = np.zeros(len(a))
            done = 0
            for s, (rx, ry) in zip(steps, rest):
                dot += np.einsum("ij,ij->i", x[a, done:s], y[b, done:s])
                done = s
                keep = dot + (rx[a] * ry[b] + 1e-12 if s < x.shape[1] else 0) >= threshold
                a, b, dot = a[keep], b[keep], dot[keep]
            if len(a):
                yield a, b


def embedding_components(vectors: DataFrame, threshold: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id`` for every row of ``vectors`` (vec_id, embedding).

    Rows link if the cosine of their vectors, in double precision, is at least ``threshold`` (more
    than 0), which only vectors of one length have. Vectors that are null, empty, zero or hold null
    or non-finite components link with nothing, nor do rows with a null vec_id. Each is returned
    with no links and its own vec_id as component. Rows that repeat a vec_id count as vectors of
    their own. Other columns are ignored; an empty table gives an empty table.
    """
    spark = vectors.sparkSession
    if threshold <= 0:
        raise ValueError("the bound needs a positive threshold")
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector")
    )
    good = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    folded = written(
        good.groupBy("vector").agg(F.min("vec_id").alias("least"), F.count("*").alias("copies"))
        # Written once, the numbers are the same for every reader.
        .select(F.monotonically_increasing_id().alias("node"), "copies", "vector", "least"),
        "folded-vectors",
    )
    n = folded.count()
    if not n:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    lengths = folded.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(ROTATED).collect()
    limits = {int(r[0]): int(min(1.0, SAMPLE / r[1]) * 2**31) for r in lengths}
    wanted = F.pmod(F.xxhash64(F.lit(1), "node"), F.lit(2**31)) < F.create_map(*[F.lit(x) for kv in limits.items() for x in kv])[F.size("vector")]
    # About SAMPLE vectors of each of these lengths.
    sample = folded.filter(F.size("vector").isin(*limits) & wanted).select("vector").toArrow().column(0).to_pylist()
    bases = {}
    for dim in limits:
        own = np.array([v for v in sample if len(v) == dim]).reshape(-1, dim)
        if len(own):
            basis = rotation(unit(own))
            bases[dim] = basis, np.unique(np.quantile(unit(own) @ basis[:, 0], np.arange(1, SLABS) / SLABS))

    def turn(batches):
        for batch in batches:
            sizes = pa.compute.list_value_length(batch.column(2)).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes).tolist():
                part = batch.take(pa.array(np.flatnonzero(sizes == dim)))
                x, slab = unit(matrix(part.column(2), dim)), np.zeros(part.num_rows, np.int64)
                if dim in bases:
                    basis, edges = bases[dim]
                    x = x @ basis
                    slab = np.searchsorted(edges, x[:, 0], "right")
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(dim * SLABS + slab, pa.int64()), pa.array(x[:, 0]),
                     pa.array([r.tobytes() for r in x], pa.binary())],
                    names=["node", "copies", "slab", "lead", "x"],
                )

    turned = written(folded.mapInArrow(turn, "node long, copies long, slab long, lead double, x binary"), "turned-vectors")
    # At most SLABS rows for a length: their sizes fix the tiles, their extents the slabs that can hold a link.
    slabs = sorted(tuple(r) for r in turned.groupBy("slab").agg(F.count("*"), F.min("lead"), F.max("lead")).collect())
    parts = {s: -(-c // TILE) for s, c, _, _ in slabs}
    first = dict(zip(parts, np.cumsum([0, *parts.values()])[:-1].tolist()))
    reach = np.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9
    table = spark.createDataFrame([(s, first[s], parts[s]) for s in parts], "slab long, first long, parts long")
    # Salted by the node, the rows of a slab spread over its tiles.
    placed = turned.join(F.broadcast(table), "slab").select(
        (F.col("first") + F.pmod(F.xxhash64("node", F.lit(2)), F.col("parts"))).alias("tile"), "slab", "node", "copies", "x"
    )

    def block(key, tile):
        nodes = tile.column("node").to_numpy()
        return pa.table({
            "tile": [key[0].as_py()], "slab": [tile.column("slab")[0].as_py()], "nodes": [nodes.tobytes()],
            "copies": [tile.column("copies").to_numpy().tobytes()], "x": [b"".join(tile.column("x").to_pylist())],
        })

    blocks = written(
        placed.groupBy("tile").applyInArrow(block, "tile long, slab long, nodes binary, copies binary, x binary"), "tiles"
    )
    # Of two tiles one visits the other, by turns, so that every tile is visited about as often.
    near = [
        (s, first[t], first[t] + parts[t] - 1)
        for s, _, low, high in slabs for t, _, lo, hi in slabs
        if s // SLABS == t // SLABS and lo - high <= reach and low - hi <= reach
    ]
    visits = spark.createDataFrame(near, "near long, from long, to long")
    guests = blocks.join(F.broadcast(visits), F.col("slab") == F.col("near")).select(
        "tile", "slab", "nodes", "copies", "x", F.explode(F.sequence("from", "to")).alias("other")
    )
    a, b = F.col("tile"), F.col("other")
    odd = F.pmod(a + b, F.lit(2)) == 1
    guests = guests.filter(F.when(a == b, True).when(a < b, odd).otherwise(~odd))
    hosts = blocks.select(F.col("tile").alias("other"), F.col("nodes").alias("nodes2"), F.col("copies").alias("copies2"), F.col("x").alias("x2"))
    pairs = guests.join(hosts, "other").select("tile", "other", "nodes", "copies", "x", "nodes2", "copies2", "x2", "slab")

    def compare(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                tile, other, *raw, slab = (batch.column(c)[row].as_py() for c in range(9))
                dim = slab // SLABS
                n1, c1, n2, c2 = (np.frombuffer(raw[k], np.int64) for k in (0, 1, 3, 4))
                x, y = (np.frombuffer(raw[k], np.float64).reshape(-1, dim) for k in (2, 5))
                same = tile == other
                total = len(n1) if same else len(n1) + len(n2)
                links, label = np.zeros(total, np.int64), None
                for i, j in tile_links(x, y, threshold, same, suffix_steps(dim)):
                    k = j if same else j + len(n1)
                    links += np.bincount(i, c2[j], total).astype(np.int64) + np.bincount(k, c1[i], total).astype(np.int64)
                    label = local_components(total, i, k, label)
                if label is None:
                    continue
                node = n1 if same else np.concatenate([n1, n2])
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node[some]), pa.array(node[label[some]]), pa.array(links[some])], names=["a", "b", "links"]
                )

    found = written(pairs.mapInArrow(compare, "a long, b long, links long"), "vector-links")
    component = connected_components(found.select("a", "b"))
    links = found.groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    placed = written(
        folded.join(links, "node", "left").join(component, "node", "left").select(
            F.col("vector").alias("_vector"), "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "placed-vectors",
    )
    least = placed.groupBy("component").agg(F.min("least").alias("component_id"))
    named = written(placed.join(least, "component").select("_vector", "n_links", "component_id"), "named-vectors")
    # Both sides are plain tables: adaptive execution can split a vector with very many copies.
    linked = good.join(named, F.col("vector") == F.col("_vector")).select("vec_id", "n_links", "component_id")
    odd_rows = rows.filter(F.col("vec_id").isNull() | ~usable(F.col("vector")))
    return linked.unionAll(
        odd_rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    )

"""Clustering around centroids in whole numbers, with a vantage-point tree over the centroids.

Each round builds a tree over the centroids and hands it to all tasks (its size is that of the centroids, not of
the data). Every vector walks it best first: of the nodes it may still enter the one with the least possible
distance is next, and a node is passed over only if that bound is larger than the best distance found. Equal bounds
are entered, because a centroid with a smaller number may lie there at the same distance. Distances to centroids
are exact integers; the bounds are floats with room for rounding, so they only ever prune too little.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import quoted, stored

LEAF = 4  # centroids of a leaf
CELLS = 1 << 20  # bounds held at once: vectors times nodes
# Whole components beyond this would overflow a squared distance.
MOST = 1 << 27


@dataclass
class Tree:
    """``points`` are the centroids. Node n measures the distance to the centroids ``own[n]``; ``below[n]`` lists its
    children as (node, least, most distance of the child's centroids from the node's first centroid)."""

    points: np.ndarray
    own: list[list[int]]
    below: list[list[tuple[int, float, float]]]


def squared(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    apart = points - centre
    return np.einsum("ij,ij->i", apart, apart)


def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
    """Halves the centroids again and again by their distance from a vantage point, the one farthest from the first."""
    tree = Tree(points, [], [])
    waiting = [(np.arange(len(points)), None)]
    while waiting:
        members, parent = waiting.pop()
        node = len(tree.own)
        if parent is not None:
            up, least, most = parent
            tree.below[up].append((node, least, most))
        if len(members) <= leaf:
            tree.own.append(members.tolist())
            tree.below.append([])
            continue
        vantage = members[np.argmax(squared(points[members], points[members[0]]))]
        rest = members[members != vantage]
        apart = np.sqrt(squared(points[rest], points[vantage]).astype(float))
        order = np.argsort(apart, kind="stable")
        tree.own.append([int(vantage)])
        tree.below.append([])
        for half in np.array_split(order, 2):
            waiting.append((np.sort(rest[half]), (node, float(apart[half[0]]), float(apart[half[-1]]))))
    return tree


def nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of each vector's nearest centroid; the smaller number on ties."""
    lot = max(1, CELLS // len(tree.own))
    parts = [_nearest(tree, vectors[k : k + lot]) for k in range(0, len(vectors), lot)]
    return tuple(np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, int), np.zeros(0, int))


def _nearest(tree: Tree, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = len(vectors)
    bounds = np.full((n, len(tree.own)), np.inf)
    bounds[:, 0] = 0.0
    best, who = np.full(n, np.iinfo(np.int64).max), np.full(n, len(tree.points))
    active = np.arange(n)
    while len(active):
        node = bounds[active].argmin(axis=1)
        bound = bounds[active, node]
        reach = np.sqrt(best[active].astype(float)) * (1 + 1e-12) + 1e-9
        enter = np.isfinite(bound) & (bound <= reach)  # inclusive: ties may lie there
        active, node = active[enter], node[enter]
        bounds[active, node] = np.inf
        for at in np.unique(node).tolist():
            rows = active[node == at]
            for k, number in enumerate(tree.own[at]):
                apart = squared(vectors[rows], tree.points[number])
                closer = (apart < best[rows]) | ((apart == best[rows]) & (number < who[rows]))
                best[rows[closer]], who[rows[closer]] = apart[closer], number
                if k == 0 and tree.below[at]:
                    far = np.sqrt(apart.astype(float))
                    for child, least, most in tree.below[at]:
                        gap = np.maximum(far - most, least - far)
                        bounds[rows, child] = np.maximum(gap - 1e-12 * (far + most), 0.0)
    return who, best


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width).astype(np.int64)


def whole_vectors(vectors: DataFrame, id_column: str, vector_column: str, width: int, scale: int) -> DataFrame:
    """``id, v``: rows with ``width`` finite components, each as floor(scale * component)."""
    v = quoted(vector_column)
    scaled = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    fits = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double") * scale) < MOST)
    kept = vectors.where((F.size(v) == width) & F.forall(v, fits))
    return kept.select(quoted(id_column).alias("id"), scaled.cast("array<int>").alias("v"))


def moved(table: DataFrame, tree: Tree) -> np.ndarray:
    """The centroids after a round. Tasks send sums a cluster and component; an empty cluster stays where it was."""
    count, width = tree.points.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, sizes = np.zeros((count, width), np.int64), np.zeros(count, np.int64)
        for batch in batches:
            vectors = as_matrix(batch.column(0), width)
            who, _ = nearest(tree, vectors)
            np.add.at(sums, who, vectors)
            sizes += np.bincount(who, minlength=count)
        used = np.flatnonzero(sizes)
        columns = [np.repeat(used, width), np.tile(np.arange(width), len(used))]
        columns += [np.repeat(sizes[used], width), sums[used].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["cluster", "part", "n", "total"])

    rows = table.select("v").mapInArrow(run, "cluster long, part long, n long, total long")
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    found = tree.points.copy()
    for r in rows.groupBy("cluster", "part").agg(F.sum("n").alias("n"), total.alias("total")).collect():
        found[r["cluster"], r["part"]] = int(r["total"]) // r["n"]
    return found


def cluster_vectors(
    vectors: DataFrame,
    clusters: int = 16,
    rounds: int = 3,
    width: int = 64,
    scale: int = 64,
    seed: int = 1,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per vector kept: ``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256``.

    Vectors of another width, with null or non-finite components, or beyond 2^27 after scaling (their distances
    would not fit) are left out, null ones too. Centroids start as the vectors with the smallest hashes of
    ``seed:id``, equal hashes by components; a null id counts as empty. With fewer vectors than ``clusters`` there
    are as many centroids as vectors. Equal centroids are all the same distance away, so the smallest number gets
    the vectors. Repeated rows are vectors of their own. Empty tables give empty results; other columns are not
    looked at. The driver and the tasks hold ``clusters`` times ``width`` numbers.
    """
    spark, kind = vectors.sparkSession, dict(vectors.select(quoted(id_column).alias("id")).dtypes)["id"]
    shape = f"vec_id {kind}, cluster int, distance long"
    table = stored(whole_vectors(vectors, id_column, vector_column, width, scale), "vectors")
    label = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))), 256)
    first = table.select(label.alias("h"), "v").orderBy("h", "v").limit(clusters).collect()
    if not first:
        empty = spark.createDataFrame([], shape)
        return empty.selectExpr("*", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256")
    points = np.array([r["v"] for r in first], np.int64)
    for _ in range(rounds):
        points = moved(table, build(points))
    tree = build(points)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, apart = nearest(tree, as_matrix(batch.column(1), width))
            columns = [batch.column(0), pa.array(who, pa.int32()), pa.array(apart, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "cluster", "distance"])

    found = stored(table.select("id", "v").mapInArrow(run, shape), "clusters")
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    whole = sum(int(r["s"]) for r in sums)
    digest = lambda k: hashlib.sha256(",".join(map(str, points[k].tolist())).encode()).hexdigest()
    rows = [(r["cluster"], int(r["s"]), whole, digest(r["cluster"])) for r in sums]
    names = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.join(F.broadcast(spark.createDataFrame(rows, names)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

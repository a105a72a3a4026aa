import hashlib
import math

import numpy as np
import pytest

from millrace.llm import centroids
from millrace.llm.centroids import build, cluster_vectors, nearest
from millrace.llm.queries import QUERIES

from cases import TINY

SHAPE = "vec_id long, embedding array<double>, cluster string, Distance int"


def plain(rows, k, rounds, width, scale=64, seed=1):
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v in rows
        if v is not None and len(v) == width and all(x is not None and math.isfinite(x) for x in v)
    ]
    label = lambda r: hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest()
    centres = [v for _, v in sorted(kept, key=lambda r: (label(r), r[1]))[:k]]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for step in range(rounds + 1):
        who = [min((far(v, c), n) for n, c in enumerate(centres)) for _, v in kept]
        if step < rounds:
            for n in range(len(centres)):
                own = [v for (_, v), (_, w) in zip(kept, who) if w == n]
                if own:
                    centres[n] = [sum(x) // len(own) for x in zip(*own)]
    sums = {n: sum(d for d, w in who if w == n) for n in range(len(centres))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    whole = sum(sums.values())
    return sorted(((i, w, d, sums[w], whole, digest[w]) for (i, _), (d, w) in zip(kept, who)), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{TINY}/embeddings.parquet").collect()]
    assert found(QUERIES["op12_centroid_clustering"](spark, TINY)) == plain(rows, 16, 3, 64)


def test_edge_cases(spark):
    rng = np.random.default_rng(2)
    rows = [(k, [float(x) for x in rng.normal(size=2)]) for k in range(60)]
    rows += [(7, [0.5, -0.5])] * 9 + [(None, [0.25, 0.25])] * 2 + [(80, [-0.0, 0.0]), (81, [1e-300, -1e-300])]
    odd = [(90, None), (91, []), (92, [1.0]), (93, [1.0, None]), (94, [float("nan"), 1.0]), (95, [float("inf"), 1.0])]
    df = spark.createDataFrame([(i, v, "c", 3) for i, v in rows + odd], SHAPE).repartition(3)
    assert found(cluster_vectors(df, 5, 4, width=2)) == plain(rows + odd, 5, 4, 2)
    # More centroids than vectors; vectors that are all alike; none at all.
    few = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [4.0, 2.0])]
    df = spark.createDataFrame([(i, v, "c", 3) for i, v in few], SHAPE)
    assert found(cluster_vectors(df, 5, 2, width=2)) == plain(few, 5, 2, 2)
    assert found(cluster_vectors(df.limit(0), 5, 2, width=2)) == []
    beyond = spark.createDataFrame([(1, [1e300, 0.0], "c", 3), (2, [2.0**21, 0.0], "c", 3)], SHAPE)
    assert found(cluster_vectors(beyond, 5, 2, width=2)) == []


@pytest.mark.parametrize("count", [1, 4, 5, 16, 130])
@pytest.mark.parametrize("span", [2, 60, 1 << 27])
def test_tree_equals_a_full_scan(monkeypatch, count, span):
    monkeypatch.setattr(centroids, "CELLS", 700)
    rng = np.random.default_rng(count)
    # Few different values make equal centroids and many ties.
    points, vectors = (rng.integers(-span + 1, span, (n, 3)) for n in (count, 300))
    vectors[:count] = points[: len(vectors)]
    apart = ((vectors[:, None, :] - points[None]) ** 2).sum(axis=2)
    who, best = nearest(build(points), vectors)
    assert who.tolist() == apart.argmin(axis=1).tolist() and best.tolist() == apart.min(axis=1).tolist()


def test_tree_skips_most_centroids(monkeypatch):
    rng = np.random.default_rng(1)
    points = rng.integers(0, 1 << 20, (512, 2))
    tree, looked = build(points), []
    real = centroids.squared
    monkeypatch.setattr(centroids, "squared", lambda p, c: looked.append(len(p)) or real(p, c))
    nearest(tree, rng.integers(0, 1 << 20, (400, 2)))
    assert sum(looked) < 400 * 512 / 8

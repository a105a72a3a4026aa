"""Nearest neighbours by inner product, through multi-index hashing of learned binary codes.

Vectors get 64-bit codes: signs after a rotation learned on a bounded sample (principal axes, then iterative
quantisation). A further component makes all vectors equally long first, so that the angle orders them as the inner
product does. Codes are cut into substrings, and each substring has an index of its own. Two codes within a radius
differ by few bits in some substring, so looking up all substring values that near finds every code within the
radius (pigeonhole). All of these are reranked by their exact inner product.

Codes are indexed in blocks of bounded size; each part of the queries meets each block in a task, and only a
query's best few leave it. The radius is the one that holds the wanted share of true neighbours, measured by brute
force on some queries against all vectors. Queries that find too few look again in a wider radius, in the end
one that holds all codes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import quoted, stored

BITS = 64
SAMPLE = 4096  # vectors the rotation is learned on
PROBES = 64  # queries the radius is measured with
RECALL = 0.97  # of true neighbours within the radius
BLOCK = 1 << 16  # vectors of an index block and queries of a part
LEAST_BLOCKS = 4
LEAST_TASKS = 24  # so that small inputs use the whole cluster as well
WIDER = 8  # bits added for queries that found too few
SUBSTRINGS = (4, 8, 16)  # bits, to choose from


@dataclass
class Coder:
    """``axes`` turns lengthened vectors into numbers whose signs are the code; ``longest`` is the largest norm."""

    axes: np.ndarray
    longest: float
    kind: np.dtype  # of the vectors' components

    def codes(self, vectors: np.ndarray, query: bool = False) -> np.ndarray:
        signs = lengthened(vectors, self.longest, query) @ self.axes > 0
        return np.packbits(signs, axis=1, bitorder="little").view(np.uint64).ravel()


def lengthened(vectors: np.ndarray, longest: float, query: bool = False) -> np.ndarray:
    """Vectors over the largest norm, with a component that brings them to length 1; for queries it is 0."""
    short = vectors.astype(np.float64) / longest
    norms = np.einsum("ij,ij->i", short, short)
    rest = np.zeros(len(short)) if query else np.sqrt(np.maximum(0.0, 1.0 - norms))
    return np.column_stack([short, rest])


def learn(sample: np.ndarray, longest: float, bits: int = BITS, rounds: int = 30) -> Coder:
    """Axes by iterative quantisation; more bits than dimensions come from several independent rotations."""
    rng, data, axes = np.random.default_rng(13), lengthened(sample, longest), []
    _, directions = np.linalg.eigh(data.T @ data)
    while bits:
        basis = directions[:, ::-1][:, :bits]
        turned = data @ basis
        turn, _ = np.linalg.qr(rng.normal(size=(basis.shape[1],) * 2))
        for _ in range(rounds):
            left, _, right = np.linalg.svd(np.where(turned @ turn > 0, 1.0, -1.0).T @ turned)
            turn = (left @ right).T
        axes.append(basis @ turn)
        bits -= basis.shape[1]
    return Coder(np.hstack(axes), longest, sample.dtype)


def reaches(radius: int, parts: int) -> list[int]:
    """How far to look in each substring: codes within ``radius`` are that near in at least one; -1 means not at all."""
    each, extra = divmod(radius, parts)
    return [each if k <= extra else each - 1 for k in range(parts)]


def patterns(width: int, reach: int) -> int:
    return sum(math.comb(width, k) for k in range(min(reach, width) + 1)) if reach >= 0 else 0


class MultiIndex:
    """The codes of a block, indexed by each substring."""

    def __init__(self, codes: np.ndarray, radius: int, width: int | None = None):
        costs = {
            w: sum(patterns(w, r) * (1 + len(codes) / (1 << w)) for r in reaches(radius, BITS // w)) for w in SUBSTRINGS
        }
        self.width = width or min(costs, key=costs.get)
        self.codes, self.radius = codes, radius
        self._reach = reaches(radius, BITS // self.width)
        every = np.arange(1 << self.width, dtype=np.uint64)
        apart = np.bitwise_count(every)
        self._flips = {r: every[apart <= r] for r in set(self._reach) if r >= 0}
        self._order, self._starts = [], []
        for k in range(BITS // self.width):
            own = self._part(codes, k)
            order = np.argsort(own, kind="stable")
            self._order.append(order)
            self._starts.append(np.searchsorted(own[order], np.arange((1 << self.width) + 1)))

    def _part(self, codes, k: int):
        return (codes >> np.uint64(k * self.width)) & np.uint64((1 << self.width) - 1)

    def within(self, code: np.uint64) -> np.ndarray:
        """Places of all codes within the radius."""
        seen = np.zeros(len(self.codes), bool)
        for k, reach in enumerate(self._reach):
            if reach < 0:
                continue
            at = self._part(code, k) ^ self._flips[reach]
            begin, end = self._starts[k][at], self._starts[k][at + np.uint64(1)]
            lengths = end - begin
            places = np.repeat(begin - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())
            seen[self._order[k][places]] = True
        found = np.flatnonzero(seen)
        return found[np.bitwise_count(self.codes[found] ^ code) <= self.radius]


def best(ids: np.ndarray, scores: np.ndarray, most: int) -> np.ndarray:
    """Places of the highest scores, smaller ids first on ties."""
    if len(scores) > most:
        near = np.flatnonzero(scores >= np.partition(scores, len(scores) - most)[len(scores) - most])
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:most]


def inner(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products in double precision; equal vectors get equal ones."""
    return (vectors.astype(np.float64) * query.astype(np.float64)).sum(axis=1)


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> tuple[DataFrame, int]:
    """``id, v`` of distinct rows that take part, and the number of components."""
    v = quoted(vector_column)
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    kept = vectors.where(quoted(id_column).isNotNull() & F.forall(v, finite) & F.exists(v, lambda x: x != 0))
    kept = kept.select(quoted(id_column).cast("long").alias("id"), v.alias("v"))
    sizes = kept.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("n"))
    width = sizes.orderBy(F.desc("n"), "width").first()
    if width is None:
        return kept, 0
    return kept.where(F.size("v") == width["width"]).distinct(), width["width"]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def true_neighbours(rows: DataFrame, probes: list, width: int, most: int, coder: Coder) -> pd.DataFrame:
    """Of a few queries the exact nearest in all rows, with the bits their codes are apart: ``probe, apart``."""
    ids = np.array([p["id"] for p in probes])
    asked = np.array([p["v"] for p in probes])
    codes = coder.codes(asked, query=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, vectors = batch.column(0).to_numpy(), _matrix(batch.column(1), width)
            coded, out = coder.codes(vectors), []
            for k, query in enumerate(asked):
                other = np.flatnonzero(own != ids[k])
                top = other[best(own[other], inner(vectors[other], query), most)]
                apart = np.bitwise_count(coded[top] ^ codes[k]).astype(np.int64)
                out.append((np.full(len(top), k), own[top], inner(vectors[top], query), apart))
            columns = [pa.array(np.concatenate(c)) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(columns, ["probe", "id", "score", "apart"])

    found = rows.mapInArrow(run, "probe long, id long, score double, apart long")
    place = F.row_number().over(Window.partitionBy("probe").orderBy(F.desc("score"), "id"))
    return found.withColumn("place", place).where(F.col("place") <= most).select("probe", "apart").toPandas()


def packed(rows: DataFrame, count: int, coder: Coder, width: int, name: str, query: bool) -> DataFrame:
    """``name`` (0 to count - 1), keys, ids, vectors and codes as bytes: a row for BLOCK vectors at most.

    ``rows`` has ``key, id, v``.
    """

    def block(number: int, kept: list[tuple]) -> pa.RecordBatch:
        keys, ids, vectors = (np.concatenate(c) for c in zip(*kept))
        parts = [keys, ids, vectors, coder.codes(vectors, query)]
        columns = [pa.array([number], pa.int64()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)]
        return pa.RecordBatch.from_arrays(columns, [name, "keys", "ids", "vectors", "codes"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, kept, held = None, [], 0
        for batch in batches:
            numbers, keys, ids = (batch.column(k).to_numpy() for k in range(3))
            vectors = _matrix(batch.column(3), width)
            cuts = [0, *(np.flatnonzero(np.diff(numbers)) + 1).tolist(), len(numbers)]
            for a, b in zip(cuts, cuts[1:]):
                while a < b:
                    if held and (numbers[a] != at or held == BLOCK):
                        yield block(at, kept)
                        kept, held = [], 0
                    own = slice(a, min(b, a + BLOCK - held))
                    at = int(numbers[a])
                    kept.append((keys[own], ids[own], vectors[own]))
                    held, a = held + own.stop - own.start, own.stop
        if held:
            yield block(at, kept)

    dealt = rows.select(F.pmod(F.xxhash64("id", "v"), F.lit(count)).alias(name), "key", "id", "v")
    dealt = dealt.repartition(count, name).sortWithinPartitions(name)
    return dealt.mapInArrow(run, f"{name} long, keys binary, ids binary, vectors binary, codes binary")


def nearest_neighbours(
    vectors: DataFrame,
    every: int,
    most: int = 20,
    recall: float = RECALL,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    least_tasks: int = LEAST_TASKS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: of each query the ``most`` nearest found, nearest first.

    Queries are the rows whose id is divisible by ``every``. Ids are whole numbers. Rows with a null id or vector,
    with null or non-finite components, or with nothing but zeros take no part; nor do vectors of another width than
    most have. Rows equal in id and vector count once. A query's own id is no candidate. Ties go to the smaller id.
    Where there are fewer candidates than ``most``, all are returned. Empty tables give empty results; other columns
    are not looked at.

    Of equal vectors only the ``most`` + 1 smallest ids can be among the nearest of anything, so the others are not
    indexed; that loses nothing.
    """
    spark, result = vectors.sparkSession, "query_id long, rank int, vec_id long, score double"
    rows, width = usable(vectors, id_column, vector_column)
    if not width:
        return spark.createDataFrame([], result)
    rows = stored(rows, "vectors")
    place = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    index = rows.withColumn("place", place).where(F.col("place") <= most + 1)
    index = stored(index.select(F.col("id").alias("key"), "id", "v"), "index")
    asked = rows.where(F.col("id") % every == 0).withColumn("key", F.monotonically_increasing_id())
    asked = stored(asked.select("key", "id", "v"), "queries")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    counts = index.agg(F.count("*").alias("n"), F.max(square).alias("m")).first()
    by_hash = lambda df, n: df.orderBy(F.xxhash64("id", "v"), "id").limit(n).collect()
    kind = np.float32 if dict(index.dtypes)["v"] == "array<float>" else np.float64
    coder = learn(np.array([r["v"] for r in by_hash(index, SAMPLE)], kind), math.sqrt(counts["m"]))
    probes = by_hash(asked, PROBES)
    if not probes:
        return spark.createDataFrame([], result)
    apart = true_neighbours(index.select("id", "v"), probes, width, most, coder)["apart"].to_numpy()
    radius = int(np.quantile(apart, recall, method="higher")) if len(apart) else BITS
    blocks = max(LEAST_BLOCKS, -(-counts["n"] // BLOCK))
    parts = max(-(-asked.count() // BLOCK), -(-least_tasks // blocks))
    coded, found = stored(packed(index, blocks, coder, width, "block", False), "blocks"), []
    while True:
        wanted = packed(asked, parts, coder, width, "part", True)
        near = stored(search(coded, wanted, blocks, parts, radius, most, width, coder), "near")
        place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "vec_id"))
        near = near.withColumn("rank", place).where(F.col("rank") <= most)
        if radius >= BITS:
            found.append(near)
            break
        # Whoever has not found enough looks again in a wider radius.
        full = near.where(F.col("rank") == most).select("key")
        found.append(near.join(full, "key", "left_semi"))
        asked = stored(asked.join(full, "key", "left_anti"), "missing")
        if asked.isEmpty():
            break
        radius = min(BITS, radius + WIDER)
    return reduce(DataFrame.unionAll, found).select("query_id", "rank", "vec_id", "score")


def search(
    index: DataFrame, asked: DataFrame, blocks: int, parts: int, radius: int, most: int, width: int, coder: Coder
) -> DataFrame:
    """``key, query_id, vec_id, score``: the best of each query in each block, every part with every block a task."""
    count = blocks * parts
    dealt = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = index.select("block", dealt(parts).alias("part"), *(F.col(c).alias(f"i_{c}") for c in ("ids", "vectors", "codes")))
    right = asked.select("part", dealt(blocks).alias("block"), *(F.col(c).alias(f"q_{c}") for c in ("keys", "ids", "vectors", "codes")))
    both = left.repartition(count, "block", "part").join(right.repartition(count, "block", "part"), ["block", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                i_ids, i_vectors, i_codes, keys, ids, asking, codes = (
                    np.frombuffer(c[row].as_buffer(), kind) for c, kind in zip(batch.columns, kinds)
                )
                vectors, asking = i_vectors.reshape(-1, width), asking.reshape(-1, width)
                table, out = MultiIndex(i_codes, radius), []
                for k, code in enumerate(codes):
                    places = table.within(code)
                    places = places[i_ids[places] != ids[k]]
                    scores = inner(vectors[places], asking[k])
                    top = best(i_ids[places], scores, most)
                    out.append((np.full(len(top), k), i_ids[places[top]], scores[top]))
                of, near, score = (np.concatenate(c) for c in zip(*out))
                columns = [pa.array(c) for c in (keys[of], ids[of], near, score)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "query_id", "vec_id", "score"])

    kind = coder.kind
    kinds = [np.int64, kind, np.uint64, np.int64, np.int64, kind, np.uint64]
    names = [c for c in both.columns if c[:2] in ("i_", "q_")]
    return both.select(*names).mapInArrow(run, "key long, query_id long, vec_id long, score double")

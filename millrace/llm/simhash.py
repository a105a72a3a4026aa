"""SimHash near-duplicates through a hierarchical index over fingerprints in Gray order.

Equal fingerprints are one node, whatever the number of copies. Distinct fingerprints are sorted by their Gray
rank and cut into blocks. Neighbours in Gray order share bit patterns; a node of the index keeps the bits all its
fingerprints share (``mask``) and their values (``pattern``). The mask of a child contains that of its parent, so
differences only accumulate on the way down, and a pair of nodes that differ in more shared bits than allowed is
dropped with everything below it. Blocks are the top of that hierarchy: pairs of blocks that survive are compared
in tasks of their own, each on two bounded blocks. A task sends a spanning forest of the links it found, never all
pairs of a dense group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.components import components
from millrace.llm.shared import checkpointed, columns_of, free_name, quoted, row_key, values

SEED = 42
BLOCK = 1 << 20  # fingerprints in a block: 8 MB
LEAST_BLOCKS = 24  # so that small inputs use the whole cluster as well
FAN = 4
CHUNK = 1 << 19  # node pairs looked at in one step


def fingerprint(text: bytes | None, shingle: int) -> int:
    """64 majority bits over the XXH64 of all word shingles, as a signed number; 0 without words."""
    words = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    last = len(words) - width + 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:last].tolist(), ends[width - 1 :].tolist())
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in spans), np.uint64, last)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, max(1, last >> 16)):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """One row ``doc_id, key, fingerprint`` per document; null and wordless texts have fingerprint 0."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, key binary, fingerprint long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(t, shingle) for t in values(batch.column(2), pa.binary())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.int64())], ["doc_id", "key", "fingerprint"]
            )

    return rows.mapInArrow(run, schema)


def gray_rank(bits: str) -> F.Column:
    """Place of a bit pattern in Gray order, signed so that it sorts like the unsigned rank."""
    rank = F.col(bits)
    for step in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, step))
    return rank.bitwiseXOR(F.lit(-(1 << 63)).cast("long"))


def levels(values: np.ndarray, masks: np.ndarray | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(pattern, mask) arrays from the entries themselves up to a single node, FAN children a node."""
    mask = np.full(len(values), ~np.uint64(0)) if masks is None else masks
    found = [(values, mask)]
    while len(values) > 1:
        cuts = np.arange(0, len(values), FAN)
        ones = np.bitwise_and.reduceat(values & mask, cuts)
        any_one = np.bitwise_or.reduceat(values & mask, cuts)
        mask = np.bitwise_and.reduceat(mask, cuts) & ~(ones ^ any_one)
        values = ones
        found.append((values, mask))
    return found


def near(left: list, right: list, limit: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of entry pairs within ``limit`` shared bits, walking both hierarchies at once."""
    top = max(len(left), len(right)) - 1
    left = left + left[-1:] * (top + 1 - len(left))
    right = right + right[-1:] * (top + 1 - len(right))
    one = np.zeros(1, np.int64)
    todo = [(top, one, one)]
    while todo:
        level, a, b = todo.pop()
        (pa_, ma), (pb, mb) = left[level], right[level]
        apart = np.bitwise_count((pa_[a] ^ pb[b]) & ma[a] & mb[b])
        close = apart <= limit
        if same:
            close &= a < b if level == 0 else a <= b
        a, b = a[close], b[close]
        if level == 0:
            if len(a):
                yield a, b
            continue
        wide_a, wide_b = (len(s[level - 1][0]) > len(s[level][0]) for s in (left, right))
        for k in range(0, len(a), CHUNK // FAN**2):
            x, y = a[k : k + CHUNK // FAN**2], b[k : k + CHUNK // FAN**2]
            x = x[:, None] * FAN + np.arange(FAN) if wide_a else x[:, None]
            y = y[:, None] * FAN + np.arange(FAN) if wide_b else y[:, None]
            x, y = np.repeat(x, y.shape[1], axis=1).ravel(), np.tile(y, (1, x.shape[1])).ravel()
            there = (x < len(left[level - 1][0])) & (y < len(right[level - 1][0]))
            todo.append((level - 1, x[there], y[there]))


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest of its component: as many as nodes at most."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = place[: len(a)], place[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        new = label.copy()
        for at in (x, y, label[x], label[y]):
            np.minimum.at(new, at, low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def links(distinct: DataFrame, distance: int, least_blocks: int, block: int) -> DataFrame:
    """Spanning links ``a, b`` between distinct fingerprints at most ``distance`` bits apart."""
    rows = distinct.count()
    count = max(least_blocks, -(-rows // block))
    ranked = distinct.select("fingerprint", gray_rank("fingerprint").alias("rank")).repartitionByRange(count, "rank")

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts = [(f["rank"].to_numpy(), f["fingerprint"].to_numpy().view(np.uint64)) for f in batches if len(f)]
        if not parts:
            return
        rank = np.concatenate([p[0] for p in parts])
        bits = np.concatenate([p[1] for p in parts])[np.argsort(rank, kind="stable")]
        first = TaskContext.get().partitionId() << 24
        for k, start in enumerate(range(0, len(bits), block)):
            own = bits[start : start + block]
            ones, any_one = np.bitwise_and.reduce(own), np.bitwise_or.reduce(own)
            node = np.array([ones, ~(ones ^ any_one)], np.uint64).view(np.int64)
            yield pd.DataFrame({"block": [first + k], "pattern": node[:1], "mask": node[1:], "bits": [own.tobytes()]})

    blocks = checkpointed(ranked.mapInPandas(pack, "block long, pattern long, mask long, bits binary"))
    # The top of the index: three numbers for up to a million fingerprints.
    top = blocks.select("block", "pattern", "mask").toPandas().sort_values("block")
    names = top["block"].to_numpy()
    patterns, masks = (top[c].to_numpy().view(np.uint64) for c in ("pattern", "mask"))

    def partners(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = levels(patterns, masks)
        for f in batches:
            for b, p, m in f.itertuples(index=False):
                own = levels(np.array([p], np.int64).view(np.uint64), np.array([m], np.int64).view(np.uint64))
                found = [y for _, y in near(own, upper, distance, same=False)]
                other = names[np.concatenate(found)] if found else names[:0]
                yield pd.DataFrame({"i": b, "j": other[other >= b]})

    pairs = blocks.select("block", "pattern", "mask").mapInPandas(partners, "i long, j long")
    both = pairs.join(blocks.selectExpr("block as i", "bits as left"), "i")
    both = both.join(blocks.selectExpr("block as j", "bits as right"), "j").select("i", "j", "left", "right")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in batches:
            for i, j, x, y in f.itertuples(index=False):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                a, b, waiting = np.zeros(0, np.uint64), np.zeros(0, np.uint64), []
                for p, q in near(levels(x), levels(y), distance, same=i == j):
                    waiting.append((x[p], y[q]))
                    if sum(len(w[0]) for w in waiting) > CHUNK:
                        a, b = forest(*(np.concatenate([c, *(w[k] for w in waiting)]) for k, c in enumerate((a, b))))
                        waiting = []
                a, b = forest(*(np.concatenate([c, *(w[k] for w in waiting)]) for k, c in enumerate((a, b))))
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return both.mapInPandas(compare, "a long, b long")


def grouped(docs: DataFrame, shingle: int, distance: int, least_blocks: int, block: int) -> DataFrame:
    """``doc_id, key, fingerprint, root, component_id`` per document; root is a fingerprint of the group."""
    found = checkpointed(fingerprints(columns_of(docs, "doc_id", "text"), shingle))
    distinct = checkpointed(found.groupBy("fingerprint").agg(F.min("doc_id").alias("first")))
    group = components(links(distinct, distance, least_blocks, block)).withColumnRenamed("node", "fingerprint")
    smallest = distinct.join(group, "fingerprint").groupBy("root").agg(F.min("first").alias("smallest"))
    named = distinct.join(group.join(smallest, "root"), "fingerprint", "left").select(
        "fingerprint",
        F.coalesce("root", "fingerprint").alias("root"),
        F.when(F.col("root").isNull(), F.col("first")).otherwise(F.col("smallest")).alias("component_id"),
    )
    return found.join(named, "fingerprint").select("doc_id", "key", "fingerprint", "root", "component_id")


def simhash_groups(
    docs: DataFrame, shingle: int = 4, distance: int = 4, least_blocks: int = LEAST_BLOCKS, block: int = BLOCK
) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id``.

    ``component_id`` is the smallest doc_id reachable over fingerprints at most ``distance`` bits apart. Null and
    wordless texts have fingerprint 0 and are linked like any other. Null ids take no part in the minimum; a
    group of null ids only has a null component. Repeated rows get the same answer each. Columns other than
    ``doc_id`` and ``text`` are not looked at. Empty tables give empty results.
    """
    return grouped(docs, shingle, distance, least_blocks, block).select("doc_id", "fingerprint", "component_id")


def keep_one(docs: DataFrame, shingle: int = 4, distance: int = 4) -> DataFrame:
    """The documents, columns as given, with one row of each near-duplicate group.

    The row with the smallest doc_id stays, a null id only where a group has no other; among different texts of
    that id the one with the smallest key, and one of equal rows.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    groups = grouped(docs, shingle, distance, LEAST_BLOCKS, BLOCK)
    key, copy = free_name(docs.columns, "key"), free_name(docs.columns, "copy")
    winners = groups.groupBy("root").agg(F.min(order).alias("w")).select(F.col("w.key").alias(key))
    kept = docs.withColumn(key, row_key(quoted("doc_id"), quoted("text"))).join(winners, key, "left_semi")
    one = F.row_number().over(Window.partitionBy(key).orderBy(key))
    return kept.withColumn(copy, one).where(quoted(copy) == 1).select(*(quoted(c) for c in docs.columns))

"""Benchmark passages in documents: CGK embedding, bit-sampling LSH, exact edit distance.

A CGK walk copies a word sequence of length n into one of length 3n and, by random bits of step and word, advances
in the source or stays. Sequences at a small edit distance soon walk in step, so their embeddings differ in few
places (Hamming distance). LSH samples a few places of an embedding; a window and an item that agree in all of
them are candidates, and several tables in several independent walks bring the recall to a target that is measured
on edited items. Every candidate is then verified by its exact edit distance.

Windows are as long as the items. Before any is embedded, a count bound leaves out those that cannot hold an item:
a passage within e edits of an item of n words shares at least n - 2 - 3e of its word triples. The bound loses no
match; what it leaves still has to be found by the LSH.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from millrace.llm.shared import columns_of, quoted, values

SIMILARITY = 0.8
RECALL = 0.98
SAMPLES = 4  # places that have to agree in a table
TABLES = 4  # tables per walk
MOST_WALKS = 64
LEAST_WORDS = 8  # of an item; shorter ones occur in clean text by chance
BLOCK_BYTES = 4 << 20  # of benchmark text that goes to every task at a time
WORDS = re.compile(r"\w+")
PAD = 0
_MIX = np.uint64(0x9E3779B97F4A7C15)


def edits(length: int, similarity: float) -> int:
    return math.floor(length * (1 - similarity) + 1e-9)


def walk(rows: np.ndarray, seeds: range, length: int) -> np.ndarray:
    """The first ``length`` places of the CGK embeddings of sequences of one length: [seed, sequence, place]."""
    count, n = rows.shape
    padded = np.concatenate([rows, np.full((count, 1), PAD, rows.dtype)], axis=1)
    at, line = np.zeros((len(seeds), count), np.int64), np.arange(count)
    out = np.empty((len(seeds), count, length), rows.dtype)
    # One stream a seed, so that step j of a walk is the same whatever the number of walks.
    steps = np.stack([np.random.default_rng([s, 7]).integers(0, 1 << 63, (length, 2), np.uint64) for s in seeds])
    steps |= np.uint64(1)
    for j in range(length):
        word = padded[line, at]
        out[:, :, j] = word
        mixed = (word.astype(np.uint64) + steps[:, j, 1, None]) * steps[:, j, 0, None]
        mixed ^= mixed >> np.uint64(29)
        mixed *= _MIX
        at += (mixed >> np.uint64(63)).astype(np.int64)
        np.minimum(at, n, out=at)
    return out


def signatures(rows: np.ndarray, seeds: range) -> np.ndarray:
    """One hash a table, [seed, sequence, table], of sampled places.

    An embedding is three times as long as its sequence, but its last third is nearly all padding and not sampled.
    """
    n = rows.shape[1]
    embedded = walk(rows, seeds, 2 * n)
    found = np.zeros((len(seeds), len(rows), TABLES), np.uint64)
    for k, seed in enumerate(seeds):
        places = np.random.default_rng([seed, n, 11]).integers(0, 2 * n, (TABLES, SAMPLES))
        for sample in places.T:
            found[k] = (found[k] ^ embedded[k][:, sample].astype(np.uint64)) * _MIX
            found[k] ^= found[k] >> np.uint64(31)
    return found


def distance_within(item: list[int], text: list[int]) -> tuple[int, int]:
    """Least edit distance of the item to any part of the text, and where that part ends (bit-parallel)."""
    masks: dict[int, int] = defaultdict(int)
    for k, word in enumerate(item):
        masks[word] |= 1 << k
    n = len(item)
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best, end = full, 0, n, n, 0
    for k, word in enumerate(text):
        eq = masks.get(word, 0)
        x = eq | down
        d0 = ((((x & up) + up) ^ up) | x) & full
        right_up, right_down = down | (full & ~(d0 | up)), d0 & up
        if right_up & top:
            score += 1
        elif right_down & top:
            score -= 1
        right_up, right_down = (right_up << 1) & full, (right_down << 1) & full
        up, down = right_down | (full & ~(d0 | right_up)), d0 & right_up
        if score < best:
            best, end = score, k + 1
    return best, end


class Index:
    """Tables over a bounded block of benchmark items; what the tasks search in."""

    def __init__(self, items: list[tuple], similarity: float, recall: float, least_words: int):
        self.similarity = similarity
        self.vocabulary: dict[str, int] = {}
        number = lambda w: self.vocabulary.setdefault(w, len(self.vocabulary) + 1)
        self.items = [(i, [number(w) for w in WORDS.findall(t.lower())]) for i, t in items if t]
        self.items = [(i, w) for i, w in self.items if len(w) >= max(1, least_words)]
        lengths = sorted({len(w) for _, w in self.items})
        # A bit for each length; with more than 62 lengths neighbours share one.
        step = -(-len(lengths) // 62) or 1
        self.groups = [lengths[k : k + step] for k in range(0, len(lengths), step)]
        bit = {n: k for k, g in enumerate(self.groups) for n in g}
        grams: dict[int, int] = defaultdict(int)
        for _, words in self.items:
            own = np.array(words, np.int64)
            for key in self._keys(own[:-2], own[1:-1], own[2:]).tolist():
                grams[key] |= 1 << bit[len(words)]
        self.grams = np.array(sorted(grams), np.int64)
        self.gram_bits = np.array([grams[k] for k in sorted(grams)], np.int64)
        self.by_length: dict[int, list[int]] = defaultdict(list)
        for k, (_, words) in enumerate(self.items):
            self.by_length[len(words)].append(k)
        self.walks = self._tune(recall)
        self.tables: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, own in self.by_length.items():
            rows = np.array([self.items[k][1] for k in own], np.int64)
            values = signatures(rows, range(self.walks)).transpose(0, 2, 1).reshape(-1, len(own))
            order = np.argsort(values, axis=1)
            self.tables[n] = np.take_along_axis(values, order, axis=1), np.array(own, np.int64)[order]

    @staticmethod
    def _keys(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        """A number for each word triple."""
        mixed = (a.astype(np.uint64) * _MIX) ^ b.astype(np.uint64)
        return ((mixed * _MIX ^ c.astype(np.uint64)) >> np.uint64(1)).view(np.int64)

    def _bound(self, n: int) -> int:
        return n - 2 - 3 * edits(n, self.similarity)

    def _tune(self, recall: float) -> int:
        """Walks needed so that items at the largest allowed distance are found with the target recall."""
        rng = np.random.default_rng(5)
        tried = [w for _, w in self.items[:: max(1, len(self.items) // 64)]]
        hit = np.zeros((len(tried), MOST_WALKS), bool)
        for k, words in enumerate(tried):
            changed = list(words)
            for _ in range(edits(len(words), self.similarity)):
                at, kind = int(rng.integers(0, len(changed))), int(rng.integers(0, 3))
                new = len(self.vocabulary) + 1 + int(rng.integers(0, 1 << 20))
                changed[at : at + (kind != 1)] = [] if kind == 2 else [new]
                changed = changed or [PAD]
            changed = (changed + [PAD] * len(words))[: len(words)]
            found = signatures(np.array([words, changed], np.int64), range(MOST_WALKS))
            hit[k] = (found[:, 0] == found[:, 1]).any(axis=1)
        reached = np.maximum.accumulate(hit, axis=1).mean(axis=0) if len(tried) else np.ones(1)
        enough = np.nonzero(reached >= recall)[0]
        return int(enough[0]) + 1 if len(enough) else MOST_WALKS

    def search(self, text: str | None) -> list[tuple]:
        """(item id, distance, words of the item, first word, end word) of each item found, at its best place."""
        words = WORDS.findall((text or "").lower())
        if not words or not self.items:
            return []
        get = self.vocabulary.get
        ids = np.fromiter(map(get, words, repeat(PAD)), np.int64, len(words))
        bits = np.zeros(max(0, len(ids) - 2), np.int64)
        seen = ids > 0
        known = np.flatnonzero(seen[:-2] & seen[1:-1] & seen[2:])
        if len(known):
            keys = self._keys(ids[known], ids[known + 1], ids[known + 2])
            place = np.minimum(np.searchsorted(self.grams, keys), len(self.grams) - 1)
            bits[known] = np.where(self.grams[place] == keys, self.gram_bits[place], 0)
        present = int(np.bitwise_or.reduce(bits)) if len(bits) else 0
        found: dict[int, tuple] = {}
        for k, group in enumerate(self.groups):
            total = np.concatenate([[0], np.cumsum(bits >> k & 1)]) if present >> k & 1 else None
            for n in group:
                bound = self._bound(n)
                if bound < 1:
                    # Too short for the count bound: every place that holds one of its words.
                    starts = np.arange(len(ids)) if (ids > 0).any() else np.zeros(0, np.int64)
                elif total is None or total[-1] < bound:
                    continue
                else:
                    reach = n + edits(n, self.similarity) - 2
                    begin, last = np.arange(len(ids)), len(total) - 1
                    shared = total[np.minimum(begin + reach, last)] - total[np.minimum(begin, last)]
                    starts = np.nonzero(shared >= bound)[0]
                if len(starts):
                    self._match(ids, n, starts, found)
        return [(self.items[k][0], v[0], len(self.items[k][1]), *v[1:]) for k, v in found.items()]

    def _match(self, ids: np.ndarray, n: int, starts: np.ndarray, found: dict[int, tuple]) -> None:
        most = edits(n, self.similarity)
        padded = np.concatenate([ids, np.full(n, PAD, np.int64)])
        values, order = self.tables[n]
        for part in np.array_split(starts, max(1, len(starts) >> 10)):
            rows = padded[part[:, None] + np.arange(n)]
            seen: set[tuple[int, int]] = set()
            signed = signatures(rows, range(self.walks)).transpose(0, 2, 1).reshape(-1, len(part))
            for own, items, wanted in zip(values, order, signed):
                low, high = np.searchsorted(own, wanted, "left"), np.searchsorted(own, wanted, "right")
                for w in np.nonzero(high > low)[0].tolist():
                    seen.update((k, w) for k in items[low[w] : high[w]].tolist())
            for k, w in sorted(seen):
                self._verify(ids, k, int(part[w]), n, most, found)

    def _verify(self, ids: np.ndarray, k: int, start: int, n: int, most: int, found: dict[int, tuple]) -> None:
        if k in found and found[k][0] == 0:
            return
        begin = max(0, start - most)
        apart, end = distance_within(self.items[k][1], ids[begin : start + n + most].tolist())
        if apart <= most and (k not in found or apart < found[k][0]):
            found[k] = (apart, max(0, begin + end - n), begin + end)


def indexes(
    benchmark: DataFrame, similarity: float, recall: float, least_words: int, block_bytes: int
) -> Iterator[Index]:
    """An index for each block of about ``block_bytes`` of benchmark text; one for an empty benchmark."""
    items = columns_of(benchmark, "item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for number in range(blocks):
        # Bounded by the block size: the items of one block.
        own = sorted(items.where(block == number).collect(), key=lambda r: (str(r[0]), r[1]))
        yield Index([tuple(r) for r in own], similarity, recall, least_words)


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    least_words: int = LEAST_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document and benchmark item it holds: ``doc_id, item_id, distance, n_words, first_word, end_word``.

    A document holds an item if some part of its word sequence (lower case, letters and digits) is within
    ``(1 - similarity) * n_words`` edits of the item's; the best place is reported. Null or wordless texts and
    items match nothing, nor do items of fewer than ``least_words`` words. Repeated items and repeated rows are
    reported each. The benchmark is cut into blocks; every block is one pass over the documents, which are not
    shuffled. Other columns are not looked at.
    """
    rows = columns_of(docs, "doc_id", "text").where("text is not null")
    kinds = dict(rows.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    shape = f"doc_id {kinds[0]}, item_id {kinds[1]}, distance int, n_words int, first_word int, end_word int"
    kind = to_arrow_type(benchmark.schema["item_id"].dataType)
    found = [
        rows.mapInArrow(_searcher(index, kind), shape)
        for index in indexes(benchmark, similarity, recall, least_words, block_bytes)
    ]
    return reduce(DataFrame.unionAll, found)


def _searcher(index: Index, item_type: pa.DataType):
    names = ["doc_id", "item_id", "distance", "n_words", "first_word", "end_word"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, hits = [], []
            for k, text in enumerate(values(batch.column(1))):
                own = index.search(text)
                of += [k] * len(own)
                hits += own
            at = pa.array(of, pa.int64())
            item, *numbers = zip(*hits) if hits else ((),) * 5
            own = [pa.array(item, item_type), *(pa.array(n, pa.int32()) for n in numbers)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *own], names)

    return run


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    least_words: int = LEAST_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents that hold no benchmark item, all columns as given; null texts stay. No row is shuffled."""
    for index in indexes(benchmark, similarity, recall, least_words, block_bytes):
        docs = docs.where(~_holder(index)(quoted("text")))
    return docs


def _holder(index: Index):
    @F.arrow_udf("boolean")
    def holds(text: pa.Array) -> pa.Array:
        return pa.array((bool(index.search(t)) for t in values(text)), pa.bool_())

    return holds

"""Removal of repeated paragraphs by MinHash banding, exact verification and components.

A paragraph is a stretch of a fixed number of words from an anchor; the last words of a text are one as well. Anchors
are sentence and line starts and, where there are none for a while, words chosen by the hashes around them. Whether a
word is an anchor depends on its near surroundings only, so a passage copied into another text has the same paragraphs
there, wherever it was put; they overlap, and together they cover the passage. Equal paragraphs (same words) are one
node from the start, whatever the number of copies. MinHash bands over word shingles bring similar nodes together;
within a band's bucket the exact Jaccard similarity decides. Components of verified links are classes, and of each
class the first occurrence stays.

As paragraphs overlap, most of those that meet in a bucket are neighbours in one text and not alike. Each therefore goes
there with a sketch of its shingles, in which similar paragraphs cannot differ in more than a few bits; only those
that have such a partner in their bucket go on, so that nothing similar is lost and few texts are looked at.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.components import components
from millrace.llm.shared import checkpointed, columns_of, free_name, quoted, row_key, stored, values

SHINGLE = 5
SIMILARITY = 0.8
RECALL = 0.95  # of pairs at exactly the wanted similarity; more similar ones are found more often
WORDS = 30  # of a paragraph; texts with fewer have none
SENTENCE = 6  # words of a sentence that lets the next one be an anchor
NEAR = 8  # words on each side that a chosen word is compared with
ALONE = 12  # words on each side without a sentence start, for other words to be chosen
BANDED = 1  # one paragraph in so many: every one
LOT = 64  # texts whose shingles are hashed together
BUCKET = 2000  # nodes of a bucket compared in one task; larger buckets are compared block by block
CELLS = 40  # bits of a sketch; the other bits of its long tell nodes apart
VALUE_BITS = 40  # of a band's hash; paragraphs that meet by chance are told apart by sketch and text
FEW_TEXTS = 100_000  # documents whose wanted places are handed to all tasks; more are joined by key
MOST_HASHES = 24
_WORDS = re.compile(r"\w+")
_TOKENS = re.compile(r"\w+|[.!?\n]")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def bands_for(similarity: float, recall: float, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows a band): the most selective choice that reaches the recall within the hashes allowed."""
    for rows in range(12, 0, -1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))
        if bands * rows <= most:
            return bands, rows
    raise ValueError("no banding reaches the recall")


def tokens(text: str) -> tuple[list[str], list[int], list[int], list[int]]:
    """Words in lower case, their starts and ends, and the numbers of words that open a sentence or line."""
    words, starts, ends, opening, last, fresh = [], [], [], [], 0, True
    for m in _TOKENS.finditer(text):
        said = m.group()
        if said in ".!?\n":
            fresh = True
            continue
        if fresh:
            if not opening or len(words) - last >= SENTENCE:
                opening.append(len(words))
            last, fresh = len(words), False
        words.append(said.lower())
        starts.append(m.start())
        ends.append(m.end())
    return words, starts, ends, opening


def rolled(own: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbouring word hashes."""
    found = np.zeros(max(0, len(own) - width + 1), np.uint64)
    for k in range(width if len(found) else 0):
        found = (found ^ own[k : len(own) - width + 1 + k]) * _STEP
        found ^= found >> np.uint64(29)
    return found


def least_within(values: np.ndarray, reach: int) -> np.ndarray:
    """The least of ``reach`` values from each place on, fewer at the end; by doubling."""
    found, done = values.copy(), 1
    while done < reach:
        step = min(done, reach - done)
        found[:-step] = np.minimum(found[:-step], found[step:])
        done += step
    return found


def anchors(hashes: np.ndarray, opening: list[int], words: int, size: int) -> np.ndarray:
    """First words of the paragraphs of a text; ``hashes`` are those of its shingles."""
    if words < size:
        return np.zeros(0, np.int64)
    found = np.array(opening, np.int64)
    if len(hashes) > 2 * NEAR:
        least = least_within(hashes, NEAR)
        # Less than all its neighbours: in a text that says one word over and over there is none.
        at = np.arange(NEAR, len(hashes) - NEAR)
        chosen = at[(hashes[at] < least[at - NEAR]) & (hashes[at] < least[at + 1])]
        place = np.searchsorted(found, chosen)
        after = np.append(found, words + 10 * ALONE)[place] - chosen
        before = chosen - np.insert(found, 0, -10 * ALONE)[place]
        found = np.append(found, chosen[(after > ALONE) & (before > ALONE)])
    found = np.sort(found[found <= words - size])
    # Where anchors are further apart than a paragraph is long, more are set evenly: no word between is left out.
    steps = np.append(found[1:], words - size) - found
    if len(found) and steps.max() > size:
        parts = [(a, step, max(1, -(-step // size))) for a, step in zip(found.tolist(), steps.tolist())]
        found = np.array([a + step * k // n for a, step, n in parts for k in range(n)])
    # Paragraphs that start nearer to each other would be alike by themselves.
    if len(found) and words - size - found[-1] < SENTENCE:
        return found
    return np.append(found, words - size)


def word_hashes(words: list[str]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def shingles(text: str, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    return np.unique(rolled(word_hashes([w.lower() for w in _WORDS.findall(text)]), size))


class Seen:
    """Paragraphs a task has met already, forgotten when there are too many: a hot one leaves each task few times."""

    def __init__(self, most: int = 200_000):
        self._most, self._nodes = most, set()

    def add(self, node: bytes) -> bool:
        if node in self._nodes:
            return False
        if len(self._nodes) >= self._most:
            self._nodes.clear()
        self._nodes.add(node)
        return True


def band_hashes(hashes: np.ndarray, begin: np.ndarray, count: int, numbers: np.ndarray, bands: int) -> np.ndarray:
    """A hash for each stretch of ``count`` shingles and each band: of the least shingles under its permutations."""
    found = np.empty((len(begin), bands), np.uint64)
    found[:] = np.arange(1, bands + 1, dtype=np.uint64) * _STEP
    # Stretches overlap: every second bound is an end, whose result is not used.
    cuts = np.column_stack([begin, begin + count]).ravel()
    for k, (flip, factor) in enumerate(numbers.T):
        mixed = (hashes ^ flip) * factor
        mixed = np.append(mixed ^ (mixed >> np.uint64(32)), np.uint64(0))
        low = np.minimum.reduceat(mixed, cuts)[::2]
        band = k * bands // numbers.shape[1]
        found[:, band] = (found[:, band] ^ low) * _STEP
        found[:, band] ^= found[:, band] >> np.uint64(31)
    return (found >> np.uint64(64 - VALUE_BITS)).view(np.int64)


def sketches(hashes: np.ndarray, begin: np.ndarray, count: int) -> np.ndarray:
    """CELLS bits for each stretch of ``count`` shingles: whether a cell holds an odd number of distinct ones."""
    own = np.sort(hashes[begin[:, None] + np.arange(count)], axis=1)
    bits = np.uint64(1) << (own >> np.uint64(40)) % np.uint64(CELLS)
    bits[:, 1:][own[:, 1:] == own[:, :-1]] = 0
    return np.bitwise_xor.reduce(bits, axis=1)


def most_apart(count: int, similarity: float) -> int:
    """Shingles at most that only one of two similar paragraphs of ``count`` shingles or fewer has."""
    return math.floor(2 * count * (1 - similarity) / (1 + similarity) + 1e-9)


def occurrences(docs: DataFrame, words: int, size: int, bands: int, rows: int) -> DataFrame:
    """``place, doc_id, key, start, end, node, sketch, bands`` of every paragraph.

    ``place`` numbers the rows of documents, the span is in characters, ``node`` 128 bits of the words, ``sketch``
    those of ``sketches`` above some of the node, ``bands`` a hash for each band; null where the task has sent it for
    the same node before, or where the paragraph is not banded.
    """
    key = row_key(F.col("doc_id"), F.col("text")).alias("key")
    place = F.monotonically_increasing_id().alias("place")
    texts = docs.where("text is not null").select(place, "doc_id", key, "text")
    kind = dict(texts.dtypes)["doc_id"]
    shape = f"place long, doc_id {kind}, key binary, start int, end int, node binary, sketch long, bands array<long>"
    numbers = np.random.default_rng(41).integers(0, 1 << 63, (2, bands * rows), np.uint64) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Seen()
        for whole in batches:
            for lot in range(0, whole.num_rows, LOT):
                batch = whole.slice(lot, LOT)
                of, starts, ends, nodes, new, begin, parts, held = [], [], [], [], [], [], [], 0
                for k, text in enumerate(values(batch.column(3))):
                    said, froms, tos, opening = tokens(text)
                    if len(said) < words:
                        continue
                    hashes = rolled(word_hashes(said), size)
                    for at in anchors(hashes, opening, len(said), words).tolist():
                        node = xxhash.xxh3_128_digest(" ".join(said[at : at + words]))
                        if hashes[at] % np.uint64(BANDED) == 0 and seen.add(node):
                            new.append(len(of))
                        begin.append(held + at)
                        of.append(k)
                        starts.append(froms[at])
                        ends.append(tos[at + words - 1])
                        nodes.append(node)
                    parts.append(hashes)
                    held += len(hashes)
                hashed: list = [None] * len(of)
                own = np.zeros(0, np.int64)
                if of:
                    joined, begins = np.concatenate(parts), np.array(begin)
                    names = np.frombuffer(b"".join(n[:8] for n in nodes), np.uint64) >> np.uint64(CELLS)
                    cells = sketches(joined, begins, words - size + 1) << np.uint64(64 - CELLS)
                    own = (cells | names).view(np.int64)
                    if new:
                        found = band_hashes(joined, begins[new], words - size + 1, numbers, bands)
                        for at, mine in zip(new, found.tolist()):
                            hashed[at] = mine
                taken = pa.array(of, pa.int64())
                columns = [batch.column(k).take(taken) for k in range(3)]
                columns += [pa.array(x, pa.int32()) for x in (starts, ends)]
                columns += [pa.array(nodes, pa.binary()), pa.array(own, pa.int64())]
                columns.append(pa.array(hashed, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    columns, ["place", "doc_id", "key", "start", "end", "node", "sketch", "bands"]
                )

    return texts.mapInArrow(run, shape)


def near_members(buckets: np.ndarray, marks: np.ndarray, apart: int) -> np.ndarray:
    """Which rows have another of their bucket within ``apart`` bits of their sketch; rows come by bucket."""
    found, step = np.zeros(len(buckets), bool), 1
    at = np.arange(len(buckets) - 1)
    while len(at := at[at + step < len(buckets)]):
        at = at[buckets[at] == buckets[at + step]]
        bits = np.bitwise_count((marks[at] ^ marks[at + step]) >> np.uint64(64 - CELLS))
        near = at[bits <= apart]
        found[near] = found[near + step] = True
        step += 1
    return found


def candidates(found: DataFrame, apart: int, bucket: int) -> DataFrame:
    """``value, sketch`` of the paragraphs that may have a similar one in a bucket, each once.

    One shuffle of two numbers a band. Buckets of more than ``bucket`` members may go on whole.
    """
    spread = found.where("bands is not null").select("sketch", F.explode("bands").alias("value"))
    dealt = spread.repartition("value").sortWithinPartitions("value", "sketch")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, large = [np.zeros(0, np.int64)] * 2, None

        def out(keep: np.ndarray, rows: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(r[keep]) for r in rows], ["value", "sketch"])

        def judged(rows: list[np.ndarray]) -> pa.RecordBatch:
            return out(near_members(rows[0], rows[1].view(np.uint64), apart), rows)

        for batch in batches:
            if not batch.num_rows:
                continue
            value, sketch = (np.concatenate([h, c.to_numpy()]) for h, c in zip(held, batch.columns))
            fresh = np.ones(len(value), bool)
            fresh[1:] = (value[1:] != value[:-1]) | (sketch[1:] != sketch[:-1])
            value, sketch = value[fresh], sketch[fresh]
            last = int(np.searchsorted(value, value[-1]))
            if large is not None:
                # The rest of a bucket that went on before; its last row is still held to be told from copies.
                end = int(np.searchsorted(value, large, "right"))
                if end == len(value):
                    yield out(slice(0, end - 1), [value, sketch])
                    held = [value[-1:], sketch[-1:]]
                    continue
                yield out(slice(0, end), [value, sketch])
                value, sketch, last, large = value[end:], sketch[end:], last - end, None
            yield judged([value[:last], sketch[:last]])
            held = [value[last:], sketch[last:]]
            if len(held[0]) > bucket:
                yield out(slice(0, -1), held)
                large, held = value[-1], [h[-1:] for h in held]
        yield out(slice(None), held) if large is not None else judged(held)

    return dealt.select("value", "sketch").mapInArrow(run, "value long, sketch long")


def alike(a: np.ndarray, b: np.ndarray, similarity: float) -> bool:
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= similarity * (len(a) + len(b) - both) - 1e-9


def join_block(nodes: list[bytes], sets: list[np.ndarray], side: list[int], similarity: float) -> list[tuple]:
    """Spanning links of a bucket, or of two blocks of one: pairs already connected need no look.

    ``side`` 0 and 1 are the two blocks; within a single block (side 2) all pairs count.
    """
    parent = list(range(len(nodes)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    # By size, so that only a stretch of sizes can be similar.
    order = sorted(range(len(nodes)), key=lambda k: len(sets[k]))
    links = []
    for place, k in enumerate(order):
        for j in order[place + 1 :]:
            if len(sets[k]) < similarity * len(sets[j]):
                break
            if side[k] == side[j] != 2 or root(k) == root(j):
                continue
            if alike(sets[k], sets[j], similarity):
                parent[root(j)] = root(k)
                links.append((nodes[k], nodes[j]))
    return links


def links(
    docs: DataFrame, found: DataFrame, buckets: DataFrame, size: int, similarity: float, bucket: int
) -> DataFrame:
    """Links ``a, b`` between similar, different paragraphs: enough to connect every class.

    ``buckets`` are the candidates; ``found`` are occurrences in ``docs``, theirs among them.
    """
    several = buckets.groupBy("value").agg(
        F.count("*").alias("n"),
        F.min("sketch").alias("first"),
        F.max("sketch").alias("last"),
        F.sum(F.xxhash64("sketch").cast("decimal(38,0)")).alias("sum"),
    )
    # Similar nodes meet in many bands; of buckets with the same members one is enough.
    once = several.where("n > 1").groupBy("n", "first", "last", "sum").agg(F.min("value").alias("value"))
    members = checkpointed(buckets.join(once.select("value", "n"), "value"))
    # Larger buckets are dealt out in blocks by hash, and each pair of blocks is a group of its own.
    dealt = members.withColumn("blocks", F.ceil(F.col("n") / bucket).cast("int"))
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("sketch", "value"), F.col("blocks")).cast("int"))
    pairs = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(
            F.least(o, "own").alias("x"),
            F.greatest(o, "own").alias("y"),
            F.when(o == F.col("own"), 2).when(o > F.col("own"), 0).otherwise(1).alias("side"),
        ),
    )
    dealt = dealt.select("sketch", "value", F.explode(pairs).alias("p")).select("sketch", "value", "p.*")
    # The text of each wanted node, from one of its places.
    wanted = members.select("sketch").distinct()
    one = found.join(wanted, "sketch", "left_semi").groupBy("sketch", "node")
    one = one.agg(F.min(F.struct("key", "start", "end")).alias("p"))
    spans = one.groupBy("p.key").agg(F.collect_list(F.struct("sketch", "node", "p.start", "p.end")).alias("spans"))
    spans = checkpointed(spans)
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    # Where they lie in few documents the other texts are not moved.
    if spans.limit(FEW_TEXTS + 1).count() <= FEW_TEXTS:
        keyed = keyed.join(F.broadcast(spans.select("key")), "key", "left_semi")
    keyed = keyed.join(spans, "key")
    # Repeated rows have equal keys and would give a text twice; rows lie by key here, so none is moved for it.
    keyed = keyed.dropDuplicates(["key"])
    texts = keyed.select("text", F.explode("spans").alias("s")).selectExpr(
        "s.sketch", "s.node", "substring(text, s.start + 1, s.end - s.start) as said"
    )
    sorted_ = dealt.join(texts, "sketch").repartition("value", "x", "y").sortWithinPartitions("value", "x", "y", "node")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> None:
            if len(group) > 1:
                out.extend(join_block([g[0] for g in group], [g[1] for g in group], [g[2] for g in group], similarity))
            group.clear()

        at, group, out = None, [], []
        known: dict[bytes, np.ndarray] = {}
        for batch in batches:
            for value, x, y, side, node, said in zip(*map(values, batch.columns)):
                if (value, x, y) != at:
                    flush()
                    at = (value, x, y)
                    if len(known) > 20_000:
                        known.clear()
                if node not in known:
                    known[node] = shingles(said, size)
                group.append((node, known[node], side))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.binary()) for k in (0, 1)], ["a", "b"])
            out.clear()
        flush()
        yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.binary()) for k in (0, 1)], ["a", "b"])

    return sorted_.select("value", "x", "y", "side", "node", "said").mapInArrow(verify, "a binary, b binary")


def repeated_paragraphs(
    docs: DataFrame,
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
    words: int = WORDS,
    bucket: int = BUCKET,
) -> DataFrame:
    """One row per occurrence of a paragraph that repeats: ``doc_id, key, start, end, class, first_doc_id, removed``.

    ``start`` and ``end`` are characters of the text, ``class`` names the component (the smallest digest in it),
    ``first_doc_id`` is the document whose occurrence stays: the smallest (doc_id, row key, place), nulls first.
    All other occurrences are ``removed``. Paragraphs have ``words`` words, at least ``shingle``; they overlap. Null
    texts and texts of fewer words have none. Rows equal in id and text are one document: each is listed, neither is the other's copy. Empty tables
    give empty results; other columns are not looked at.
    """
    docs = columns_of(docs, "doc_id", "text")
    bands, rows = bands_for(similarity, recall)
    found = stored(occurrences(docs, words, shingle, bands, rows), "paragraphs", "zstd")
    buckets = checkpointed(candidates(found, most_apart(words - shingle + 1, similarity), bucket))
    # Only paragraphs that occur again or may be similar to another go on; most are neither.
    again = found.groupBy("sketch").agg(F.count("*").alias("n")).where("n > 1").select("sketch")
    wanted = again.unionAll(buckets.select("sketch")).distinct()
    chosen = found.select("sketch", "node", "place", "start", "end").join(wanted, "sketch", "left_semi")
    # A row of a document is one number while most rows are moved; the document's own names come after that.
    rows_ = found.select("place", "doc_id", "key").distinct()
    chosen = checkpointed(chosen.join(rows_, "place").drop("place"))
    group = components(links(docs, chosen, buckets, shingle, similarity, bucket))
    place = F.struct("doc_id", "key", "start")
    listed = chosen.drop("sketch").join(group, "node", "left").withColumn("root", F.coalesce("root", "node"))
    listed = checkpointed(listed)
    kept = listed.groupBy("root").agg(F.min(place).alias("kept"), F.max(place).alias("other"))
    # A paragraph that occurs once in a document that is repeated as a whole has no other place.
    kept = kept.where("kept <> other").select("root", "kept")
    return listed.join(kept, "root").select(
        "doc_id",
        "key",
        "start",
        "end",
        F.lower(F.hex("root")).alias("class"),
        F.col("kept.doc_id").alias("first_doc_id"),
        (place != F.col("kept")).alias("removed"),
    )


@F.arrow_udf(T.StringType())
def without_spans(text: pa.Array, cuts: pa.Array) -> pa.Array:
    """The text without the character spans ``start << 32 | end``."""

    def cut(body: str | None, spans: list[int] | None) -> str | None:
        if spans is None or body is None:
            return body
        kept, at = [], 0
        for span in sorted(spans):
            kept.append(body[at : span >> 32])
            at = max(at, span & 0xFFFFFFFF)
        return "".join([*kept, body[at:]])

    return pa.array(map(cut, values(text), values(cuts)), pa.string())


def dedup_paragraphs(docs: DataFrame, **settings) -> DataFrame:
    """The documents with repeated paragraphs taken out of ``text``; all rows and columns stay.

    Null texts stay null; a text that is repeated as a whole becomes empty but for what stands around its words.
    Empty tables give empty results.
    """
    key, cuts = free_name(docs.columns, "key"), free_name(docs.columns, "cuts")
    gone = repeated_paragraphs(docs, **settings).where("removed")
    packed = F.shiftleft(F.col("start").cast("long"), 32).bitwiseOR(F.col("end").cast("long"))
    by_doc = gone.groupBy("key").agg(F.collect_set(packed).alias(cuts)).withColumnRenamed("key", key)
    joined = docs.withColumn(key, row_key(quoted("doc_id"), quoted("text"))).join(by_doc, key, "left")
    out = {c: quoted(c) for c in docs.columns} | {"text": without_spans(quoted("text"), quoted(cuts))}
    return joined.select(*(v.alias(c) for c, v in out.items()))

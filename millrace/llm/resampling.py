"""Importance resampling of documents towards a target distribution.

Features are runs of words, hashed into buckets. Each bucket has a gain: the log ratio of its share in the target
texts to its share in the documents. A document's weight is the mean gain of its features, looked up in an array
of the size of the bucket count. Gumbel noise by document id turns the highest scores into a weighted draw.

The cutoff of the draw is found without sorting all scores: a quantile sketch proposes a bracket, exact counts
above and inside it validate or widen it, and only a bracket small enough is sorted. The drawn documents are
ranked in ranges, each with the exact number of documents before it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import columns_of, free_name, quoted, row_key, stored, values

BUCKETS = 10_000
RUNS = 2  # words of the longest feature
LEAST_WORDS = 20
SEED = 7
BRACKET = 100_000  # scores sorted to find the cutoff
ACCURACY = 10_000  # of the sketch: ranks are right within the share 1 / ACCURACY
PIECE = 1 << 20  # bytes of a text cut into words at once
LOT = 1 << 18  # features counted at once
# A-Z become a-z; digits, a-z and all bytes of other scripts stay; the rest ends a word.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def hashed_features(text: bytes, runs: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(words, bucket of every run of 1 to ``runs`` words), piece by piece of the text."""
    said, begin, before = text.translate(_WORD_BYTES), 0, []
    while begin < len(said):
        stop = said.find(b" ", begin + PIECE)
        stop = len(said) if stop < 0 else stop
        new = said[begin:stop].split()
        begin = stop
        words = before + new
        hashes = found = list(map(crc32, words))
        parts = [found[len(before) :]]
        for size in range(2, runs + 1):
            # The hash of a longer run goes on from that of the shorter one and a space.
            hashes = list(map(crc32, words[size - 1 :], map(crc32, repeat(b" "), hashes)))
            parts.append(hashes[max(0, len(before) - size + 1) :])
        yield len(new), np.concatenate([np.array(p, np.uint32) for p in parts]) % np.uint32(buckets)
        before = words[len(words) - runs + 1 :] if runs > 1 else []


def bucket_totals(texts: DataFrame, runs: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket; each task sends a row a bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, waiting, n = np.zeros(buckets, np.int64), [], 0
        for batch in batches:
            for text in values(batch.column(0), pa.binary()):
                for _, found in hashed_features(text, runs, buckets):
                    waiting.append(found)
                    n += len(found)
                    if n >= LOT:
                        totals += np.bincount(np.concatenate(waiting), minlength=buckets)
                        waiting, n = [], 0
        if waiting:
            totals += np.bincount(np.concatenate(waiting), minlength=buckets)
        at = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(totals[at])], ["bucket", "n"])

    rows = texts.where("text is not null").select("text").mapInArrow(run, "bucket int, n long")
    totals = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        totals[r["bucket"]] = r["n"]
    return totals


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, by bucket."""
    n, whole, wanted = len(source), float(source.sum()), float(target.sum())
    ratio = [(t + 1.0) * (whole + n) / ((s + 1.0) * (wanted + n)) for s, t in zip(source.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, runs: int) -> DataFrame:
    """``doc_id, key, n_words, n_features, weight`` of every row."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    shape = f"doc_id {dict(rows.dtypes)['doc_id']}, key binary, n_words long, n_features long, weight long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for text in values(batch.column(2), pa.binary()):
                words = features = total = 0
                for n, at in hashed_features(text or b"", runs, len(gain)):
                    words, features, total = words + n, features + len(at), total + int(gain[at].sum())
                found.append((words, features, total // features if features else 0))
            numbers = [pa.array(x, pa.int64()) for x in (zip(*found) if found else ([], [], []))]
            names = ["doc_id", "key", "n_words", "n_features", "weight"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *numbers], names)

    return rows.mapInArrow(run, shape)


def gumbel(seed: int) -> F.Column:
    """Thousandths of Gumbel noise, from the first 32 bits of a hash of seed and doc_id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def cutoff(rows: DataFrame, column: str, wanted: int, bracket: int = BRACKET, accuracy: int = ACCURACY) -> int:
    """The ``wanted``-th highest whole number of a column that has at least so many, none of them null."""
    value = F.col(column)
    inside, above, width = rows.count(), 0, None
    while inside > bracket:
        place, slack = (wanted - above - 0.5) / inside, 2 / accuracy + 1 / inside
        while True:
            if slack < 1:
                shares = [max(0.0, 1 - place - slack), min(1.0, 1 - place + slack)]
                low, high = rows.agg(F.percentile_approx(value, shares, accuracy)).first()[0]
            else:
                low, high = rows.agg(F.min(value), F.max(value)).first()
            over, within = rows.agg(F.count_if(value > high), F.count_if(value.between(low, high))).first()
            if over < wanted - above <= over + within:
                break
            slack *= 4
        if (low, high) == width:
            break  # few values, many rows each
        rows, above, inside, width = rows.where(value.between(low, high)), above + over, within, (low, high)
    # One row a value: a value that many rows share is as cheap as any other.
    for r in rows.groupBy(column).agg(F.count("*").alias("n")).orderBy(value.desc()).toLocalIterator():
        above += r["n"]
        if above >= wanted:
            return r[column]
    raise ValueError("fewer values than wanted")


def importance_ranks(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    runs: int = RUNS,
    buckets: int = BUCKETS,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    bracket: int = BRACKET,
) -> DataFrame:
    """One row per document: ``doc_id, key, n_words, n_features, weight, score, rank``.

    ``percent`` of the documents with ``least_words`` or more are drawn, by score; ties go to the smaller doc_id
    (nulls last), then to fewer features, then to the smaller row key. ``rank`` counts from 1 and is null where a
    document is not drawn. Null texts have no words, a weight of 0 and are never drawn; a null doc_id has the
    noise of an empty one. Repeated rows are documents of their own and get neighbouring ranks. Empty tables give
    empty results, an empty target gains by smoothing alone. Only ``doc_id`` and ``text`` are looked at.
    """
    docs, spark = columns_of(docs, "doc_id", "text"), docs.sparkSession
    gain = gains(bucket_totals(docs, runs, buckets), bucket_totals(columns_of(target, "text"), runs, buckets))
    scored = stored(weighed(docs, gain, runs).withColumn("score", F.col("weight") + gumbel(seed)), "scores")
    able = F.col("n_words") >= least_words
    most = scored.where(able).count() * percent // 100
    if not most:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    least = cutoff(scored.where(able).select("score"), "score", most, bracket)
    ahead = able & (F.col("score") >= least)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("key")]
    # Ranges of the order, each sorted, rows numbered within it. ``h`` deals out rows that are equal in all else.
    dealt = scored.where(ahead).withColumn("h", F.monotonically_increasing_id())
    ranges = dealt.repartitionByRange(*order, "h").sortWithinPartitions(*order, "h").drop("h")
    numbered = stored(ranges.withColumn("at", F.monotonically_increasing_id()), "ranks")
    part, own = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = numbered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    starts, before = [], 0
    for r in sizes:
        starts.append((r["part"], before))
        before += r["n"]
    offsets = spark.createDataFrame(starts, "part long, before long")  # a row a partition
    ranked = numbered.withColumn("part", part).join(F.broadcast(offsets), "part")
    ranked = ranked.withColumn("rank", F.col("before") + own + 1)
    # Of the documents that share the last score, some come too late.
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= most, F.col("rank")))
    rest = scored.where(~ahead).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).unionAll(rest)


def resample(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The drawn documents, columns as given. Of repeated rows as many stay as were drawn."""
    key, copy, drawn = (free_name(docs.columns, n) for n in ("key", "copy", "drawn"))
    ranks = importance_ranks(docs, target, **settings).where("rank is not null")
    chosen = ranks.groupBy("key").agg(F.count("*").alias(drawn)).withColumnRenamed("key", key)
    kept = docs.withColumn(key, row_key(quoted("doc_id"), quoted("text"))).join(chosen, key)
    number = F.row_number().over(Window.partitionBy(key).orderBy(key))
    kept = kept.withColumn(copy, number).where(quoted(copy) <= quoted(drawn))
    return kept.select(*(quoted(c) for c in docs.columns))

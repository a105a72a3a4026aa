"""Removal of repeated runs of lines, cut at content-defined boundaries.

Boundary functions roll over the hashes of two neighbouring lines. Each of them looks at one bit of the hashes and
sets a boundary between all neighbours but those with the bit set in the first and not in the second, or the other
way round for its counterpart. What a line decides about the gap beside it so never hangs on the line across: a chunk
that a passage holds in one document it holds in every other, from two lines on. Chunks of two lines that occur again
anywhere are removed but for the first occurrence, after their bytes were compared; longer repeats are the union of
such chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.shared import columns_of, quoted, row_key, stored, values

FUNCTIONS = 8  # bits that decide about boundaries, each in two functions; 1 of 2^8 pairs of lines agrees in all
HOT_SHARE = 1000  # a chunk is hot with more than one of so many occurrences; fewer than so many chunks can be
_SPANS = "array<struct<start:int,end:int,hash:bigint,again:boolean>>"


def chunks_of(lines: list[bytes], functions: int = FUNCTIONS) -> list[tuple[int, int]]:
    """Chunks of two lines under any of the boundary functions, as (start, end exclusive).

    Blank lines are no lines of their own: they belong to the chunk they stand in.
    """
    said = [k for k, line in enumerate(lines) if line and not line.isspace()]
    if len(said) < 2:
        return []
    # Equal lines in a row would agree in all bits: each is hashed with its number in the row.
    hashes, number = np.zeros(len(said), np.uint64), 0
    for n, k in enumerate(said):
        number = number + 1 if n and lines[k] == lines[said[n - 1]] else 0
        hashes[n] = xxhash.xxh64_intdigest(lines[k], number)
    found = np.zeros(len(said) - 1, bool)
    for function in range(functions):
        bit = hashes >> np.uint64(63 - function) & np.uint64(1)
        # No boundary: 1 before 0 for the function itself, 0 before 1 for its counterpart.
        found |= bit[:-1] != bit[1:]
    return [(said[k], said[k + 1] + 1) for k in np.nonzero(found)[0].tolist()]


def chunks(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """``doc_id, key, start, end, hash`` of all chunks."""
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    rows = rows.where("text is not null and instr(text, '\\n') > 0")
    shift = np.uint64(64 - hash_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, start, end, digests = [], [], [], []
            for k, text in enumerate(values(batch.column(2), pa.binary())):
                lines = text.split(b"\n")
                for begin, stop in chunks_of(lines):
                    of.append(k)
                    start.append(begin)
                    end.append(stop)
                    digests.append(xxhash.xxh64_intdigest(b"\n".join(lines[begin:stop])))
            at = pa.array(of, pa.int64())
            hashed = pa.array((np.array(digests, np.uint64) >> shift).view(np.int64))
            columns = [batch.column(0).take(at), batch.column(1).take(at)]
            columns += [pa.array(start, pa.int32()), pa.array(end, pa.int32()), hashed]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "start", "end", "hash"])

    return rows.mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, key binary, start int, end int, hash long")


def repeated_chunks(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """Chunks whose hash occurs at more than one place: ``key, start, end, hash, again``, by row key of the text.

    ``again`` is false for the first of a hash in order of (doc_id, row key, line). A chunk with many occurrences
    would swell one task of a join by hash: those with more than a thousandth of all are fewer than a thousand, and
    go to the occurrences by broadcast; the others are joined by hash.
    """
    place = F.struct("doc_id", "key", "start")
    found = stored(chunks(columns_of(docs, "doc_id", "text"), hash_bits), "chunks")
    least = found.count() / HOT_SHARE
    ends = found.groupBy("hash").agg(F.count("*").alias("n"), F.min(place).alias("first"), F.max(place).alias("last"))
    # Rows equal in id and text are one place.
    ends = stored(ends.where("first < last").drop("last"), "repeated")
    hot, rest = ends.where(F.col("n") > least).drop("n"), ends.where(F.col("n") <= least).drop("n")
    marked = found.join(F.broadcast(hot), "hash", "left")
    common = marked.where("first is not null")
    rare = marked.where("first is null").drop("first").join(rest, "hash")
    return common.unionByName(rare).select("key", "start", "end", "hash", (place != F.col("first")).alias("again"))


def chunk_bytes(found: DataFrame) -> DataFrame:
    """``doc_id, key, start, end, hash, chunk`` of the chunks in ``spans`` of documents ``doc_id, key, text, spans``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, parts, spans = [], [], []
            for k, (text, own) in enumerate(zip(values(batch.column(2), pa.binary()), values(batch.column(3)))):
                lines = text.split(b"\n")
                for span in own:
                    of.append(k)
                    spans.append(span)
                    parts.append(b"\n".join(lines[span["start"] : span["end"]]))
            at = pa.array(of, pa.int64())
            columns = [batch.column(0).take(at), batch.column(1).take(at)]
            columns += [pa.array([s[n] for s in spans], t) for n, t in _PLACES]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(parts, pa.binary())], names)

    names = ["doc_id", "key", "start", "end", "hash", "chunk"]
    shape = f"doc_id {dict(found.dtypes)['doc_id']}, key binary, start int, end int, hash long, chunk binary"
    return found.select("doc_id", "key", "text", "spans").where("spans is not null").mapInArrow(run, shape)


_PLACES = [("start", pa.int32()), ("end", pa.int32()), ("hash", pa.int64())]


def compared(found: DataFrame) -> DataFrame | None:
    """``key, settled`` for the chunks whose hash stands for more than one text, judged by bytes; None without any.

    Only bytes of repeated chunks are looked at. They meet by hash and bytes after a map-side combine.
    """
    said = chunk_bytes(found)
    mixed = said.select("hash", "chunk").distinct().groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    if mixed.isEmpty():
        return None
    place = F.struct("doc_id", "key", "start")
    exact = said.join(mixed.select("hash"), "hash")
    ends = exact.groupBy("chunk").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    judged = exact.join(ends, "chunk").select(
        "key", "start", "end", "hash", F.when(F.expr("first < last"), place != F.col("first")).alias("again")
    )
    # Null: unlike all other texts of its hash, neither a first occurrence nor a further one.
    return judged.groupBy("key").agg(F.collect_set(F.struct("start", "end", "hash", "again")).alias("settled"))


@F.arrow_udf(T.ArrayType(T.LongType()))
def lines_to_cut(spans: pa.Array, settled: pa.Array) -> pa.Array:
    """Spans ``start << 32 | end`` of further occurrences, without the lines of first ones; in order, disjoint."""

    def cut(own: list[dict] | None, judged: list[dict] | None) -> list[int] | None:
        if own is None:
            return None
        marks = {(s["start"], s["end"]): s["again"] for s in own}
        marks.update({(s["start"], s["end"]): s["again"] for s in judged or ()})
        gone = {k for (a, b), again in marks.items() if again for k in range(a, b)}
        gone -= {k for (a, b), again in marks.items() if again is False for k in range(a, b)}
        runs: list[list[int]] = []
        for k in sorted(gone):
            if runs and runs[-1][1] == k:
                runs[-1][1] = k + 1
            else:
                runs.append([k, k + 1])
        return [a << 32 | b for a, b in runs]

    return pa.array(map(cut, values(spans), values(settled)), pa.list_(pa.int64()))


@F.arrow_udf(T.StringType())
def without_lines(text: pa.Array, cuts: pa.Array) -> pa.Array:
    """The text without the line spans ``start << 32 | end``, which are in order and disjoint."""

    def cut(body: str | None, spans: list[int] | None) -> str | None:
        if not spans or body is None:
            return body
        lines, kept, at = body.split("\n"), [], 0
        for span in spans:
            kept += lines[at : span >> 32]
            at = span & 0xFFFFFFFF
        return "\n".join(kept + lines[at:])

    return pa.array(map(cut, values(text), values(cuts)), pa.string())


def dedup_lines(docs: DataFrame, counts: tuple[str, str] | None = None, hash_bits: int = 64) -> DataFrame:
    """The documents with repeated chunks taken out of ``text``; all rows and columns stay.

    Of each repeated chunk the first occurrence in order of (doc_id, row key, line) stays whole: its lines are kept
    even where they are part of another chunk. A text all of which is repeated becomes empty, a null text stays null,
    and an ``n_chars`` column is brought up to date. An empty table gives an empty result. ``counts`` names two
    columns to add (or replace): runs of lines and lines removed. Rows equal in id and text are one document: none of
    them is the other's copy, and all are rewritten alike. The documents are stored once, with their chunks.
    ``hash_bits`` is for tests of hashes that stand for several texts.
    """
    wide, cuts = F.struct(*(quoted(c).alias(c) for c in docs.columns)), F.col("cuts")
    span = F.collect_set(F.struct("start", "end", "hash", "again")).cast(_SPANS).alias("spans")
    by_doc = repeated_chunks(docs, hash_bits).groupBy("key").agg(span)
    own = row_key(quoted("doc_id"), quoted("text"))
    met = stored(docs.select(wide.alias("row"), own.alias("key")).join(by_doc, "key", "left"), "lines")
    settled = compared(met.select(F.col("row.doc_id").alias("doc_id"), "key", F.col("row.text").alias("text"), "spans"))
    met = met.join(settled, "key", "left") if settled else met.withColumn("settled", F.lit(None).cast(_SPANS))
    met = met.select("row", lines_to_cut("spans", "settled").alias("cuts"))
    out = {c: F.col("row").getField(c) for c in docs.columns}
    text = without_lines(out["text"], cuts)
    out["text"] = text
    if "n_chars" in out:
        out["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    if counts:
        spans = F.coalesce(cuts, F.array().cast("array<long>"))
        size = lambda s: s.bitwiseAND(0xFFFFFFFF) - F.shiftright(s, 32)
        out = {c: v for c, v in out.items() if c.lower() not in [n.lower() for n in counts]}
        out[counts[0]] = F.size(spans).cast("long")
        out[counts[1]] = F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + size(s))
    return met.select(*(v.alias(c) for c, v in out.items()))

import hashlib
import random

import pytest

from millrace.llm.line_dedup import chunks_of, dedup_lines
from millrace.llm.queries import QUERIES

from cases import SMALL, TINY, edge_docs, no_docs, prose


def repeated_lines(rows):
    """Lines (doc, number) of neighbouring lines seen earlier in order of id, and lines of first occurrences."""
    places = {}
    for doc_id, text in sorted(rows):
        lines = text.split("\n")
        said = [k for k, line in enumerate(lines) if line.strip(" \t\r\x0b\x0c")]
        for a, b in zip(said, said[1:]):
            places.setdefault("\n".join(lines[a : b + 1]), []).append((doc_id, a, b))
    again, first = set(), set()
    for found in places.values():
        for n, (doc_id, a, b) in enumerate(found if len(found) > 1 else ()):
            (again if n else first).update((doc_id, k) for k in range(a, b + 1))
    return again, first


def kept_lines(before, after):
    """Numbers of the lines that are gone: ``after`` is what stays, in order."""
    gone, left = set(), after.split("\n")
    at = 0
    for k, line in enumerate(before.split("\n")):
        if at < len(left) and left[at] == line:
            at += 1
        else:
            gone.add(k)
    return gone


def test_query_against_all_neighbouring_lines(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    again, first = repeated_lines(rows)
    got = {r["doc_id"]: r for r in QUERIES["op3_line_dedup"](spark, SMALL).collect()}
    clean = {r["doc_id"]: r["text"] for r in dedup_lines(docs).collect()}
    assert len(got) == len(rows) and any(r["chunks_removed"] for r in got.values())
    total = 0
    for doc_id, text in rows:
        r = got[doc_id]
        assert r["text_sha256"] == hashlib.sha256(clean[doc_id].encode()).hexdigest()
        own = {k for d, k in again if d == doc_id}
        assert r["lines_removed"] <= len(own) and (r["lines_removed"] > 0) == (r["chunks_removed"] > 0)
        if not own:
            assert clean[doc_id] == text
        total += r["lines_removed"]
    # One pair of lines in 256 is no chunk.
    assert total >= 0.97 * len(again - first)


@pytest.mark.parametrize("size", [2, 3, 4, 6, 8])
def test_planted_runs_of_lines_are_found(spark, size):
    rng = random.Random(size)
    hosts = [r["text"] for r in spark.read.parquet(f"{TINY}/documents.parquet").orderBy("doc_id").limit(240).collect()]
    rows, runs = [], []
    for k in range(0, 240, 2):
        run = [f"planted {size} {k} {j} " + " ".join(rng.choices("river stone cloud bird lamp chair".split(), k=12)) for j in range(size)]
        for n in (k, k + 1):
            lines = hosts[n].split("\n")
            at = rng.randint(0, len(lines))
            rows.append((n, "\n".join(lines[:at] + run + lines[at:])))
        runs.append(run)
    clean = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    there = [(clean[2 * n].count(line), clean[2 * n + 1].count(line)) for n, run in enumerate(runs) for line in run]
    assert all(a == 1 for a, _ in there)
    assert sum(b == 0 for _, b in there) / len(there) >= 0.95


def test_exact_copies_go_wholly_and_first_occurrences_stay(spark):
    texts = ["\n".join(f"text {k} line {j}" for j in range(2 + k % 9)) for k in range(100)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(1000 + k, t) for k, t in enumerate(texts)]
    clean = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(clean[k] == t for k, t in enumerate(texts))
    assert sum(clean[1000 + k] == "" for k in range(100)) >= 95


def test_a_chunk_stays_whole_where_it_is_first(spark):
    rows = [(1, "b one\nc two"), (2, "b one\nc two\nd six"), (3, "c two\nd six"), (4, "own\n\nb one")]
    clean = {r["doc_id"]: r["text"] for r in dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert clean == {1: "b one\nc two", 2: "c two\nd six", 3: "", 4: "own\n\nb one"}


def test_edge_cases_keep_rows_and_columns(spark):
    docs = edge_docs(spark, clashes=True)
    clean = dedup_lines(docs)
    assert clean.dtypes == docs.dtypes
    rows = clean.collect()
    assert len(rows) == docs.count()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r["text"])
    # The copies in document 2 lose to document 1, and both rows alike; a null text stays null.
    assert by_id[2][0] == by_id[2][1] != by_id[1][0]
    assert by_id[4] == [None] and by_id[5] == [""] and None in by_id[None]
    assert all(r["n_chars"] == len(r["text"]) for r in rows if r["text"] is not None)
    assert dedup_lines(no_docs(spark)).collect() == []


def test_unequal_chunks_with_equal_hashes_are_told_apart(spark):
    docs = spark.createDataFrame([(k, prose(k % 30, 150)) for k in range(60)], "doc_id long, text string")
    texts = lambda bits: sorted((r["doc_id"], r["text"]) for r in dedup_lines(docs, hash_bits=bits).collect())
    assert texts(3) == texts(64) != sorted(tuple(r) for r in docs.collect())


def test_chunks_move_only_near_an_insertion():
    lines = [f"line {k * 7919 % 1000}".encode() for k in range(300)]
    held = lambda own: {tuple(own[a:b]) for a, b in chunks_of(own)}
    assert len(held(lines) - held(lines[:150] + [b"new"] + lines[150:])) <= 1
    assert chunks_of([b"same", b"", b"same", b"same"]) == [(0, 3), (2, 4)] and chunks_of([b"", b" ", b"one"]) == []

import hashlib
import math
import re
from zlib import crc32

import numpy as np
import pytest

from millrace.llm import resampling
from millrace.llm.queries import QUERIES
from millrace.llm.resampling import cutoff, hashed_features, importance_ranks, resample

from cases import SMALL, edge_docs, edge_rows, no_docs, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [crc32(f.encode()) % 10000 for f in found]


def plain(docs, target):
    """Rows of (doc_id, n_features, weight, score, rank), the slow way."""
    of = [plain_features(t) for _, t in docs]
    s, t = np.zeros(10000, int), np.zeros(10000, int)
    for _, f in of:
        np.add.at(s, f, 1)
    for text in target:
        np.add.at(t, plain_features(text)[1], 1)
    gain = [
        math.floor(1000 * math.log((t[b] + 1.0) * (s.sum() + 10000.0) / ((s[b] + 1.0) * (t.sum() + 10000.0))))
        for b in range(10000)
    ]
    rows = []
    for (i, _), (n, f) in zip(docs, of):
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(f), weight, score, None, n])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able[: len(able) * 25 // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=str)


def ranks(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    target = [r["text"] for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    assert ranks(QUERIES["op11_importance_resampling"](spark, SMALL)) == plain([tuple(d) for d in docs], target)


def test_edge_cases(spark):
    target = spark.createDataFrame([(None, 1), ("The cat sat on a mat", 2), ("", 3)], "text string, weight int")
    got = importance_ranks(edge_docs(spark, clashes=True), target)
    want = plain([(r[0], r[1]) for r in edge_rows()], [None, "The cat sat on a mat", ""])
    assert ranks(got) == want
    assert ranks(importance_ranks(no_docs(spark), target)) == []
    assert ranks(importance_ranks(edge_docs(spark), target.limit(0))) == plain([(r[0], r[1]) for r in edge_rows()], [])


@pytest.mark.parametrize("runs", [1, 2, 3])
def test_a_text_in_pieces_has_the_same_features(monkeypatch, runs):
    text = (prose(3, 400) + " ÄÖ Жизнь\U0001f600x\x7fy 12a " * 30).encode()
    whole = list(hashed_features(text, runs, 10000))
    assert len(whole) == 1
    monkeypatch.setattr(resampling, "PIECE", 7)
    parts = list(hashed_features(text, runs, 10000))
    assert len(parts) > 100 and sum(n for n, _ in parts) == whole[0][0]
    assert sorted(np.concatenate([p for _, p in parts]).tolist()) == sorted(whole[0][1].tolist())


@pytest.mark.parametrize("bracket", [3, 100_000])
@pytest.mark.parametrize("shape", ["spread", "ties", "two", "one"])
def test_cutoff_is_exact(spark, bracket, shape):
    rng = np.random.default_rng(3)
    values = {
        "spread": rng.integers(-(10**9), 10**9, 5000),
        "ties": np.concatenate([np.full(3000, 5), rng.integers(-100, 100, 2000)]),
        "two": np.repeat([7, -7], 2500),
        "one": np.full(5000, 3),
    }[shape].tolist()
    df = spark.createDataFrame([(int(v),) for v in values], "score long").repartition(5)
    for wanted in (17, 1250, 5000):
        # A rough sketch proposes brackets that miss, so that they have to be widened.
        assert cutoff(df, "score", wanted, bracket, accuracy=20) == sorted(values, reverse=True)[wanted - 1]


def test_brackets_and_ranges_give_the_same_ranks(spark):
    docs = spark.createDataFrame([(k // 2, prose(k // 40, 30 + k % 3)) for k in range(400)], "doc_id long, text string")
    target = spark.createDataFrame([(prose(1, 50),)], "text string")
    one = ranks(importance_ranks(docs, target))
    assert one == ranks(importance_ranks(docs.repartition(7), target, bracket=3))
    assert sorted(r[4] for r in one if r[4]) == list(range(1, 101))


def test_drawn_rows_come_whole(spark):
    docs = spark.createDataFrame(
        [(1, prose(1, 40), "x", 1)] * 6 + [(2, prose(2, 40), "y", 2), (3, None, "z", 3)],
        "doc_id long, text string, Rank string, drawn int",
    )
    target = spark.createDataFrame([(prose(1, 40),)], "text string")
    got = resample(docs, target, percent=60)
    wanted = importance_ranks(docs, target, percent=60).where("rank is not null").groupBy("doc_id").count()
    assert got.columns == docs.columns
    assert {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()} == {
        r["doc_id"]: r["count"] for r in wanted.collect()
    }
    assert got.count() == 4

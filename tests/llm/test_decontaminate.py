import random

import pytest

from millrace.llm.decontaminate import WORDS, Index, decontaminate, distance_within, edits, matches
from millrace.llm.queries import QUERIES

from cases import SMALL, TINY, edge_docs, no_docs, prose


def least_edits(item, text):
    """Sellers' table: the item against any part of the text."""
    above = [0] * (len(text) + 1)
    for k, word in enumerate(item):
        row = [k + 1]
        for j, other in enumerate(text):
            row.append(min(above[j] + (word != other), above[j + 1] + 1, row[j] + 1))
        above = row
    return min(above)


def test_bit_parallel_distance():
    rng = random.Random(4)
    for _ in range(300):
        item = [rng.randrange(6) for _ in range(rng.randrange(1, 20))]
        text = [rng.randrange(6) for _ in range(rng.randrange(0, 40))]
        assert distance_within(item, text)[0] == least_edits(item, text)
    long = list(range(200))
    assert distance_within(long, [7, *range(200), 9]) == (0, 201)


def test_query_equals_brute_force(spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    index = Index(items, 0.8, 0.98, 8)
    want = set()
    for doc_id, text in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect():
        ids = [index.vocabulary.get(w, 0) for w in WORDS.findall(text.lower())]
        for item_id, words in index.items:
            if distance_within(words, ids)[0] <= edits(len(words), 0.8):
                want.add((doc_id, item_id))
    got = QUERIES["op8_decontaminate"](spark, SMALL).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want != set()


def edited(words, count, rng):
    words = list(words)
    for _ in range(count):
        at, kind = rng.randrange(len(words)), rng.randrange(3)
        words[at : at + (kind != 1)] = [] if kind == 2 else [f"new{rng.randrange(10**6)}"]
    return words


@pytest.fixture(scope="module")
def bench(spark):
    return spark.read.parquet(f"{TINY}/benchmark.parquet")


def test_edited_passages_are_found_at_the_target_recall(spark, bench):
    rng, rows, planted = random.Random(8), [], {}
    for k, (item_id, text) in enumerate(bench.select("item_id", "text").collect() * 3):
        words = WORDS.findall(text.lower())
        said = edited(words, edits(len(words), 0.8), rng)
        planted[k] = item_id
        rows.append((k, f"{prose(k, 90)} {' '.join(said)} {prose(k + 500, 90)}"))
    rows += [(10_000 + k, prose(k + 900, 400)) for k in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in matches(docs, bench).collect()}
    assert sum((k, i) in got for k, i in planted.items()) >= 0.97 * len(planted)
    assert not any(k >= 10_000 for k, _ in got)


def test_blocks_of_the_benchmark_give_the_same_answer(spark, bench):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    whole = sorted(map(tuple, matches(docs, bench).collect()))
    assert sorted(map(tuple, matches(docs, bench, block_bytes=2000).collect())) == whole != []
    kept = decontaminate(docs, bench, block_bytes=2000)
    assert kept.columns == docs.columns and kept.count() == docs.count() - len({r[0] for r in whole})


def test_edge_cases(spark, bench):
    docs = edge_docs(spark, clashes=True)
    own = spark.createDataFrame([(1, prose(1, 40)), (1, prose(1, 40)), (None, prose(2, 30)), (3, None), (4, ""), (5, "too short")], "item_id long, text string")
    got = matches(docs, own).select("doc_id", "item_id").collect()
    assert sorted((r[0] or 0, r[1] or 0) for r in got if r[1]) == [(1, 1)] * 2 + [(2, 1)] * 4 + [(14, 1)] * 2
    assert [r[0] for r in got if r[1] is None] == [None]
    kept = decontaminate(docs, own)
    assert kept.dtypes == docs.dtypes and kept.count() == docs.count() - 5
    assert matches(no_docs(spark), bench).collect() == [] == decontaminate(no_docs(spark), bench).collect()
    empty = bench.where("item_id < 0")
    assert matches(docs, empty).collect() == [] and decontaminate(docs, empty).count() == docs.count()

import numpy as np
import pytest
import xxhash

from millrace.llm.queries import QUERIES
from millrace.llm.simhash import fingerprint, forest, keep_one, levels, links, near, simhash_groups

from cases import SMALL, Union, edge_docs, no_docs


def plain(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    said = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(s, seed=42).intdigest() for s in said]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, ids, distance=4):
    union, bits = Union(range(len(prints))), np.array(prints, np.uint64)
    for k in range(len(bits)):
        for j in np.flatnonzero(np.bitwise_count(bits ^ bits[k]) <= distance):
            union.join(k, int(j))
    known = {}
    for k, i in enumerate(ids):
        if i is not None:
            known[union.root(k)] = min(i, known.get(union.root(k), i))
    return [known.get(union.root(k)) for k in range(len(ids))]


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: r for r in QUERIES["op7_simhash_near_dedup"](spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    prints = [plain(d["text"]) for d in docs]
    want = grouped(prints, [d["doc_id"] for d in docs])
    assert len(got) == len(docs)
    for d, p, c in zip(docs, prints, want):
        assert (got[d["doc_id"]]["fingerprint"], got[d["doc_id"]]["component_id"]) == (f"{p:016x}", c)


def test_edge_cases(spark):
    rows = edge_docs(spark, clashes=True).select("doc_id", "text").collect()
    got = simhash_groups(edge_docs(spark, clashes=True)).collect()
    key = lambda i, p, c: (i is None, i or 0, p, c is None, c or 0)
    prints = [plain(r["text"]) for r in rows]
    want = grouped(prints, [r["doc_id"] for r in rows])
    signed = [int(np.array([p], np.uint64).view(np.int64)[0]) for p in prints]
    assert sorted(key(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == sorted(
        key(r["doc_id"], p, c) for r, p, c in zip(rows, signed, want)
    )
    assert simhash_groups(no_docs(spark)).collect() == []


def test_fingerprint_of_many_shingles_in_parts():
    text = " ".join(f"w{k}" for k in range(70_000))
    parts = fingerprint(text.encode(), 4)
    hashes = np.array([xxhash.xxh64(" ".join(f"w{j}" for j in range(k, k + 4)).encode(), seed=42).intdigest() for k in range(69_997)], np.uint64)
    ones = [(2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes)) for b in range(64)]
    assert parts & (2**64 - 1) == sum(1 << b for b, o in enumerate(ones) if o)


def clustered(n):
    rng = np.random.default_rng(1)
    centres = rng.integers(0, 1 << 63, n // 10, np.uint64)
    flips = np.zeros(n, np.uint64)
    for _ in range(5):
        flips ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    return np.unique(centres[rng.integers(0, len(centres), n)] ^ flips)


@pytest.mark.parametrize("blocks, size", [(1, 1 << 20), (5, 64), (3, 7)])
def test_index_finds_every_link_in_blocks(spark, blocks, size):
    bits = clustered(400)
    df = spark.createDataFrame([(int(b),) for b in bits.view(np.int64)], "fingerprint long")
    union = Union(range(len(bits)))
    place = {int(b): k for k, b in enumerate(bits.view(np.int64))}
    for r in links(df, 4, blocks, size).collect():
        union.join(place[r["a"]], place[r["b"]])
    want = grouped(bits.tolist(), list(range(len(bits))))
    assert [union.root(k) for k in range(len(bits))] == want


def test_hierarchy_prunes_but_loses_nothing():
    a, b = clustered(300), clustered(170)
    found = {(int(x), int(y)) for p, q in near(levels(a), levels(b), 6, same=False) for x, y in zip(p, q)}
    apart = np.bitwise_count(a[:, None] ^ b[None, :])
    assert found == {(int(x), int(y)) for x, y in zip(*np.nonzero(apart <= 6))}


def test_forest_is_a_star_for_each_component():
    a, b = np.array([1, 2, 3, 8, 5], np.uint64), np.array([2, 3, 4, 9, 5], np.uint64)
    left, right = forest(a, b)
    assert dict(zip(left.tolist(), right.tolist())) == {2: 1, 3: 1, 4: 1, 9: 8}


def test_one_row_of_each_group_stays_with_all_columns(spark):
    docs = edge_docs(spark, clashes=True)
    kept = keep_one(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    rows = kept.collect()
    groups = {(r["fingerprint"], r["component_id"]) for r in simhash_groups(docs).collect()}
    assert len(rows) == len({plain(r["text"]) for r in rows}) <= len(groups)
    ids = [r["doc_id"] for r in rows]
    assert 1 in ids and 2 not in ids and ids.count(4) + ids.count(5) == 1
    assert keep_one(no_docs(spark)).collect() == []

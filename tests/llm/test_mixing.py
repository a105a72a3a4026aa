import re

import duckdb
import pytest

from millrace.llm import mixing
from millrace.llm.queries import ORACLE_SQL, QUERIES

from cases import CLASHES, SMALL, TINY, edge_docs, edge_rows, no_docs


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Reshare the excess by weight until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    total = share * sum(sizes.values())
    target = {s: total * weight[s] / sum(weight.values()) for s in order}
    for _ in range(200):
        excess = 0.0
        for s in order:
            if target[s] > most * sizes[s]:
                excess, target[s] = excess + target[s] - most * sizes[s], most * sizes[s]
        open_ = [s for s in order if target[s] < most * sizes[s]]
        if excess < 1e-9 or not open_:
            break
        for s in open_:
            target[s] += excess * weight[s] / sum(weight[o] for o in open_)
    return target


def check(rows, docs):
    sizes, words = {}, lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + words(text)
    want = plain_targets(sizes)
    by_source = {}
    for r in rows:
        assert r["size"] == words(r["text"]) and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6)
        assert r["copies"] in (0, 1, 2) and abs(r["copies"] - r["target"] / max(1, r["source_size"])) <= 1
        by_source.setdefault(r["source"], []).append(r["size"] * r["copies"])
    return {s: (sum(own), want[s]) for s, own in by_source.items()}


def test_targets_and_copies(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    plan = mixing.mix_plan(docs)
    sums = check(plan.collect(), [tuple(r) for r in docs.select("doc_id", "text", "source").collect()])
    assert abs(sum(a for a, _ in sums.values()) / sum(b for _, b in sums.values()) - 1) < 0.05
    assert all(abs(a / b - 1) < 0.25 for a, b in sums.values())
    assert sorted(map(tuple, mixing.mix_plan(docs.repartition(7)).select("doc_id", "copies").collect())) == sorted(
        map(tuple, plan.select("doc_id", "copies").collect())
    )


def test_edge_cases(spark):
    check(mixing.mix_plan(edge_docs(spark)).collect(), [(i, t, s) for i, t, _, s, _ in edge_rows()])
    assert mixing.mix_plan(no_docs(spark)).collect() == [] == mixing.mix(no_docs(spark)).collect()
    silent = spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string")
    assert [r["copies"] for r in mixing.mix_plan(silent).collect()] == [0, 0]


def test_clashing_columns(spark):
    docs = edge_docs(spark, clashes=True)
    mixed = mixing.mix(docs, copy_column="copy")
    assert mixed.columns == [c for c in docs.columns if c != "Copy"] + ["copy"]
    plan = mixing.mix_plan(edge_docs(spark)).agg({"copies": "sum"}).first()[0]
    assert mixed.count() == plan and {r["size"] for r in mixed.collect()} == {2}
    assert len(CLASHES) and set(mixing.PLAN) <= set(mixing.mix_plan(docs).columns)


def test_many_sources_are_joined_by_a_shuffle(spark, monkeypatch):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "source", "text")
    sent = sorted(map(tuple, mixing.mix_plan(docs).select("doc_id", "copies").collect()))
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", -1)
    assert sorted(map(tuple, mixing.mix_plan(docs).select("doc_id", "copies").collect())) == sent


@pytest.mark.parametrize("edge", [False, True])
def test_query_equals_sql(spark, tmp_path, edge):
    folder = SMALL
    if edge:
        folder = str(tmp_path)
        edge_docs(spark).write.parquet(f"{folder}/documents.parquet")
    path = f"{folder}/documents.parquet" + ("/*.parquet" if edge else "")
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{path}'")
    own = db.execute(ORACLE_SQL["op6_mix_sources"]).fetchall()
    got = [tuple(r) for r in QUERIES["op6_mix_sources"](spark, folder).collect()]
    assert sorted(got, key=str) == sorted(own, key=str)

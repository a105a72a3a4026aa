import numpy as np
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm.queries import QUERIES, labelled

from cases import TINY, edge_docs, no_docs, prose


def test_labelled_documents_are_found_and_clean_ones_left_alone(spark):
    got = QUERIES["op2_toxicity"](spark, TINY)
    labels = spark.read.parquet(f"{TINY}/labels.parquet").select("doc_id", F.col("toxic").alias("y"))
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == 1000
    assert sum(r["toxic"] and r["y"] == 0 for r in rows) <= 0.005 * sum(r["y"] == 0 for r in rows)
    assert sum(r["toxic"] and r["y"] == 1 for r in rows) >= 0.55 * sum(r["y"] == 1 for r in rows)


def planted(spark, n=600):
    rows = []
    for k in range(n):
        a, b = k % 5 == 0, k % 10 == 0
        rows.append((k, prose(k, 60) + " vileness" * a + " gruesome" * b, int(a), int(b)))
    return spark.createDataFrame(rows, "doc_id long, text string, a int, b int")


def test_chain_on_held_out_rows(spark):
    docs = planted(spark)
    model = toxicity.fit(docs.where("doc_id < 400"), ["a", "b"])
    rows = toxicity.score(docs, model).join(docs.select("doc_id", F.col("a").alias("ya"), F.col("b").alias("yb")), "doc_id")
    late = rows.where("doc_id >= 400").collect()
    assert all(r["a"] == bool(r["ya"]) and r["b"] == bool(r["yb"]) for r in late)
    # Only the second model has a weight for an earlier probability.
    assert [len(b) - model.words for b in model.betas] == [1, 2]


def test_sample_is_bounded_and_keeps_the_shares(spark):
    model = toxicity.fit(planted(spark, 900), ["a"], per_class=60)
    rows = toxicity.score(planted(spark, 300), model).collect()
    assert abs(np.mean([r["p_a"] for r in rows]) - 0.2) < 0.1


def test_a_cut_class_with_repeated_texts_keeps_its_share(spark):
    docs = planted(spark, 900)
    copies = docs.where("a = 0").selectExpr("doc_id + 10000 as doc_id", "text", "a", "b")
    docs = docs.unionAll(copies)  # 180 of 1,620 rows have a
    shares = []
    for per_class in (60, 300, 6000):
        model = toxicity.fit(docs, ["a"], per_class=per_class)
        shares.append(np.mean([r["p_a"] for r in toxicity.score(docs, model).collect()]))
    assert np.allclose(shares, 180 / 1620, atol=0.05)


def test_labels_beyond_the_sample_count_in_the_shares(spark, tmp_path):
    docs = planted(spark, 900)
    docs.select("doc_id", "text").write.parquet(f"{tmp_path}/documents.parquet")
    docs.selectExpr("doc_id", "a as toxic").write.parquet(f"{tmp_path}/labels.parquet")
    few = labelled(spark, str(tmp_path), most=100)
    assert {r["toxic"]: round(r["n"], 6) for r in few.groupBy("toxic").agg(F.sum("stands_for").alias("n")).collect()} == {0: 720, 1: 180}
    model = toxicity.fit(few, ["toxic"], per_class=60, stands_for="stands_for")
    assert abs(np.mean([r["p_toxic"] for r in toxicity.score(docs, model).collect()]) - 0.2) < 0.05


def test_regression_of_known_weights():
    rng = np.random.default_rng(0)
    word = rng.random((4000, 2)) < 0.3
    y = (rng.random(4000) < 1 / (1 + np.exp(-(word @ np.array([2.0, -1.0]) - 0.5)))).astype(float)
    row, col = np.nonzero(word)
    beta = toxicity.regress(toxicity.Rows(row, col, 4000, 2, np.zeros((4000, 0))), y, np.ones(4000))
    assert np.allclose(beta, [2.0, -1.0, -0.5], atol=0.25)


def test_edge_cases(spark):
    model = toxicity.fit(planted(spark, 200), ["a", "b"])
    docs = edge_docs(spark, clashes=True)
    rows = toxicity.score(docs, model).collect()
    assert len(rows) == docs.count() and not any(r["a"] for r in rows)
    assert toxicity.score(no_docs(spark), model).collect() == []
    for labelled in (planted(spark, 0 + 1).where("doc_id < 0"), planted(spark, 200).where("a = 0"), planted(spark, 50).selectExpr("doc_id", "text", "cast(null as int) as a", "b")):
        blank = toxicity.score(docs, toxicity.fit(labelled, ["a", "b"])).collect()
        assert len(blank) == docs.count() and not any(r["a"] or r["b"] for r in blank)

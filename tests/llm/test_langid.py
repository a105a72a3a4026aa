from pyspark.sql import functions as F

from millrace.llm import langid
from millrace.llm.queries import QUERIES

from cases import TINY, edge_docs, no_docs


def test_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op1_language_id"](spark, TINY).collect()}
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "lang").collect()
    held = [d for d in docs if got[d["doc_id"]]["held_out"]]
    assert len(got) == len(docs) and 0.15 < len(held) / len(docs) < 0.35
    assert sum(got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held) / len(held) >= 0.98
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_held_out_is_the_checksum_of_the_id(spark):
    import zlib

    df = spark.range(200).select(F.col("id"), langid.held_out(F.col("id")).alias("h"))
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 4 == 2) for r in df.collect())
    assert spark.sql("select cast(null as long) as id").select(langid.held_out(F.col("id"))).first()[0] is False


def test_a_larger_sample_is_cut_to_its_bound(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    model = langid.fit(docs, per_language=40)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("lang = lang_pred").count() / docs.count() > 0.95


def test_edge_cases(spark):
    model = langid.fit(spark.read.parquet(f"{TINY}/documents.parquet"), per_language=60)
    docs = edge_docs(spark, clashes=True)
    rows = [tuple(r) for r in langid.identify(docs, model).collect()]
    assert len(rows) == docs.count()
    unknown = sorted(str(r[0]) for r in rows if r[1] == "und")
    assert unknown == ["12", "4", "5", "6", "8", "None"] and all(r[2] == 0 for r in rows if r[1] == "und")
    kept = langid.keep_identified(docs, model, 0.0)
    assert kept.dtypes == docs.dtypes and kept.count() == docs.count() - 6 and kept.where("lang is null").count() == 0
    assert langid.identify(no_docs(spark), model).collect() == []


def test_few_or_no_languages(spark):
    docs = spark.createDataFrame([(1, "hello there", "en"), (2, "hi you", "en"), (3, "so", None), (4, None, "de")], "doc_id long, text string, lang string")
    one = langid.identify(docs, langid.fit(docs)).collect()
    assert [tuple(r)[1:] for r in sorted(one)] == [("en", 1.0)] * 3 + [("und", 0.0)]
    none = langid.identify(docs, langid.fit(docs.where("lang is null"))).collect()
    assert {r["lang_pred"] for r in none} == {"und"}
    odd = docs.unionAll(spark.createDataFrame([(5, "zzz xxx qqq", "x'y"), (6, "zzz qq xx", "x'y")], docs.schema))
    assert {r["lang_pred"] for r in langid.identify(odd, langid.fit(odd)).collect()} == {"en", "x'y", "und"}

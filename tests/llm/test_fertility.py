import base64
import math
import random
import re
from collections import Counter

import pytest
import tiktoken
from pyspark.sql import functions as F

from millrace.llm import fertility
from millrace.llm.queries import QUERIES

from cases import TINY, edge_docs, edge_rows, no_docs, prose


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, copies = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            copies += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), copies, len(covered)


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_query_equals_brute_force(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op9_tokeniser_quality"](spark, TINY).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert tuple(r[n] for n in BASE) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("text", [r[1] for r in edge_rows() if not r[1] or len(r[1]) < 70_000])
def test_base_measures(text):
    assert fertility.base_measures(text) == plain(text)


def test_measures_of_the_vocabularies():
    for v in fertility.PRODUCTION:
        chars, foreign, entropy = v.measure("the the the the")
        assert chars > 2 and foreign == 0 and entropy < 1.01
        assert v.measure("") == (0.0, 0.0, 0.0)
        assert v.measure("\U00010900\U00010901\U00012000")[1] > 0.5
    assert fertility.script_of("Жизнь abc") == "cyrillic" and fertility.script_of("12") == "none"
    assert fertility.script_of("漢字かな漢") == "han" and fertility.script_of("été") == "latin"


def test_outliers_of_a_group_go_and_usual_texts_stay(spark):
    rows = [(k, prose(k, 80), "en") for k in range(150)] + [(1000, " ".join(f"q{k}x#{k * 7919}~" for k in range(80)), "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in fertility.judge(docs, least_documents=50).collect()}
    assert got[1000] is False and sum(got.values()) >= 148
    assert all(r["kept"] for r in fertility.judge(docs, least_documents=5000).collect())


def test_rare_groups_are_judged_by_larger_ones(spark):
    rows = [(k, prose(k, 60 + k % 60), "en") for k in range(300)]
    rows += [(1000 + k, prose(5000 + k, 70), "xx") for k in range(3)] + [(1010, prose(77, 1500), "en"), (1011, prose(78, 18), "en")]
    junk = lambda n: " ".join(f"q{k}x#{k * 7919}~" for k in range(n))
    rows += [(2000, junk(80), "xx"), (2001, junk(1500), "en"), (2002, junk(30), None), (2003, junk(80), "yy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in fertility.judge(docs, least_documents=50).collect()}
    assert not any(got[k] for k in (2000, 2001, 2002, 2003))
    assert all(got[k] for k in (1000, 1001, 1002)) and sum(got.values()) >= 300


def test_a_usual_text_with_one_foreign_sign_stays(spark):
    rows = [(k, prose(k, 80), "en") for k in range(150)] + [(500 + k, prose(k, 20), "en") for k in range(60)]
    rows += [(1000, prose(400, 80) + " \U0001f600", "en"), (1001, prose(401, 20) + " \U0001f600", "en"), (1002, prose(402, 80) + " \U00010900", "en")]
    rows += [(2000, prose(403, 80) + " \U00010900\U00010901" * 60, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: r["kept"] for r in fertility.judge(docs, least_documents=50).collect()}
    assert got[1000] and got[1001] and got[1002] and not got[2000]


def test_edge_cases(spark):
    docs = edge_docs(spark, clashes=True)
    got = fertility.judge(docs)
    rows = got.collect()
    assert len(rows) == docs.count() and got.where(F.col("kept").isNull() | F.col("base_failed").isNull()).count() == 0
    assert all(r["base_failed"] for r in rows if r["doc_id"] in (4, 5, 6, 7, 8, 11, 12))
    kept = fertility.keep_good(docs)
    assert kept.dtypes == docs.dtypes and kept.count() == sum(r["kept"] for r in rows)
    assert fertility.judge(no_docs(spark)).collect() == []
    assert fertility.judge(docs.drop("lang")).count() == docs.count()


@pytest.mark.parametrize("few_bands", [100_000, 0])
def test_a_table_of_few_documents_is_judged_by_the_prior_bands(spark, monkeypatch, few_bands):
    monkeypatch.setattr(fertility, "FEW_BANDS", few_bands)
    strange = " ".join(chr(0x12000 + k) * 3 for k in range(40))
    rows = [(1, prose(1, 80), "en"), (2, strange, "en"), (3, prose(3, 60), None), (4, "a b c", "en"), (5, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in fertility.judge(docs).collect()}
    assert got == {1: (False, True), 2: (False, False), 3: (False, True), 4: (True, False), 5: (True, False)}


def test_measures_are_those_of_the_plain_pattern_and_counts():
    rng, signs = random.Random(3), "ab1 \n\t'.s 　\x1c\x85漢é́\U0001f600\U00010900 -  Ⅷ²lvre'd"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    ready = fertility.PRODUCTION[0].ready()
    with open(f"{fertility.TOKENIZERS}/{fertility.PRODUCTION[0].file}", "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    coder = tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for text in texts:
        ids = coder.encode_ordinary(text)
        counts = Counter(ids)
        entropy = sum(-n / len(ids) * math.log2(n / len(ids)) for n in counts.values())
        foreign = sum(bool(ready["broken"][i]) for i in ids) / len(ids)
        want = (len(text) / len(ids), foreign, pytest.approx(entropy, abs=1e-9))
        assert fertility.PRODUCTION[0].measure(text) == want

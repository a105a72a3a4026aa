import hashlib
import random
import re

import pytest

from millrace.llm import pii
from millrace.llm.queries import QUERIES

from cases import SMALL, TINY, edge_docs, no_docs

LARGE = "/root/testdata/sf0.1"
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
TEXTS = [
    "a@b.c_x@d.e x@y@z.w a.b@c.d. foo@bar..com a@-.-",
    "1.2.3.4.5.6.7.8 999.1.2.3.4 0001.02.3.255 12.12.12.256 00000000000000000000255.1.1.1",
    "+1 (171) 555-2028 ++1 234 567 890- +12 +1234567890123456 +1(2",
    "4012888888881881 x4111-1111-1111-1111y 4111-1111-1111-1112 378282246310005,4111 1111 1111 1111 2",
    "ü\U0001f600é foo@bar.de \U0001f600 10.0.0.1\n10.0.0.2",
    "a" * 30_000 + "@" + "b." * 3_000 + "c",
    "7" * 40_000,
    "1." * 5_000,
    "+1" * 3_000,
    "x@y.z " * 400,
    "",
    None,
]


def luhn(digits):
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub(r"[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]()
            if ok:
                found.append((m.start(), rank, m.end(), kind))
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(spark.read.parquet(f"{TINY}/documents.parquet"))


def test_query_equals_brute_force(spark):
    texts = dict(map(tuple, spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()))
    rows = QUERIES["op4_personal_data"](spark, SMALL).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(f"{k}:") for w in want) for k in pii.KINDS]
        assert set(want) <= set(r["spans"].split(","))


def test_hard_texts(spark, model):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    for r in pii.find_personal(df, model).select("doc_id", pii.listed("base").alias("b"), "spans").collect():
        assert r["b"].split(",") == (plain(TEXTS[r["doc_id"]]) or [""])
        assert list(r["spans"]) == sorted(r["spans"], key=lambda s: (s["start"], s["kind"]))


def test_added_spans_overlap_nothing(spark):
    everything = pii.Model("double(0.5) + x.f[0] / 1000", {k: 0.5 for k in range(4)})
    df = spark.createDataFrame(
        [(1, "call (171) 555-2028 or 1.2.3.4 or joe (at) example (dot) com, 4111/1111/1111/1112 and a@b.de")], "doc_id long, text string"
    )
    row = pii.find_personal(df, everything).first()
    spans = sorted((s["start"], s["end"]) for s in row["spans"])
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:])) and len(spans) > len(row["base"]) == 2
    assert pii.redact(df, everything).first()["text"].startswith("call <phone> or <ip> or <email>, <card> and <email>")


def test_learnt_trees_are_the_models_own(spark):
    lines = ["If (feature 2 <= 1.5)", " Predict: -0.5", "Else (feature 2 > 1.5)", " If (feature 0 <= 3.0)", "  Predict: 0.25", " Else (feature 0 > 3.0)", "  Predict: 1.0"]
    sql = pii.tree_sql(list(lines))
    df = spark.sql("select inline(array(struct(struct(array(2D,0D,1D) as f) as x), struct(struct(array(2D,0D,2D) as f) as x), struct(struct(array(4D,0D,2D) as f) as x)))")
    assert [r[0] for r in df.selectExpr(sql).collect()] == [-0.5, 0.25, 1.0]


def test_thresholds_follow_precision():
    row = lambda b, c, n: {"kind": 3, "bin": b, "label": c, "count": n}
    bins = [row(10, 0.0, 50), row(40, 1.0, 100), row(49, 1.0, 200), row(20, 1.0, 10), row(20, 0.0, 10)]
    even = {(3, 0.0): 1.0, (3, 1.0): 1.0}
    assert pii._thresholds(bins, even, 0.95) == {3: 0.4}
    assert pii._thresholds(bins, even | {(3, 0.0): 1000.0}, 0.95) == {3: 0.8}
    assert pii._thresholds([row(10, 0.0, 50)], even, 0.95) == {}


def test_all_spans_and_candidates_count(spark, monkeypatch):
    """Far more of them than the classes are to weigh: none is left out, and the weights add up to the wanted ones."""
    seen, fit = [], pii.GBTClassifier.fit
    monkeypatch.setattr(pii.GBTClassifier, "fit", lambda self, df: seen.append(df.collect()) or fit(self, df))
    texts = [f"mail jo{k}@web{k}.org or call +49 (171) 555-{1000 + k}, id=12-{1000 + k}-{2000 + k}" for k in range(300)]
    spans = pii.prepare(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    pii.fit_prepared(spans, per_class=70)
    shown = spans.selectExpr("h", "posexplode(shown) as (n, x)").selectExpr("xxhash64(h, n) as h", "x.kind", "x")
    wanted = pii._planted(shown).unionAll(pii._technical(spans)).where("pmod(h, 3) > 0").count()
    assert sum(r["n"] for r in seen[0]) == wanted > 5000
    assert len(seen[0]) < 500 and sum(r["weight"] for r in seen[0]) < 0.1 * wanted


def test_main_path_has_no_python(spark, model):
    plan = pii.find_personal(spark.read.parquet(f"{SMALL}/documents.parquet"), model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_edge_cases(spark, model):
    docs = edge_docs(spark, clashes=True)
    found = pii.find_personal(docs, model)
    assert found.columns == ["doc_id", "text", "base", "spans"] and found.count() == docs.count()
    clean = pii.redact(docs, model)
    assert clean.dtypes == docs.dtypes
    same = lambda df: sorted((str(r["doc_id"]), str(r["text"])) for r in df.collect())
    assert same(clean) == same(docs)
    assert pii.find_personal(no_docs(spark), pii.fit(no_docs(spark))).collect() == []
    assert pii.fit(spark.createDataFrame([(1, None), (2, "no data")], "doc_id long, text string")).thresholds == {}


def test_spellings_that_the_base_rules_miss_are_found(spark):
    """Planted at random places of clean texts: 0.9 of the spellings are found, 0.95 of what is added is one of them."""
    model = pii.fit(spark.read.parquet(f"{LARGE}/documents.parquet"))
    assert set(model.thresholds) == {0, 1, 2, 3}
    docs = spark.read.parquet(f"{TINY}/documents.parquet")
    rng = random.Random(5)
    n = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    group = lambda: f"{rng.randrange(4096, 65536):x}"
    personal = {
        "email": lambda: rng.choice(["jo.li{0}(at)web{1}.org", "anna_{0} [at] post{1} [dot] de", "{0}.ng @ inbox{1}.com"]).format(n(2), n(1)),
        "ip": lambda: "2001:db8:" + ":".join(group() for _ in range(4)),
        "card": lambda: rng.choice([".", "/", "_"]).join(n(4) for _ in range(4)),
        "phone": lambda: rng.choice(["0049 (171) {0}-{1}", "({2}) {0}-{1}", "{2}.{0}.{1}", "{2}-{0}-{1}"]).format(n(3), n(4), n(3)),
    }
    technical = [
        lambda: f"20{n(2)}-0{rng.randrange(1, 10)}-1{n(1)} 1{n(1)}:3{n(1)}", lambda: f"v{n(1)}.{n(2)}.{n(1)}", lambda: f"key = \"{n(16)}\"",
        lambda: f"ISBN 978-{n(1)}-{n(4)}-{n(4)}-{n(1)}", lambda: f"1{n(1)}:2{n(1)}:3{n(1)}", lambda: f"3.{n(12)}", lambda: f"1{n(1)} @ {n(1)}.{n(2)}",
    ]
    texts = [r[0] for r in docs.where("text is not null and text not rlike '[0-9@]'").orderBy("doc_id").select("text").limit(300).collect()]
    made, planted = [], {}
    for k, text in enumerate(texts):
        words = text.split(" ")
        at = rng.randrange(len(words) + 1)
        kind = rng.choice([*personal, None])
        said = personal[kind]() if kind else rng.choice(technical)()
        before = " ".join(words[:at] + [""])
        made.append((k, before + said + " " + " ".join(words[at:])))
        planted[k] = kind, len(before), len(before) + len(said)
    hits, added, of = 0, 0, sum(kind is not None for kind, _, _ in planted.values())
    for r in pii.find_personal(spark.createDataFrame(made, "doc_id long, text string"), model).select("doc_id", "base", "spans").collect():
        kind, start, end = planted[r["doc_id"]]
        new = [s for s in r["spans"] if s not in r["base"]]
        right = [s for s in new if kind and pii.KINDS[s["kind"]] == kind and min(end, s["end"]) - max(start, s["start"]) >= 0.7 * (end - start)]
        hits, added = hits + bool(right), added + len(new)
        assert len(right) <= 1
    assert hits >= 0.9 * of and hits >= 0.95 * added

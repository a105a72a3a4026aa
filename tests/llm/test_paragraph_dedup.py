import random
import re
from collections import defaultdict

import numpy as np
import pytest

from millrace.llm import paragraph_dedup as pd_
from millrace.llm.queries import QUERIES

from cases import SMALL, Union, edge_docs, no_docs, prose


def said(text):
    return [w.lower() for w in re.findall(r"\w+", text)]


def sets(text):
    words = said(text)
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def sentence_starts(text):
    """Places of first words of lines and of sentences after one of six words, the plain way."""
    found = []
    for m in re.finditer(r"(?:^|[.!?\n])[^\w.!?\n]*(\w)", text):
        before = re.findall(r"\w+", re.split(r"[.!?\n]", re.sub(r"[^\w]+$", "", text[: m.start(1)]))[-1])
        if not found or len(before) >= 6:
            found.append(m.start(1))
    return found


def test_rows_are_true_and_complete(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect() if r["text"]}
    rows = QUERIES["op10_paragraph_dedup"](spark, SMALL).collect()
    classes = defaultdict(list)
    for r in rows:
        classes[r["class"]].append(r)
    for own in classes.values():
        texts = [sets(docs[r["doc_id"]][r["start"] : r["end"]]) for r in own]
        first = min((r["doc_id"], r["start"]) for r in own)
        assert [(r["doc_id"], r["start"]) for r in own if not r["removed"]] == [first]
        assert all(r["first_doc_id"] == first[0] for r in own)
        for k, a in enumerate(texts):  # each has a partner of its own
            assert any(len(a & b) >= 0.8 * len(a | b) - 1e-9 for j, b in enumerate(texts) if j != k)
    # Every thirty words from a sentence start that occur twice.
    found = {(r["doc_id"], r["start"]) for r in rows}
    places = defaultdict(list)
    for i, text in docs.items():
        for at in sentence_starts(text):
            words = said(text[at : at + 3000])[:30]
            if len(words) == 30:
                places[tuple(words)].append((i, at))
    wanted = {p for own in places.values() if len(own) > 1 for p in own}
    assert len(wanted) > 20 and wanted <= found


def test_passages_at_random_places_of_other_texts_are_found(spark):
    """Passages of 50 to 80 words, cut anywhere, put anywhere into two other texts; clean texts are left alone."""
    rng = random.Random(8)
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"].split(" ") for r in rows if r["text"] and r["text"].count(" ") > 150}
    seen, unique = set(), []
    for i, words in texts.items():  # texts that share nothing as they are given
        own = {tuple(words[k : k + 12]) for k in range(len(words) - 12)}
        if not own & seen and len(own) == len(words) - 12:
            unique.append(i)
        seen |= own
    rng.shuffle(unique)
    planted, out = [], {}
    givers, hosts, clean = unique[:150], unique[150:350], unique[350:]
    for k in range(0, 200, 2):
        words = texts[givers[k // 2]]
        length = rng.randint(50, 80)
        at = rng.randrange(len(words) - length)
        for host in hosts[k : k + 2]:
            put = rng.randrange(len(texts[host]))
            out[host] = texts[host][:put] + words[at : at + length] + texts[host][put:]
        planted.append(hosts[k : k + 2])
    out |= {i: texts[i] for i in clean}
    assert len(planted) == 100 and len(clean) > 50
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in out.items()], "doc_id long, text string")
    found = {r["doc_id"] for r in pd_.repeated_paragraphs(df).collect()}
    assert sum(set(pair) <= found for pair in planted) >= 90
    assert len(found & set(clean)) <= 0.05 * len(clean)


def test_a_passage_without_sentence_ends_is_found(spark):
    rng, rows = random.Random(2), []
    word = lambda: rng.choice("abcdefgh") + str(rng.randrange(10**6))
    for k in range(60):
        passage = [word() for _ in range(70)]
        rows += [(2 * k + j, " ".join([word() for _ in range(60)] + passage + [word() for _ in range(60)])) for j in (0, 1)]
    found = {r["doc_id"] for r in pd_.repeated_paragraphs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert len(found) >= 108


def test_similar_paragraphs_meet_whatever_their_first_words(spark):
    """Fifty pairs that differ in one word of sixty: the bands find 95 % of pairs at 0.8, more of these."""
    rng, rows = random.Random(6), []
    for k in range(50):
        words = [rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(60)]
        rows += [(2 * k, " ".join(words)), (2 * k + 1, " ".join([*words[:30], "other", *words[31:]]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"] for r in pd_.repeated_paragraphs(docs, words=60).collect()}
    assert len(found) >= 90


def test_every_word_lies_in_a_paragraph():
    rng = random.Random(4)
    for said in (["same"] * 200, [f"w{rng.randrange(10**6)}" for _ in range(500)], ["a", "b", "c"] * 70):
        hashes = pd_.rolled(pd_.word_hashes(said), pd_.SHINGLE)
        starts = pd_.anchors(hashes, [0], len(said), pd_.WORDS).tolist()
        covered = {k for at in starts for k in range(at, at + pd_.WORDS)}
        # A part of a sentence may be left at the end.
        assert starts == sorted(set(starts)) and covered >= set(range(len(said) - pd_.SENTENCE)) and max(covered) < len(said)


@pytest.mark.parametrize("bucket", [2000, 4])
def test_near_paragraphs_in_one_class_whatever_the_blocks(spark, monkeypatch, bucket):
    monkeypatch.setattr(pd_, "BANDED", 1)
    rng, rows, base = random.Random(3), [], [f"word{k}" for k in range(120)]
    for k in range(40):
        said = list(base)
        said[rng.randrange(len(said))] = f"other{k}"
        rows.append((k, " ".join(said)))
    rows.append((99, " ".join(f"far{k}" for k in range(120))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pd_.repeated_paragraphs(docs, words=120, bucket=bucket).collect()
    assert len({r["class"] for r in got}) == 1 and {r["doc_id"] for r in got} == set(range(40))
    assert [r["doc_id"] for r in got if not r["removed"]] == [0]


def test_links_of_blocks_connect_what_the_bucket_connects():
    nodes, said = [b"a", b"b", b"c"], ["a b c d e f g h i j", "a b c d e f g h i k", "x y z"]
    sets = [pd_.shingles(s, 2) for s in said]
    assert pd_.join_block(nodes, sets, [2, 2, 2], 0.7) == [(b"a", b"b")]
    assert pd_.join_block(nodes, sets, [0, 0, 0], 0.7) == []
    assert len(pd_.join_block(nodes, sets, [0, 1, 1], 0.7)) == 1


def test_bands_reach_the_recall():
    bands, rows = pd_.bands_for(0.8, 0.99, 40)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.99 and bands * rows <= 40
    with pytest.raises(ValueError):
        pd_.bands_for(0.1, 0.999999, 2)


def test_edge_cases(spark):
    docs = edge_docs(spark, clashes=True)
    rows = pd_.repeated_paragraphs(docs).collect()
    assert {r["doc_id"] for r in rows if r["removed"]} >= {2, 14} and all(r["first_doc_id"] == 1 for r in rows if r["doc_id"] == 2)
    clean = pd_.dedup_paragraphs(docs)
    assert clean.dtypes == docs.dtypes
    texts = defaultdict(list)
    for r in clean.collect():
        texts[r["doc_id"]].append(r["text"])
    assert texts[1] == [prose(1, 120)] and texts[4] == [None]
    # What is repeated as a whole is gone but for the last full stop.
    assert texts[2] == ["", ""] or texts[2] == [".", "."]
    assert pd_.repeated_paragraphs(no_docs(spark)).collect() == [] == pd_.dedup_paragraphs(no_docs(spark)).collect()


def test_sketches_differ_in_no_more_bits_than_shingles():
    rng = random.Random(9)
    said = [rng.choice("abc") + str(rng.randrange(4)) for _ in range(400)]
    hashes = pd_.rolled(pd_.word_hashes(said), 2)
    begin = np.array(rng.sample(range(len(hashes) - 26), 150))
    cells = pd_.sketches(hashes, begin, 26)
    own = [set(hashes[b : b + 26].tolist()) for b in begin]
    for a, x in zip(own, cells.tolist()):
        for b, y in zip(own, cells.tolist()):
            assert (x ^ y).bit_count() <= len(a ^ b)
            assert len(a & b) < 0.8 * len(a | b) or len(a ^ b) <= pd_.most_apart(26, 0.8)


@pytest.mark.parametrize("bucket, batch", [(2000, 10_000), (3, 7), (3, 1)])
def test_candidates_are_all_with_a_near_partner_in_their_bucket(spark, bucket, batch):
    rng, rows = random.Random(10), []
    for k in range(300):
        low = rng.randrange(1 << 24)
        cells = rng.choice((0, 0b1111111, (1 << 39) | 1, rng.randrange(1 << 40)))
        sketch = (cells << 24) | low
        bands = [rng.randrange(60), 1000 + rng.randrange(200), 5000]
        rows += [(sketch - (1 << 64) if sketch >> 63 else sketch, bands)] * rng.choice((1, 2))
    found = spark.createDataFrame(rows, "sketch long, bands array<long>")
    members = defaultdict(set)
    for sketch, bands in rows:
        for b in bands:
            members[b].add(sketch)
    apart = lambda x, y: (((x ^ y) % (1 << 64)) >> 24).bit_count()
    wanted = {(b, x) for b, own in members.items() for x in own if any(x != y and apart(x, y) <= 5 for y in own)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = [tuple(r) for r in pd_.candidates(found, 5, bucket).collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(set(got)) and wanted <= set(got)
    assert set(got) <= {(b, x) for b, own in members.items() for x in own}
    # Only buckets larger than a task compares go on whole.
    assert {p for p in got if len(members[p[0]]) <= bucket} == {p for p in wanted if len(members[p[0]]) <= bucket}


def test_neighbours_in_one_text_are_no_candidates(spark):
    """Paragraphs of one text overlap and meet in buckets; before, all of these went on to have their texts compared."""
    rng = random.Random(11)
    texts = [(k, " ".join(rng.choice("abcdefgh") + str(rng.randrange(10**6)) for _ in range(600))) for k in range(40)]
    texts = [(k, re.sub(r"(\S+ ){6}", lambda m: m.group().strip() + ". ", t)) for k, t in texts]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    found = pd_.occurrences(docs, 30, 5, 6, 4).cache()
    met = found.selectExpr("node", "explode(bands) as value").groupBy("value").count().where("count > 1").count()
    few = pd_.candidates(found, pd_.most_apart(26, 0.8), pd_.BUCKET).select("sketch").distinct().count()
    assert met > 1000 and few < 0.1 * found.count()

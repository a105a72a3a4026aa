"""Documents with everything that may go wrong, and plain counterparts of what Spark computes."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
TINY = "/root/testdata/sf0.01"
WORDS = "the cat sat on a mat and then ran over many hills while old birds sang quiet songs near some deep river".split()
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"
# Names that operators use themselves.
CLASHES = {
    "key": "1", "size": "2", "copies": "3", "kept": "'no'", "fingerprint": "'f'", "spans": "'s'", "row": "0", "p": "'p'",
    "cuts": "array(1)", "hash": "9L", "target": "1.5D", "grp": "'g'", "licenses": "'none'", "`a.b`": "'dot'", "Copy": "7",
}


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    said = [rng.choice(WORDS) for _ in range(words)]
    return "".join(w + (".\n" if k % 17 == 16 else ". " if k % 6 == 5 else " ") for k, w in enumerate(said)).strip()


def edge_rows() -> list[tuple]:
    long_text = prose(5, 30_000)
    return [
        (1, prose(1, 120), "en", "a", 10),
        (2, prose(1, 120), "en", None, None),
        (2, prose(1, 120), "en", None, None),
        (None, prose(2, 60), None, "b", 3),
        (None, prose(3, 60), None, "b", 3),
        (None, None, None, None, None),
        (4, None, "en", "a", 0),
        (5, "", "en", "a", 0),
        (6, " \t\r\n\x0b\x0c ", None, "c", 0),
        (7, "one", None, "c", 3),
        (8, "12 34 5.6 !!", None, "", 3),
        (9, "üß \U0001f600 Жизнь  nbsp wide \ud83d".encode("utf-8", "ignore").decode(), None, "ü", 9),
        (10, long_text, "en", "a", len(long_text)),
        (11, "x" * 60_000, None, "a", 60_000),
        (12, "\n" * 500, None, "a", 500),
        (13, "a b c d e f g\n" * 300, "en", "a", 1),
        (14, prose(1, 119) + " different", "en", "z", 1),
    ]


def edge_docs(spark: SparkSession, clashes: bool = False) -> DataFrame:
    docs = spark.createDataFrame(edge_rows(), SCHEMA).repartition(3)
    return docs.selectExpr("*", *(f"{v} as {n}" for n, v in CLASHES.items())) if clashes else docs


def no_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


class Union:
    def __init__(self, nodes):
        self.parent = {n: n for n in nodes}

    def root(self, n):
        while self.parent[n] != n:
            self.parent[n] = self.parent[self.parent[n]]
            n = self.parent[n]
        return n

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)

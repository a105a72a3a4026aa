"""Toxicity by a classifier chain: categories in order, each a linear model that sees the earlier probabilities.

The models are logistic regressions over the presence of words. While the chain is trained, the probabilities an
earlier category hands on are out-of-fold: those of a model that has not seen the row. Otherwise later models would
trust them more than they deserve. Rows of the sample are weighted to the shares of all labelled rows, so that
probabilities keep their meaning.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import checkpointed, quoted, row_key, values

WORD = re.compile(r"[^\W\d_]+")
PER_CLASS = 6000  # labelled rows with and without any category at most
STEMS = (4, 5, 6)
WORDS = 2000  # features at most: the words and beginnings that tell most about some category
LEAST_SHARE = 0.002  # of the sample that holds a word, and
LEAST_DOCUMENTS = 5  # rows of it at least
LEAST_Z = 4.0  # deviations by which a word's share has to differ
FOLDS = 5
PENALTY = 5.0  # ridge over the summed loss: a word of a few copies of one text gets little weight
FEW = 0.5  # weight of recall against precision in the choice of a threshold


def parts(text: str | None) -> set[str]:
    """The distinct words of a text and the beginnings of longer ones: inflected forms share these."""
    words = set(WORD.findall(text.lower())) if text else set()
    return words.union(f"{w[:n]}*" for n in STEMS for w in words if len(w) > n)


def logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


@dataclass
class Rows:
    """Sparse 0/1 rows with some dense columns behind them."""

    row: np.ndarray
    word: np.ndarray
    count: int
    words: int
    dense: np.ndarray

    def times(self, beta: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.row, beta[self.word], self.count)
        return sparse + self.dense @ beta[self.words : -1] + beta[-1]

    def back(self, of: np.ndarray) -> np.ndarray:
        sparse = np.bincount(self.word, of[self.row], self.words)
        return np.concatenate([sparse, self.dense.T @ of, [of.sum()]])

    def only(self, keep: np.ndarray) -> Rows:
        new = np.cumsum(keep) - 1
        inside = keep[self.row]
        return Rows(new[self.row[inside]], self.word[inside], int(keep.sum()), self.words, self.dense[keep])

    def with_column(self, column: np.ndarray) -> Rows:
        return Rows(self.row, self.word, self.count, self.words, np.column_stack([self.dense, column]))


def regress(x: Rows, y: np.ndarray, weight: np.ndarray, rounds: int = 25) -> np.ndarray:
    """Weighted logistic regression with a ridge: Newton steps, each solved by conjugate gradients."""
    beta = np.zeros(x.words + x.dense.shape[1] + 1)
    share = weight / max(weight.sum(), 1e-12)
    ridge = np.full(len(beta), PENALTY / max(1, x.count))
    ridge[-1] = 1e-9
    loss = np.inf
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x.times(beta), -35, 35)))
        likely = y * np.log(p + 1e-12) + (1 - y) * np.log(1 - p + 1e-12)
        now = 0.5 * (ridge * beta * beta).sum() - (share * likely).sum()
        if loss - now < 1e-7 * abs(now):
            break
        loss = now
        curve = share * p * (1 - p) + 1e-12
        goal = -(x.back(share * (p - y)) + ridge * beta)
        step, rest = np.zeros_like(beta), goal.copy()
        way, size = rest.copy(), rest @ rest
        for _ in range(60):
            if size < 1e-16:
                break
            bent = x.back(curve * x.times(way)) + ridge * way
            far = size / max(way @ bent, 1e-30)
            step, rest = step + far * way, rest - far * bent
            way, size = rest + (rest @ rest / size) * way, rest @ rest
        beta = beta + step
    return beta


@dataclass
class Model:
    categories: list[str]
    vocabulary: dict[str, int]
    betas: list[np.ndarray]
    thresholds: list[float]
    words: int

    def probabilities(self, text: str | None) -> list[float]:
        own = [k for k in map(self.vocabulary.get, parts(text)) if k is not None]
        found: list[float] = []
        for beta in self.betas:
            margin = beta[own].sum() + beta[-1]
            for k, p in enumerate(found):
                margin += beta[self.words + k] * float(logit(np.array(p)))
            found.append(float(1 / (1 + np.exp(-np.clip(margin, -35, 35)))))
        return found

    def column(self, text: Column) -> Column:
        """A struct of a probability for each category."""
        shape = ",".join(f"p{k}:double" for k in range(len(self.categories)))

        @F.arrow_udf(f"struct<{shape}>")
        def run(texts: pa.Array) -> pa.Array:
            found = np.array([self.probabilities(t) for t in values(texts)]).reshape(-1, len(self.categories))
            return pa.StructArray.from_arrays([pa.array(c) for c in found.T], [f"p{k}" for k in range(found.shape[1])])

        return run.asNondeterministic()(text)


def fit(
    labelled: DataFrame,
    categories: list[str],
    per_class: int = PER_CLASS,
    words: int = WORDS,
    stands_for: str | None = None,
) -> Model:
    """Learn from ``doc_id``, ``text`` and a 0/1 column for each category, in the order of the chain.

    The sample is bounded: ``per_class`` rows with and without any category, those with the smallest hashes. Rows
    with a null text or label do not count. Category statistics of words and the design matrix are made by
    Spark; the driver gets the chosen words and, for each sampled row, its labels and the places of its words.
    Without labelled rows of both kinds every probability is 0 and nothing is flagged. Where the rows are a sample
    themselves, ``stands_for`` names the column that tells how many labelled rows each stands for.
    """
    marks = [quoted(c).cast("int").alias(f"y{k}") for k, c in enumerate(categories)]
    marks.append((quoted(stands_for).cast("double") if stands_for else F.lit(1.0)).alias("stands"))
    rows = labelled.select(row_key(quoted("doc_id"), quoted("text")).alias("key"), quoted("text").alias("text"), *marks)
    rows = rows.dropna().withColumn("h", F.xxhash64("key"))
    rows = rows.withColumn("any", F.greatest(*(f"y{k}" for k in range(len(categories))), F.lit(0)))
    every = {r["any"]: r["n"] for r in rows.groupBy("any").agg(F.sum("stands").alias("n")).collect()}
    place = F.row_number().over(Window.partitionBy("any").orderBy("h", "key"))
    sample = rows.withColumn("place", place).where(F.col("place") <= per_class).drop("place")
    # Copies would stand in several folds and make a model look better than it is.
    sample = checkpointed(sample.dropDuplicates(["text", "any"]))
    sums = [F.sum(f"y{k}").alias(f"y{k}") for k in range(len(categories))]
    total = sample.agg(F.count("*").alias("n"), *sums).first()
    kinds = sample.groupBy("any").agg(F.count("*").alias("n")).collect()
    if len(kinds) < 2:
        never = [np.array([0.0] * k + [-35.0]) for k in range(len(categories))]
        return Model(categories, {}, never, [1.1] * len(categories), 0)
    # The rows left of a class stand for all of it, those cut off and the copies alike.
    weight = {r["any"]: every[r["any"]] / r["n"] for r in kinds}

    labels = [f"y{k}" for k in range(len(categories))]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marked = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]]
            rows = np.column_stack([np.ones(batch.num_rows, np.int64), *marked])
            sums: dict[str, np.ndarray] = {}
            for text, row in zip(values(batch.column(0)), rows):
                for word in parts(text):
                    sums[word] = sums[word] + row if word in sums else row
            table = np.array(list(sums.values()), np.int64).reshape(-1, rows.shape[1])
            columns = [pa.array(list(sums), pa.string()), *(pa.array(c) for c in table.T)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", *labels])

    shape = "word string, n long, " + ", ".join(f"{y} long" for y in labels)
    counts = sample.select("text", *labels).mapInArrow(counted, shape).groupBy("word").agg(F.sum("n").alias("n"), *sums)
    counts = counts.where(F.col("n") >= max(LEAST_DOCUMENTS, LEAST_SHARE * total["n"]))
    scores = []
    for k in range(len(categories)):
        p = total[f"y{k}"] / total["n"]
        spread = F.sqrt(F.col("n") * float(max(p * (1 - p), 1e-9)))
        scores.append(F.abs(F.col(f"y{k}") - F.col("n") * float(p)) / spread)
    best = counts.withColumn("z", F.greatest(*scores, F.lit(0.0))).where(F.col("z") >= LEAST_Z)
    chosen = [r["word"] for r in best.orderBy(F.desc("z"), "word").limit(words).select("word").collect()]
    vocabulary = {w: k for k, w in enumerate(sorted(chosen))}

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [
                sorted(k for k in map(vocabulary.get, parts(t)) if k is not None)
                for t in values(batch.column(0))
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(own, pa.list_(pa.int32()))], [*names, "own"])

    names = ["h", "any", *labels]
    shape = "h long, any int, " + ", ".join(f"y{k} int" for k in range(len(categories))) + ", own array<int>"
    got = sample.select("text", *names).mapInArrow(places, shape).toPandas().sort_values("h").reset_index(drop=True)
    own = [np.asarray(o, np.int64) for o in got["own"]]
    x = Rows(
        np.repeat(np.arange(len(own)), [len(o) for o in own]),
        np.concatenate([*own, np.zeros(0, np.int64)]).astype(np.int64),
        len(own),
        len(vocabulary),
        np.zeros((len(own), 0)),
    )
    weights = got["any"].map(weight).to_numpy(float)
    fold = np.arange(len(own)) % FOLDS
    betas, thresholds = [], []
    for k in range(len(categories)):
        y = got[f"y{k}"].to_numpy(float)
        unseen = np.zeros(len(y))
        for f in range(FOLDS):
            rest = fold != f
            beta = regress(x.only(rest), y[rest], weights[rest])
            unseen[~rest] = 1 / (1 + np.exp(-np.clip(x.only(~rest).times(beta), -35, 35)))
        betas.append(regress(x, y, weights))
        thresholds.append(threshold(unseen, y, weights))
        x = x.with_column(logit(unseen))
    return Model(categories, vocabulary, betas, thresholds, len(vocabulary))


def threshold(p: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The out-of-fold probability with the best F measure, precision counting more; none without positives."""
    order = np.argsort(-p, kind="stable")
    hit, flagged = np.cumsum((weight * y)[order]), np.cumsum(weight[order])
    if not hit[-1]:
        return 1.1
    f = (1 + FEW**2) * hit / (flagged + FEW**2 * hit[-1])
    last = np.append(np.diff(p[order]) < 0, True)  # the end of each run of equal probabilities
    best = np.flatnonzero(last)[np.argmax(f[last])]
    below = p[order][best + 1] if best + 1 < len(p) else 0.0
    return float((p[order][best] + below) / 2)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``p_<category>`` and ``<category>`` (over its threshold) of every row.

    A null or wordless text has the probability of a text without any known word. Repeated rows are answered
    each; an empty table gives an empty result; other columns are not looked at.
    """
    found = docs.select(quoted("doc_id").alias("doc_id"), model.column(quoted("text")).alias("p"))
    out = [F.col("doc_id")]
    for k, category in enumerate(model.categories):
        out += [F.col(f"p.p{k}").alias(f"p_{category}"), (F.col(f"p.p{k}") >= model.thresholds[k]).alias(category)]
    return found.select(*out)


# Words by which labelled rows are told apart, where the labels name no kind of toxicity.
SEEDS = {
    "insult": ("idiot", "moron", "clown", "loser", "fool", "imbecile", "stupid"),
    "contempt": ("pathetic", "worthless", "disgusting", "trash", "scum", "garbage", "filth"),
}


def with_kinds(labelled: DataFrame, label: str = "toxic") -> DataFrame:
    """Adds a weak 0/1 label for each kind in SEEDS: labelled toxic, and holding one of its words."""
    for kind, seeds in SEEDS.items():
        said = F.lower(quoted("text")).rlike(rf"\b({'|'.join(seeds)})\b")
        labelled = labelled.withColumn(kind, F.when(said & (quoted(label) == 1), 1).otherwise(0))
    return labelled

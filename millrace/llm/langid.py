"""Language ID in two steps: the family first, then one-versus-one linear SVMs within it.

Texts become relative frequencies of hashed letter n-grams. Every decision, between two families or between two
languages of a family, is a linear SVM of its own, trained in its own task on a bounded sample of labelled rows
and calibrated by a logistic curve on samples it was not trained on. A text meets the SVMs between families first
and afterwards only those of the winning family.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.shared import free_name, quoted, values

UNKNOWN = "und"
PER_LANGUAGE = 800  # labelled rows a language gives at most; families share them out among their languages
SLOTS = 1 << 15
ORDERS = 3
STRETCH = 32.0
# ISO 639-1 codes by family. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "is", "af", "lb", "fy", "yi"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc", "la"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "celtic": ("ga", "gd", "cy", "br"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz", "ky", "tk", "tt"),
    "semitic": ("ar", "he", "mt", "am"),
    "indo-iranian": ("hi", "ur", "bn", "pa", "mr", "gu", "ne", "fa", "ku", "ps", "tg"),
    "dravidian": ("ta", "te", "kn", "ml"),
    "malayic": ("id", "ms", "jv", "su", "tl"),
}
LETTERS = re.compile(r"[^\W\d_]+")
_STEP = np.uint64(0x9E3779B97F4A7C15)


def slots(text: str | None) -> np.ndarray:
    """Hash slots of all letter n-grams of a text, word ends included; empty if it has no letter."""
    words = LETTERS.findall(text.lower()) if isinstance(text, str) else []
    joined = " ".join(words)
    if not words or not (joined.replace(" ", "").isalpha() or any(map(str.isalpha, joined))):
        return np.zeros(0, np.int64)
    codes = np.frombuffer(f" {joined} ".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    rolled, found = np.zeros(len(codes), np.uint64), []
    for order in range(ORDERS):
        rolled = (rolled[: len(codes) - order] + codes[order:] + np.uint64(order)) * _STEP
        found.append((rolled ^ (rolled >> np.uint64(31))) & np.uint64(SLOTS - 1))
        rolled = rolled[:-1]
    return np.concatenate(found).view(np.int64)


def features(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    places, counts = np.unique(own, return_counts=True)
    return places, counts * (STRETCH / len(own))


def svm(rows: list, signs: np.ndarray, cost: float = 10.0, rounds: int = 15) -> np.ndarray:
    """Linear SVM with squared hinge loss by dual coordinate descent; the last weight is the bias."""
    weights, duals = np.zeros(SLOTS + 1), np.zeros(len(rows))
    norms = np.array([v @ v + 1.0 for _, v in rows]) + 0.5 / cost
    order = np.random.default_rng(3)
    for _ in range(rounds):
        for k in order.permutation(len(rows)):
            places, values = rows[k]
            slope = signs[k] * (weights[places] @ values + weights[-1]) - 1 + duals[k] * 0.5 / cost
            new = max(duals[k] - slope / norms[k], 0.0)
            if new != duals[k]:
                weights[places] += (new - duals[k]) * signs[k] * values
                weights[-1] += (new - duals[k]) * signs[k]
                duals[k] = new
    return weights


def logistic(margins: np.ndarray, positive: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of the curve that turns margins into probabilities; smoothed targets, Newton steps."""
    n, p = len(positive), positive.sum()
    aims = np.where(positive, (p + 1) / (p + 2), 1 / (n - p + 2))
    x, beta = np.stack([margins, np.ones(n)], axis=1), np.array([1.0, 0.0])
    for _ in range(rounds):
        at = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        curve = (x * (at * (1 - at) + 1e-6)[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, x.T @ (aims - at) - 1e-3 * beta)
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return float(max(beta[0], 1e-3)), float(beta[1])


def pieces(text: str) -> list[str]:
    """A text and three short runs of its words, so that short texts are learnt as well."""
    words, found = text.split(), [text]
    rng = np.random.default_rng(len(text))
    for size in (3, 8, 20):
        if len(words) > size:
            start = int(rng.integers(0, len(words) - size))
            found.append(" ".join(words[start : start + size]))
    return found


def train_pair(frame: pd.DataFrame) -> pd.DataFrame:
    """One SVM; ``positive`` tells the sides apart. Every fifth row only calibrates."""
    frame = frame.sort_values(["positive", "text"], kind="stable")
    rows, signs, spare = [], [], []
    for k, (text, positive) in enumerate(zip(frame["text"], frame["positive"])):
        for piece in pieces(text):
            own = slots(piece)
            if len(own):
                rows.append(features(own))
                signs.append(1.0 if positive else -1.0)
                spare.append(k % 5 == 4)
    signs_, spare_ = np.array(signs), np.array(spare, bool)
    weights = svm([r for r, s in zip(rows, spare) if not s], signs_[~spare_])
    tested = [k for k in range(len(rows)) if spare_[k]] or list(range(len(rows)))
    margins = np.array([weights[rows[k][0]] @ rows[k][1] + weights[-1] for k in tested])
    slope, offset = logistic(margins, signs_[tested] > 0)
    found = frame[["node", "a", "b"]].iloc[:1].reset_index(drop=True)
    return found.assign(weights=[weights.astype(np.float32).tobytes()], slope=slope, offset=offset)


@dataclass
class Node:
    """The decision among some classes by one SVM a pair of them."""

    classes: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray
    offset: np.ndarray

    def decide(self, own: np.ndarray) -> tuple[str, float]:
        """The class with most votes, ties by the mean probability, and that probability."""
        if len(self.classes) == 1:
            return self.classes[0], 1.0
        margin = np.array([w[own].mean(dtype=np.float64) for w in self.weights]) * STRETCH + self.bias
        first = 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -30, 30)))
        votes, mean = np.zeros(len(self.classes)), np.zeros(len(self.classes))
        for (a, b), p in zip(self.pairs, first):
            votes[a if p >= 0.5 else b] += 1
            mean[a] += p
            mean[b] += 1 - p
        best = max(range(len(votes)), key=lambda k: (votes[k], mean[k]))
        return self.classes[best], float(mean[best] / (len(votes) - 1))


@dataclass
class Model:
    families: Node | None
    within: dict[str, Node]

    def __post_init__(self) -> None:
        # Slots of n-grams that some SVM has learnt of; without SVMs every n-gram counts as known.
        nodes = [n for n in (self.families, *self.within.values()) if n and n.weights.size]
        self.known = np.any([np.any(n.weights != 0, axis=0) for n in nodes], axis=0) if nodes else np.ones(SLOTS, bool)

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and score: the probabilities of both steps, times the share of the text's n-grams that are known."""
        own = slots(text)
        if not len(own) or self.families is None:
            return UNKNOWN, 0.0
        family, p = self.families.decide(own)
        language, q = self.within[family].decide(own)
        return language, p * q * float(self.known[own].mean())

    def column(self, text: Column) -> Column:
        """A struct of ``lang_pred`` and ``score``."""

        @F.arrow_udf("struct<lang_pred:string,score:double>")
        def run(texts: pa.Array) -> pa.Array:
            found = [self.predict(t) for t in values(texts)]
            columns = pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())
            return pa.StructArray.from_arrays(columns, ["lang_pred", "score"])

        # Not a function to be run twice: a filter on its answer would otherwise be pushed below it as a copy.
        run = run.asNondeterministic()
        return run(text)


def fit(
    labelled: DataFrame, per_language: int = PER_LANGUAGE, families: Mapping[str, tuple[str, ...]] = FAMILIES
) -> Model:
    """Learn from columns ``text`` and ``lang``; rows without either do not count.

    The sample is bounded: ``per_language`` rows a language, those with the smallest text hash. The driver sees
    one count a language and one SVM a pair of families or of languages of a family. Without labelled rows the
    model knows no language and answers "und"; with one it always answers that.
    """
    rows = labelled.select(quoted("lang").cast("string").alias("lang"), quoted("text").alias("text"))
    rows = rows.where("lang is not null and text rlike '\\\\p{L}'")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    family = {c: next((f for f, own in families.items() if c in own), f"={c}") for c in sorted(sizes)}
    members = {f: [c for c in family if family[c] == f] for f in sorted(set(family.values()))}
    within = {f: list(combinations(own, 2)) for f, own in members.items()}
    if not sizes:
        return Model(None, {})
    # Twice the wanted share by hash, then exactly the wanted rows; only those are sorted.
    share = F.create_map(*(x for c, n in sizes.items() for x in (F.lit(c), F.lit(min(1.0, 2.0 * per_language / n)))))
    hashed = rows.withColumn("h", F.xxhash64("text"))
    near = hashed.where(F.pmod("h", F.lit(1 << 20)) < share[F.col("lang")] * float(1 << 20) + 1)
    place = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    sample = near.withColumn("place", place).where(F.col("place") <= per_language)
    # Which language is on which side of which SVM: between families, then within each.
    jobs = [
        ("", f, g, c, side == f, len(members[side]))
        for f, g in combinations(members, 2)
        for side in (f, g)
        for c in members[side]
    ]
    jobs += [(f, a, b, c, c == a, 1) for f, own in within.items() for a, b in own for c in (a, b)]
    nodes = {"": list(members)} | members
    nodes = {n: Node(classes, [], *(np.zeros(0),) * 4) for n, classes in nodes.items()}
    if jobs:
        sides = "node string, a string, b string, lang string, positive boolean, among int"
        wanted = F.broadcast(labelled.sparkSession.createDataFrame(jobs, sides))
        # A family's share is dealt out evenly to its languages.
        joined = sample.join(wanted, "lang").where(F.col("place") <= F.ceil(F.lit(per_language) / F.col("among")))
        shape = "node string, a string, b string, weights binary, slope double, offset double"
        groups = joined.select("node", "a", "b", "positive", "text").groupBy("node", "a", "b")
        for r in groups.applyInPandas(train_pair, shape).collect():
            node = nodes[r["node"]]
            w = np.frombuffer(r["weights"], np.float32)
            node.pairs.append((node.classes.index(r["a"]), node.classes.index(r["b"])))
            node.weights = np.vstack([node.weights.reshape(-1, SLOTS), w[None, :-1]]).astype(np.float32)
            node.bias = np.append(node.bias, w[-1])
            node.slope, node.offset = np.append(node.slope, r["slope"]), np.append(node.offset, r["offset"])
    return Model(nodes[""], {f: nodes[f] for f in members})


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from training: a quarter by the CRC of its id; rows without id are not."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def least_score(labelled: DataFrame, model: Model, share: float, most: float) -> float:
    """A bound for ``keep_identified``: all but ``share`` of the rows that were told right reach it; ``most`` at most.

    For rows that the model has not seen; their ``lang`` is the truth. Without any the bound is ``most``.
    """
    rows = labelled.select(quoted("lang").cast("string").alias("lang"), model.column(quoted("text")).alias("p"))
    right = rows.where("lang = p.lang_pred").agg(F.percentile_approx("p.score", share, 100_000)).first()[0]
    return most if right is None else min(right, most)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of each row, from its text alone.

    Null texts and texts without a letter are "und" with score 0; repeated rows get equal answers; an empty
    table gives an empty result. Only ``doc_id`` and ``text`` are looked at.
    """
    found = docs.select(quoted("doc_id").alias("doc_id"), model.column(quoted("text")).alias("p"))
    return found.select("doc_id", "p.*")


def keep_identified(docs: DataFrame, model: Model, least_score: float) -> DataFrame:
    """The documents with a language of at least that score; all columns as given, a null ``lang`` filled in."""
    p = free_name(docs.columns, "p")
    kept = docs.withColumn(p, model.column(quoted("text")))
    kept = kept.where((F.col(f"{p}.lang_pred") != UNKNOWN) & (F.col(f"{p}.score") >= least_score))
    filled = {"lang": F.coalesce(quoted("lang"), F.col(f"{p}.lang_pred"))} if "lang" in docs.columns else {}
    return kept.select(*(filled.get(c, quoted(c)).alias(c) for c in docs.columns))

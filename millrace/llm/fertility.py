"""Quality rules: fixed base rules, and how well public tokenizers cope with a text.

Per text and vocabulary: characters a token, the share of tokens that are bytes of characters the vocabulary does
not know, and the entropy of the tokens. What is usual differs by script, language and length, so bands come from
the corpus: quartiles of each measure over all documents of a language (script, where it has none) and size class.
Where these are too few, they come from all sizes of the language, then from the script, then from all documents,
relative to what is usual at that size. A text is rejected if one of its measures lies far outside.
"""

from __future__ import annotations

import base64
import math
import os
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import checkpointed, free_name, quoted, row_key, values

TOKENIZERS = "/opt/tokenizers"
WINDOW = 5
LEAST_WORDS = 10
MOST_REPEATED = 20  # per cent of the words
WIDTH = 4.0  # quartile ranges beyond the quartiles
LEAST_DOCUMENTS = 200  # of a group, for its own band
LEAST_OF_SIZE = 20  # documents that show what is usual at a size
MEASURES = ("chars_per_token", "byte_share", "entropy")
LEAST_ROOM = {"chars_per_token": 0.05, "byte_share": 0.02, "entropy": 0.05}  # beyond the quartiles, at least
# For tables with fewer documents than a band needs: what no text of any language should leave.
PRIOR = {"chars_per_token": (0.5, 20.0), "byte_share": (0.0, 0.5), "entropy": (0.5, 24.0)}
FEW_BANDS = 100_000  # rows of the bands that are handed to all tasks: ten megabytes
FEW_BYTES = 8  # byte tokens that never count against a text: two signs of up to four bytes
SYMBOLS = "#*$%&|<>"
# First code points of blocks by script, for texts without a language.
SCRIPTS = (
    (0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"),
    (0x590, "hebrew"), (0x600, "arabic"), (0x900, "indic"), (0xE00, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"),
    (0xD7B0, "other"),
)

_LETTER = re.compile("[A-Za-z]")


@dataclass
class Vocabulary:
    """A public vocabulary by file name; loaded once in each Python worker, from the same path on every node."""

    folder: str
    file: str
    _loaded: dict = field(default_factory=dict)

    def __getstate__(self) -> dict:
        return {"folder": self.folder, "file": self.file, "_loaded": {}}

    def ready(self) -> dict:
        if not self._loaded:
            path = os.path.join(self.folder, self.file)
            if self.file.endswith(".tiktoken"):
                import tiktoken

                with open(path, "rb") as lines:
                    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
                # The public pattern in the form that never goes back inside a run.
                pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
                coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
                # A token that is not text by itself is part of a character the vocabulary has no token for.
                broken = np.zeros(max(ranks.values()) + 1, bool)
                for token, rank in ranks.items():
                    broken[rank] = token.decode("utf-8", "ignore").encode() != token
                self._loaded.update(encode=coder.encode_ordinary, broken=broken)
            else:
                import sentencepiece

                model = sentencepiece.SentencePieceProcessor(model_file=path)
                broken = np.array([model.is_byte(k) for k in range(model.get_piece_size())])
                # Line ends and tabs have no piece but are no foreign characters either.
                for known in (0x09, 0x0A, 0x0D):
                    broken[model.piece_to_id(f"<0x{known:02X}>")] = False
                self._loaded.update(encode=model.encode, broken=broken)
        return self._loaded

    def measure(self, text: str) -> tuple[float, float, float]:
        loaded = self.ready()
        ids = np.array(loaded["encode"](text), np.int32)
        if not len(ids):
            return 0.0, 0.0, 0.0
        foreign = np.count_nonzero(loaded["broken"][ids]) / len(ids)
        ids.sort()
        starts = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1], [True])))
        counts = starts[1:] - starts[:-1]
        entropy = math.log2(len(ids)) - float((counts * np.log2(counts)).sum()) / len(ids)
        return len(text) / len(ids), foreign, max(0.0, entropy)


PRODUCTION = (Vocabulary(TOKENIZERS, "byte_bpe_multi_50k.tiktoken"), Vocabulary(TOKENIZERS, "piece_bpe_32k.model"))


def repeated_words(words: list[bytes]) -> int:
    """Words in WINDOW-word windows found twice or more, first ones included."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    rolled = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + n]
    ordered = np.sort(rolled)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    # Equal windows have equal hashes; the windows themselves decide.
    maybe = np.flatnonzero(np.isin(rolled, twice)).tolist()
    windows = [tuple(words[k : k + WINDOW]) for k in maybe]
    counts = Counter(windows)
    covered = np.zeros(len(words), bool)
    for k, window in zip(maybe, windows):
        if counts[window] > 1:
            covered[k : k + WINDOW] = True
    return int(covered.sum())


def base_measures(text: str | None) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    if not isinstance(text, str):
        return 0, 0, 0, 0, 0
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    spaces = len(data) - sum(map(len, words))
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = sum(map(text.count, SYMBOLS))
    return len(words), len(text) - spaces, symbols, len(lines) - len(set(lines)), repeated_words(words)


def script_of(text: str) -> str:
    """The script most letters of the text are in."""
    if text.isascii():
        return "latin" if _LETTER.search(text) else "none"
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = codes[(codes > 0x40) & ~((codes > 0x5A) & (codes < 0x61)) & ~((codes > 0x7A) & (codes < 0xC0))]
    if not len(codes):
        return "none"
    if codes.max() < SCRIPTS[1][0]:
        return "latin"
    starts = np.array([s for s, _ in SCRIPTS])
    place = np.searchsorted(starts, codes, "right") - 1
    names = [n for _, n in SCRIPTS]
    totals: Counter = Counter()
    for k, n in enumerate(np.bincount(place, minlength=len(names)).tolist()):
        totals[names[k]] += n
    return max(totals, key=lambda n: (totals[n], n))


def measures(docs: DataFrame, vocabularies: tuple[Vocabulary, ...] = PRODUCTION) -> DataFrame:
    """``doc_id, key, grp, script, size``, the five base measures, and three measures for each vocabulary.

    ``grp`` is the language, or the script of a text without one; ``size`` the class of its length.
    """
    lang = quoted("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    key = row_key(quoted("doc_id"), quoted("text")).alias("key")
    rows = docs.select(quoted("doc_id").alias("doc_id"), key, lang.alias("lang"), quoted("text").alias("text"))
    named = [f"{m}_{k}" for k in range(len(vocabularies)) for m in MEASURES]
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    shape = ", ".join(
        [f"doc_id {dict(rows.dtypes)['doc_id']}, key binary, grp string, script string, size int"]
        + [f"{n} long" for n in base]
        + [f"{n} double" for n in named]
    )

    def run(batches):
        for batch in batches:
            group, script, fixed, own = [], [], [], []
            for lang, text in zip(values(batch.column(2)), values(batch.column(3))):
                script.append(script_of(text or ""))
                group.append(lang or f"script:{script[-1]}")
                fixed.append(base_measures(text))
                own.append([m for v in vocabularies for m in v.measure(text or "")])
            size = pa.array([f[0].bit_length() for f in fixed], pa.int32())
            fixed = [list(c) for c in zip(*fixed)] or [[]] * len(base)
            own = [list(c) for c in zip(*own)] or [[]] * len(named)
            columns = [batch.column(0), batch.column(1), pa.array(group, pa.string()), pa.array(script, pa.string())]
            columns.append(size)
            columns += [pa.array(c, pa.int64()) for c in fixed] + [pa.array(c, pa.float64()) for c in own]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "grp", "script", "size", *base, *named])

    return rows.mapInArrow(run, shape)


def quartiles(measured: DataFrame, keys: list[str], names: list[str], tag: str) -> DataFrame:
    """The keys, ``n_<tag>``, and quartiles ``<tag>_<name>`` of each measure over the documents of equal keys."""
    found = [F.percentile_approx(n, [0.25, 0.5, 0.75], 1000).alias(f"{tag}_{n}") for n in names]
    return measured.groupBy(*keys).agg(F.count("*").alias(f"n_{tag}"), *found)


def by_size(measured: DataFrame, names: list[str], tag: str) -> DataFrame:
    """``size`` and quartiles ``<tag>_<name>`` of all documents of that size, or of the nearest with enough of them."""
    known = quartiles(measured, ["size"], names, tag).where(F.col(f"n_{tag}") >= LEAST_OF_SIZE)
    known = known.select(F.col("size").alias("near"), *(f"{tag}_{n}" for n in names))
    far = F.struct(F.abs(F.col("size") - F.col("near")), "near")
    nearest = F.min_by(F.struct(*(f"{tag}_{n}" for n in names)), far).alias("u")
    sizes = measured.select("size").distinct()
    return sizes.crossJoin(F.broadcast(known)).groupBy("size").agg(nearest).select("size", "u.*")


def bands(measured: DataFrame, names: list[str], width: float, least_documents: int) -> DataFrame:
    """``grp, script, size`` and bounds ``lo_*``, ``hi_*`` from the quartiles of all documents of a group.

    A group of too few documents takes those of its language at all sizes, its script, or all documents, whichever
    is the first with enough, or else PRIOR; there, measures count from the median of all documents of their size, and the range is
    that of the size inside languages if it is wider. A measure that hardly varies in a group gets some room: a
    hundredth of its median and LEAST_ROOM at least.
    """
    usual = by_size(measured, names, "s")
    # Without any size of enough documents, measures count from zero.
    mid = {n: F.coalesce(F.col(f"s_{n}")[1], F.lit(0.0)) for n in names}
    off = measured.join(usual, "size", "left")
    off = off.select("grp", "script", "size", *((F.col(n) - mid[n]).alias(n) for n in names))
    own = quartiles(off, ["grp"], names, "g1")
    inside = off.join(own, "grp").select("size", *((F.col(n) - F.col(f"g1_{n}")[1]).alias(n) for n in names))
    found = measured.select("grp", "script", "size").distinct().join(usual, "size", "left")
    found = found.join(by_size(inside, names, "d"), "size", "left").join(own, "grp")
    found = found.join(quartiles(measured, ["grp", "size"], names, "g0"), ["grp", "size"])
    found = found.join(quartiles(off, ["script"], names, "g2"), "script").crossJoin(quartiles(off, [], names, "g3"))
    out = [F.col("grp"), F.col("script"), F.col("size")]
    for n in names:
        sized = F.coalesce(F.col(f"d_{n}")[2] - F.col(f"d_{n}")[0], F.lit(0.0))
        low, middle, high, spread = [], [], [], []
        for tag in ("g0", "g1", "g2", "g3"):
            enough, q = F.col(f"n_{tag}") >= least_documents, F.col(f"{tag}_{n}")
            for k, side in enumerate((low, middle, high)):
                side.append(F.when(enough, q[k] if tag == "g0" else mid[n] + q[k]))
            spread.append(F.when(enough, q[2] - q[0] if tag == "g0" else F.greatest(q[2] - q[0], sized)))
        low, middle, high, spread = (F.coalesce(*side) for side in (low, middle, high, spread))
        least = LEAST_ROOM[n.rpartition("_")[0]]
        room = F.greatest(width * F.greatest(spread, F.abs(middle) / 100), F.lit(least))
        lowest, highest = PRIOR[n.rpartition("_")[0]]
        out.append(F.coalesce(low - room, F.lit(lowest)).alias(f"lo_{n}"))
        out.append(F.coalesce(high + room, F.lit(highest)).alias(f"hi_{n}"))
    return found.select(*out)


def judge(
    docs: DataFrame,
    vocabularies: tuple[Vocabulary, ...] = PRODUCTION,
    width: float = WIDTH,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """One row per document: the measures, ``base_failed`` and ``kept``.

    The base rules reject texts of fewer than LEAST_WORDS words, or with more than MOST_REPEATED per cent of
    them in repeated windows. ``kept`` is false for these, and for texts with a measure outside its band (of
    the bytes of unknown characters, FEW_BYTES are always allowed). Groups of
    fewer than ``least_documents`` documents fall back to larger ones, in the end to the fixed bands of PRIOR. Null and empty texts have no words
    and fail. A null language is replaced by the text's script. Repeated rows are answered each, an empty table
    gives an empty result, columns other than doc_id, text and lang are not looked at.
    """
    measured = checkpointed(measures(docs, vocabularies))
    names = [f"{m}_{k}" for k in range(len(vocabularies)) for m in MEASURES]
    known = checkpointed(bands(measured, names, width, least_documents))
    # A language may hold most documents: where the bands are few, no document is moved to meet its own.
    if known.limit(FEW_BANDS + 1).count() <= FEW_BANDS:
        known = F.broadcast(known)
    judged = measured.join(known, ["grp", "script", "size"], "left")
    inside = F.lit(True)
    for n in names:
        fits = F.coalesce(F.col(n).between(F.col(f"lo_{n}"), F.col(f"hi_{n}")), F.lit(True))
        if n.startswith("byte_share"):
            # In a short text a single sign is a large share.
            said, rate = F.col("word_chars") + F.col("n_words"), F.col(n.replace("byte_share", "chars_per_token"))
            tokens = F.try_divide(said, rate)
            few = F.col(n) * tokens <= FEW_BYTES
            fits |= F.coalesce(few, F.lit(False))
        inside &= fits
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    judged = judged.withColumn("base_failed", failed).withColumn("kept", ~failed & inside)
    return judged.drop("script", *(f"{side}_{n}" for n in names for side in ("lo", "hi")))


def keep_good(docs: DataFrame, **settings) -> DataFrame:
    """The documents that are kept; all rows of a document and all columns as given."""
    key = free_name(docs.columns, "key")
    good = judge(docs, **settings).where("kept").select(F.col("key").alias(key)).distinct()
    marked = docs.withColumn(key, row_key(quoted("doc_id"), quoted("text")))
    return marked.join(good, key, "left_semi").select(*(quoted(c) for c in docs.columns))

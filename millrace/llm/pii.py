"""Personal data in texts: base patterns, and candidates that boosted trees accept beside them.

Everything is a column expression: patterns, positions, features, the trees (written out as CASE expressions) and
the choice among overlapping spans. Nothing is shuffled but counts of what training looks at.

Base spans are exact rules. Looser generators propose further, overlapping spans; gradient-boosted trees judge
these by format and context. They learn what the base rules miss: base spans of the corpus are written in other ways
(``VARIANTS``: at-signs spelt out, no plus, other separators, long addresses) in their own surroundings, and what the
generators propose there is personal. Not personal are candidates on numbers of technical forms planted in the same
surroundings (``TECHNICAL``), candidates of another kind, and candidates of the corpus off the base spans with
technical signs beside them. Other candidates off the base spans may be either and teach nothing. A threshold a kind is
set on candidates kept from training, for a wanted precision; a kind that cannot reach it adds nothing.

All base spans and all candidates count. Candidates of equal features and label are one row with a weight, so the trees
see few rows however large the corpus is.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import checkpointed, free_name, quoted, stored

# Kinds in order, and their base patterns. Possessive quantifiers and the look at the character
# before only save time: a run of characters is tried from its start, as any later start would go on alike.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
GENERATORS = (
    (
        "email",
        r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++"
        r"(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[A-Za-z0-9-]++)++",
    ),
    (
        "ip",
        r"(?<![0-9A-Za-z:.])(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|(?:[0-9A-Fa-f]{1,4}:){3,7}[0-9A-Fa-f]{1,4})"
        r"(?![0-9A-Za-z])",
    ),
    ("card", r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}[0-9]){11,18}(?![0-9])"),
    ("phone", r"(?<![0-9])(?:\+|00)?\(?[0-9]{1,4}\)?(?:[\x20./-]{0,2}\(?[0-9]{2,4}\)?){2,5}(?![0-9])"),
    # The same number without its country: lies within the one before where there is one.
    ("phone", r"(?<![0-9])\(?[0-9]{2,4}\)?[\x20./-][0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9])"),
)
# Texts without one of these hold no base match and no candidate.
SIGNS = r"[0-9@]|\(at\)|\[at\]"
PERSONAL_WORDS = "tel|phone|fon|call|mobil|fax|mail|contact|reach|card|visa|pay|addr|host|server"
TECHNICAL_SIGNS = 'version|token|key|isbn|hash|=|"|#|/'
# Ways to write a base match that the base rules miss; x is the span.
_LOCAL = "regexp_replace(x.said, '^[+][0-9]+[ .-]*', '')"
_GROUPS = "regexp_replace(x.said, '[^0-9]', '')"
_PARTS = "transform(split(x.said, '[.]'), p -> int(right(p, 3)) + 4096)"
_SHORT = "regexp_replace(x.said, '@[^.]+[.](?=[^.]+[.])', '@')"
VARIANTS = (
    ("email", "replace(x.said, '@', ' (at) ')"),
    ("email", f"replace({_SHORT}, '@', ' @ ')"),
    ("email", f"regexp_replace(replace({_SHORT}, '@', ' [at] '), '[.][a-z]+$', ' [dot] fr')"),
    ("email", f"regexp_replace(replace(regexp_replace({_SHORT}, '^[0-9.]+|[0-9.]+(?=@)', ''), '@', '(at)'), '[.][a-z]+$', '.net')"),
    ("email", "replace(x.said, '@', ' @ ')"),
    ("email", "regexp_replace(replace(x.said, '@', '[at]'), '[.](?=[A-Za-z0-9-]+$)', '[dot]')"),
    ("email", "regexp_replace(replace(x.said, '@', '(at)'), '[.](?=[A-Za-z0-9-]+$)', ' (dot) ')"),
    ("ip", f"lower(concat_ws(':', '2001', 'db8', hex({_PARTS}[0]), hex({_PARTS}[1]), hex({_PARTS}[2]), hex({_PARTS}[3])))"),
    ("ip", f"lower(concat_ws(':', 'fe80', '0', '0', hex({_PARTS}[3]), hex({_PARTS}[2]), '0', hex({_PARTS}[1]), hex({_PARTS}[0])))"),
    ("card", f"regexp_replace({_GROUPS}, '([0-9]{{4}})(?=[0-9])', '$1.')"),
    ("card", f"regexp_replace({_GROUPS}, '([0-9]{{4}})(?=[0-9])', '$1/')"),
    ("card", f"regexp_replace({_GROUPS}, '([0-9]{{4}})(?=[0-9])', '$1_')"),
    ("card", f"regexp_replace({_GROUPS}, '([0-9]{{4}})(?=[0-9])', '$1  ')"),
    ("phone", "ltrim('+', x.said)"),
    ("phone", "replace(x.said, '+', '00')"),
    ("phone", _LOCAL),
    ("phone", f"regexp_replace(regexp_replace({_LOCAL}, '[()]', ''), '[^0-9]+', '.')"),
    ("phone", f"regexp_replace(regexp_replace({_LOCAL}, '[()]', ''), '[^0-9]+', '-')"),
)
# Numbers that are no personal data; d are twenty digits by hash.
TECHNICAL = (
    "concat('20', substr(d, 1, 2), '-0', substr(d, 3, 1), '-1', substr(d, 4, 1), ' 1', substr(d, 5, 1), ':2', substr(d, 6, 1))",
    "concat('1', substr(d, 1, 1), '.0', substr(d, 2, 1), '.20', substr(d, 3, 2), ' 1', substr(d, 5, 1), ':3', substr(d, 6, 1))",
    "concat(substr(d, 1, 3), '.', substr(d, 4, 3), '.', substr(d, 7, 3), '.', substr(d, 10, 3))",
    "concat('0.', substr(d, 1, 16))",
    "concat('token = \"', substr(d, 1, 16), '\"')",
    "concat('id=', substr(d, 1, 4), '-', substr(d, 5, 4), '-', substr(d, 9, 4), '-', substr(d, 13, 4))",
    "concat('#', substr(d, 1, 3), '-', substr(d, 4, 3), '-', substr(d, 7, 4))",
    "concat('ISBN 978-', substr(d, 1, 1), '-', substr(d, 2, 4), '-', substr(d, 6, 4), '-', substr(d, 10, 1))",
    "concat('version ', substr(d, 1, 1), '.', substr(d, 2, 2), '.', substr(d, 4, 3), '.', substr(d, 7, 3))",
    "concat('1', substr(d, 1, 1), ':2', substr(d, 2, 1), ':3', substr(d, 3, 1), ':4', substr(d, 4, 1))",
    "concat_ws(':', substr(md5(d), 1, 2), substr(md5(d), 3, 2), substr(md5(d), 5, 2), substr(md5(d), 7, 2), substr(md5(d), 9, 2))",
    "concat(substr(d, 1, 2), ' @ ', substr(d, 3, 1), '.', substr(d, 4, 2))",
)
PER_CLASS = 4000  # what the candidates of a kind and class weigh together at most; a third of them sets the thresholds
FIT_TASKS = 8  # rows of distinct features are few, and every level of every tree is a job over its partitions
PRECISION = 0.97
LEAST_SUPPORT = 30  # calibration candidates above a threshold


_SPAN = "array<struct<kind:int,start:int,end:int,said:string,before:string,after:string>>"
_SHOWN = "x.kind as kind, x.said as said, x.before as before, x.after as after"


BLOCK = 64


def _blocks(spans: str) -> str:
    """The numbers of the blocks of an array."""
    return f"if(size({spans}) = 0, cast(array() as array<int>), sequence(0, int((size({spans}) - 1) div {BLOCK})))"


def _block(spans: str, number: str) -> str:
    return f"slice({spans}, {number} * {BLOCK} + 1, {BLOCK})"


def beside(spans: str, others: str, kept: str) -> str:
    """``kept``, an array over ``own`` (a block of ``spans``) and ``near`` (the ``others`` that overlap it), joined up.

    ``spans`` is in order of start, so a block covers a short stretch and each of its spans is compared with few.
    """
    reach = f"struct({_block(spans, 'b')} as own, aggregate({_block(spans, 'b')}, 0, (n, x) -> greatest(n, x.end)) as stop)"
    near = f"filter({others}, y -> y.start < w.stop and y.end > w.own[0].start)"
    return f"""flatten(transform(transform({_blocks(spans)}, b -> {reach}),
        w -> transform(array(struct(w.own as own, {near} as near)), v -> {kept})[0]))"""


def located(df: DataFrame, text: str, patterns: Sequence[tuple[str, str]]) -> DataFrame:
    """Adds ``at_0``, ``at_1``, … for (kind, pattern): all leftmost matches and what stands around them.

    The text is split at the matches; lengths of the pieces and matches before it add up to a span's place, in code
    points.
    """
    looked = F.when(F.col(text).rlike(SIGNS), F.col(text)).otherwise("")
    split = {}
    for k, (_, pattern) in enumerate(patterns):
        split[f"hits_{k}"] = F.regexp_extract_all("looked", F.lit(pattern), F.lit(0))
        split[f"pieces_{k}"] = F.split("looked", pattern, -1)
    met, spans = {}, {}
    for k, (kind, _) in enumerate(patterns):
        around = f"transform(hits_{k}, (m, i) -> struct(m as m, pieces_{k}[i] as p, pieces_{k}[i + 1] as q))"
        met[f"met_{k}"] = F.expr(around)
        own = _block(f"met_{k}", "b")
        # Where each block starts, then the spans of each block: appending to one long array copies it every time.
        starts = f"""
            aggregate({_blocks(f"met_{k}")}, struct(0 as at, cast(array() as array<struct<b:int,at:int>>) as starts),
              (s, b) -> struct(
                s.at + aggregate({own}, 0, (n, x) -> n + length(x.p) + length(x.m)) as at,
                concat(s.starts, array(struct(b as b, s.at as at))) as starts),
              s -> s.starts)"""
        spans[f"at_{k}"] = F.expr(f"""
            flatten(transform({starts}, w -> aggregate(
              {_block(f"met_{k}", "w.b")},
              struct(w.at as at, cast(array() as {_SPAN}) as found),
              (s, x) -> struct(
                s.at + length(x.p) + length(x.m) as at,
                concat(s.found, array(struct({KINDS.index(kind)} as kind, s.at + length(x.p) as start,
                  s.at + length(x.p) + length(x.m) as end, x.m as said, right(x.p, 24) as before,
                  left(x.q, 1) as after))) as found),
              s -> s.found)))""")
    # Few wide steps: every step is analysed anew.
    df = df.withColumn("looked", looked).withColumns(split).withColumns(met).withColumns(spans)
    return df.drop("looked", *(f"{part}_{k}" for k in range(len(patterns)) for part in ("hits", "pieces", "met")))


# What a base match has to pass; x is the span.
_CHECKS = {
    "email": "true",
    "ip": "forall(split(x.said, '[.]'), p -> lpad(ltrim('0', p), 3, '0') <= '255' and length(ltrim('0', p)) <= 3)",
    "card": """case when length(regexp_replace(x.said, '[ -]', '')) between 12 and 19 then
        aggregate(
          transform(split(reverse(regexp_replace(x.said, '[ -]', '')), ''), d -> int(d)), struct(0 as n, 0 as t),
          (s, d) -> struct(s.n + 1 as n, s.t + if(s.n % 2 = 0, d, 2 * d - if(d > 4, 9, 0)) as t), s -> s.t) % 10 = 0
        else false end""",
    "phone": "length(regexp_replace(x.said, '[^0-9]', '')) between 9 and 15",
}


def base_spans(df: DataFrame, text: str, shown: str | None = None) -> DataFrame:
    """Adds ``base``: spans of the base rules in order of start, then kind; matches that fail a check are dropped.

    ``shown`` names a column for the same spans with what they say and what stands before and after, by kind.
    """
    found = located(df, text, list(BASE.items()))
    kept = [f"filter(at_{k}, x -> {_CHECKS[kind]})" for k, kind in enumerate(BASE)]
    plain = f"transform(concat({', '.join(kept)}), x -> struct(x.start as start, x.kind as kind, x.end as end))"
    ordered = f"transform(array_sort({plain}), x -> struct(x.kind as kind, x.start as start, x.end as end))"
    if shown:
        found = found.withColumn(shown, F.expr(f"transform(concat({', '.join(kept)}), x -> struct({_SHOWN}))"))
    return found.withColumn("base", F.expr(ordered)).drop(*(f"at_{k}" for k in range(len(BASE))))


def candidate_spans(df: DataFrame, text: str) -> DataFrame:
    """Adds ``candidates``: overlapping spans of all generators with their features ``f``."""
    digits, letters = "length(regexp_replace(x.said, '[^0-9]', ''))", "length(regexp_replace(x.said, '[^A-Za-z]', ''))"
    features = [
        "length(x.said)",
        digits,
        letters,
        f"length(x.said) - {digits} - {letters}",
        "size(split(x.said, '[^0-9A-Za-z]+'))",
        "length(regexp_extract(x.said, '[0-9A-Za-z]+', 0))",
        "length(regexp_extract(x.said, '[0-9A-Za-z]+$', 0))",
        "int(contains(x.said, '('))",
        "int(contains(x.said, '@'))",
        "length(regexp_replace(x.said, '[^.]', ''))",
        "int(x.before rlike '[0-9A-Za-z]$')",
        "int(x.after rlike '[0-9A-Za-z]')",
        f"int(lower(x.before) rlike '{PERSONAL_WORDS}')",
        f"int(lower(x.before) rlike '{TECHNICAL_SIGNS}')",
        "x.kind",
    ]
    numbers = f"array({', '.join(f'double({f})' for f in features)})"
    found = located(df, text, GENERATORS)
    names = [f"at_{k}" for k in range(len(GENERATORS))]
    every = f"concat({', '.join(names)})"
    judged = f"transform({every}, x -> struct(x.kind as kind, x.start as start, x.end as end, {numbers} as f))"
    return found.withColumn("candidates", F.expr(judged)).drop(*names)


@dataclass
class Model:
    """``score`` is SQL over the features ``x.f``; a kind without threshold adds no span."""

    score: str
    thresholds: dict[int, float]


def tree_sql(lines: list[str]) -> str:
    """A decision tree's printed form as nested CASE expressions."""
    line = lines.pop(0).strip()
    if line.startswith("Predict"):
        return f"double({float(line.split(':')[1])!r})"
    feature, limit = re.match(r"If \(feature (\d+) <= (\S+)\)", line).groups()
    yes = tree_sql(lines)
    lines.pop(0)
    return f"case when x.f[{feature}] <= double({float(limit)!r}) then {yes} else {tree_sql(lines)} end"


def prepare(docs: DataFrame) -> DataFrame:
    """``doc_id, h, base, candidates, shown`` of every row, stored: texts are searched once, for training and result.

    ``shown`` are the base spans as they stand in the text, which training writes in other ways.
    """
    spans = candidate_spans(base_spans(_texts(docs), "text", "shown"), "text")
    return stored(spans.selectExpr("doc_id", "xxhash64(doc_id, text) as h", "base", "candidates", "shown"), "candidates")


def fit(docs: DataFrame, per_class: int = PER_CLASS, precision: float = PRECISION) -> Model:
    """Trees and thresholds from the candidates of all ``docs``."""
    return fit_prepared(prepare(docs), per_class, precision)


def _tallied(rows: DataFrame) -> DataFrame:
    """``own, kind, label, f, held, n``: how many rows are alike; one in three, by hash, is held back from training."""
    alike = rows.selectExpr("own", "kind", "label", "f", "pmod(h, 3) = 0 as held")
    return checkpointed(alike.groupBy(*alike.columns).agg(F.count("*").alias("n")))


def _weighed(tallies: DataFrame, counts: dict[int, int], wanted: int) -> DataFrame:
    """Adds ``w``, what one row weighs: all that come from one of ``counts`` weigh as ``wanted`` of them at most."""
    each = " ".join(f"when {k} then double({min(1.0, wanted / n)!r})" for k, n in sorted(counts.items()))
    return tallies.selectExpr("*", f"case own {each} end as w" if counts else "double(0) as w")


def _planted(shown: DataFrame) -> DataFrame:
    """``own, kind, label, f, h`` of what the generators propose on other spellings and technical numbers.

    ``own`` is the kind of the base span in whose place it was written.
    """
    told = [f"if(x.kind = {KINDS.index(k)}, struct({KINDS.index(k)} as kind, {v} as said), null)" for k, v in VARIANTS]
    told += [f"struct(-1 as kind, {v} as said)" for v in TECHNICAL]
    digits = "concat(lpad(pmod(h, 10000000000), 10, '0'), lpad(pmod(xxhash64(h), 10000000000), 10, '0')) as d"
    # Each step is a plan of its own: together they are too wide to be planned.
    shown = checkpointed(shown.selectExpr("h", "x", digits))
    written = shown.selectExpr("h", "x", f"explode(array_compact(array({', '.join(told)}))) as v")
    texts = written.selectExpr(
        "h", "x.kind as own", "v.kind as meant", "length(x.before) as start",
        "length(x.before) + length(v.said) as end", "concat(x.before, v.said, x.after) as text",
    )
    found = candidate_spans(stored(texts, "planted"), "text").drop("text")
    # What is asked of exploded candidates must not be pushed into the search for them.
    found = stored(found, "proposed").selectExpr("h", "own", "meant", "start", "end", "explode(candidates) as x")
    found = found.where("x.start < end and start < x.end")
    label = "double(x.kind = meant and 2 * (least(end, x.end) - greatest(start, x.start)) >= x.end - x.start)"
    return found.selectExpr("own", "x.kind", f"{label} as label", "x.f", "h")


def _technical(spans: DataFrame) -> DataFrame:
    """``own, kind, label, f, h`` of the corpus' candidates off the base spans that have technical signs beside them."""
    free = "filter(v.own, x -> not exists(v.near, b -> b.start < x.end and x.start < b.end))"
    signs = "x.f[10] + x.f[11] + x.f[13] > 0"
    ordered = "array_sort(candidates, (x, y) -> int(sign(x.start - y.start)))"
    off = spans.selectExpr("h", "base", f"{ordered} as candidates")
    off = off.selectExpr("h", f"explode({beside('candidates', 'base', free)}) as x").where(signs)
    return off.selectExpr("x.kind as own", "x.kind", "double(0) as label", "x.f", "xxhash64(h, x.start, x.end) as h")


def fit_prepared(spans: DataFrame, per_class: int = PER_CLASS, precision: float = PRECISION) -> Model:
    """Trees and thresholds from what ``prepare`` has stored.

    Every base span is written in all its ways and with all technical numbers, and every candidate with technical signs
    beside it counts. So that no kind outweighs the others, the spellings of a kind weigh as ``per_class`` of them at
    most, as do its technical numbers and its candidates of the corpus: the precision is that among these. Without base
    spans, or with an empty table, the model adds nothing.
    """
    shown = spans.selectExpr("h", "posexplode(shown) as (n, x)").selectExpr("xxhash64(h, n) as h", "x.kind", "x")
    ways = max(sum(k == kind for k, _ in VARIANTS) for kind in KINDS)
    many = {r["kind"]: r["count"] for r in shown.groupBy("kind").count().collect()}
    planted = _weighed(_tallied(_planted(shown)), many, per_class // ways)
    corpus = _tallied(_technical(spans))
    many = {r["own"]: r["n"] for r in corpus.groupBy("own").agg(F.sum("n").alias("n")).collect()}
    # In a fixed order, so that sums of weights come out alike.
    tallies = planted.unionAll(_weighed(corpus, many, per_class)).repartition(FIT_TASKS, "f")
    tallies = checkpointed(tallies.sortWithinPartitions("f", "kind", "label", "held", "own", "n"))
    learnt = tallies.where("not held")
    if {r["label"] for r in learnt.groupBy("label").count().collect()} != {0.0, 1.0}:
        return Model("double(0)", {})
    weight = {(kind, label): 1.0 for kind in range(len(KINDS)) for label in (0.0, 1.0)}
    ready = learnt.withColumns({"features": array_to_vector("f"), "weight": F.expr("n * w")})
    trees = GBTClassifier(maxIter=20, maxDepth=4, stepSize=0.3, seed=11, maxBins=64, weightCol="weight")
    fitted = trees.fit(ready)
    parts = [
        f"{float(w)!r} * ({tree_sql([x for x in t.toDebugString.splitlines()[1:] if x.strip()])})"
        for t, w in zip(fitted.trees, fitted.treeWeights)
    ]
    score = f"1 / (1 + exp(-2 * ({' + '.join(parts)})))"
    tested = tallies.where("held").selectExpr("kind", "label", "n", "w", "struct(f as f) as x")
    bins = tested.selectExpr("kind", "label", "n", "w", f"floor(({score}) * 50) as bin")
    bins = bins.groupBy("kind", "bin", "label", "w").agg(F.sum("n").alias("n"))
    weighed = [{**r.asDict(), "count": r["n"] * r["w"]} for r in sorted(bins.collect())]
    return Model(score, _thresholds(weighed, weight, precision))


def _thresholds(bins: list, weight: dict, precision: float) -> dict[int, float]:
    found: dict[int, float] = {}
    for kind in range(len(KINDS)):
        own = [r for r in bins if r["kind"] == kind]
        for low in sorted({r["bin"] for r in own}):
            above = [r for r in own if r["bin"] >= low]
            sums = [sum(r["count"] * weight[kind, c] for r in above if r["label"] == c) for c in (0.0, 1.0)]
            if sum(r["count"] for r in above) >= LEAST_SUPPORT and sums[1] / (sums[0] + sums[1] + 1) >= precision:
                found[kind] = low / 50
                break
    return found


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(quoted("doc_id").alias("doc_id"), F.coalesce(quoted("text"), F.lit("")).alias("text"))


def choose(df: DataFrame, model: Model) -> DataFrame:
    """``spans`` in place of ``candidates``: base and accepted spans, by start, then kind.

    Of accepted candidates those stay that overlap no base span and no better candidate (higher score, then
    earlier, then longer), so what is added never overlaps anything.
    """
    limit = " ".join(f"when {k} then {t!r}" for k, t in model.thresholds.items())
    wanted = f"case x.kind {limit} else 2.0 end" if limit else "2.0"
    span = "x.kind as kind, x.start as start, x.end as end"
    df = df.withColumn("scored", F.expr(f"transform(candidates, x -> struct({span}, {model.score} as score))"))
    # Two generators may propose the same span.
    by_place = "(x, y) -> int(sign(x.start - y.start))"
    df = df.withColumn("wanted", F.expr(f"array_sort(array_distinct(filter(scored, x -> x.score >= {wanted})), {by_place})"))
    free = "filter(v.own, x -> not exists(v.near, b -> b.start < x.end and x.start < b.end))"
    df = df.withColumn("accepted", F.expr(beside("wanted", "base", free)))
    better = """filter(v.own, x -> not exists(v.near, y -> y.start < x.end and x.start < y.end and
        struct(-y.score, y.start, -y.end, y.kind) < struct(-x.score, x.start, -x.end, x.kind)))"""
    best = beside("accepted", "accepted", better)
    by_start = "x -> struct(x.start as start, x.kind as kind, x.end as end)"
    both = f"concat(transform(base, {by_start}), transform({best}, {by_start}))"
    ordered = f"transform(array_sort({both}), x -> struct({span}))"
    return df.withColumn("spans", F.expr(ordered)).drop("candidates", "scored", "wanted", "accepted")


def with_spans(df: DataFrame, text: str, model: Model) -> DataFrame:
    """Adds ``base`` and ``spans`` to the rows; see ``choose``."""
    return choose(candidate_spans(base_spans(df, text), text), model)


def find_personal(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, text, base, spans`` a row: arrays of ``kind`` (number in KINDS), ``start``, ``end`` (exclusive).

    A null text counts as empty and has no span. Repeated rows are answered each; an empty table gives an empty
    result. Only ``doc_id`` and ``text`` are looked at.
    """
    return with_spans(_texts(docs), "text", model)


def redact(docs: DataFrame, model: Model) -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets; null texts stay null.

    Overlapping spans are replaced from the first one's start to the last one's end, by the first one's kind.
    """
    names = f"array({', '.join(repr(k) for k in KINDS)})"
    order = free_name(docs.columns, "row")
    packed = docs.select(F.struct(*(quoted(c) for c in docs.columns)).alias(order), quoted("text").alias("text"))
    found = with_spans(packed.withColumn("text", F.coalesce("text", F.lit(""))), "text", model)
    before = "substring(text, s.at + 1, x.start - s.at)"
    cut = f"""aggregate(spans, struct(0 as at, '' as made), (s, x) -> struct(greatest(s.at, x.end) as at,
        if(x.start < s.at, s.made, concat(s.made, {before}, '<', {names}[x.kind], '>')) as made),
        s -> concat(s.made, substring(text, s.at + 1)))"""
    clean = found.withColumn("text", F.expr(cut))
    row = F.col(order)
    own = {c: row.getField(c) for c in docs.columns}
    own["text"] = F.when(own["text"].isNotNull(), F.col("text"))
    return clean.select(*(v.alias(c) for c, v in own.items()))


def listed(spans: str) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = f"array({', '.join(repr(k) for k in KINDS)})"
    return F.expr(f"array_join(transform({spans}, x -> concat({names}[x.kind], ':', x.start, ':', x.end)), ',')")

"""Registered queries of the text operators and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm import fertility, langid, licenses, pii, toxicity
from millrace.llm.centroids import cluster_vectors
from millrace.llm.decontaminate import matches
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.mixing import mix_plan
from millrace.llm.neighbours import nearest_neighbours
from millrace.llm.paragraph_dedup import repeated_paragraphs
from millrace.llm.resampling import importance_ranks
from millrace.llm.shared import documents
from millrace.llm.simhash import simhash_groups


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    found = langid.identify(docs, model)
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def labelled(spark: SparkSession, sf_dir: str, most: int = 2 * toxicity.PER_CLASS) -> DataFrame:
    """Texts with their label: ``most`` labelled ids of each class at most, by hash, so few that all tasks get them.

    ``stands_for`` is how many ids of the class there are for each of these.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("toxic is not null and doc_id is not null")
    labels = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    place = F.row_number().over(Window.partitionBy("toxic").orderBy(F.xxhash64("doc_id"), "doc_id"))
    few = labels.withColumn("place", place).where(F.col("place") <= most).select("doc_id", "toxic")
    sizes = labels.groupBy("toxic").agg(F.greatest(F.count("*") / float(most), F.lit(1.0)).alias("stands_for"))
    few = few.join(F.broadcast(sizes), "toxic")
    return documents(spark, sf_dir).select("doc_id", "text").join(F.broadcast(few), "doc_id")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = toxicity.with_kinds(labelled(spark, sf_dir))
    model = toxicity.fit(texts, [*toxicity.SEEDS, "toxic"], stands_for="stands_for")
    return toxicity.score(documents(spark, sf_dir), model)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(documents(spark, sf_dir))
    return found.select("doc_id", *(F.array_join(c, ",").alias(c) for c in ("sentences", "licenses")))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = dedup_lines(documents(spark, sf_dir).select("doc_id", "text"), counts=("chunks_removed", "lines_removed"))
    return clean.select("doc_id", "chunks_removed", "lines_removed", F.sha2("text", 256).alias("text_sha256"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.prepare(documents(spark, sf_dir))
    found = pii.choose(spans, pii.fit_prepared(spans))
    counts = [F.expr(f"bigint(size(filter(base, x -> x.kind = {k})))").alias(f"n_{n}") for k, n in enumerate(pii.KINDS)]
    base = F.sha2(pii.listed("base"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, base, pii.listed("spans").alias("spans"))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(documents(spark, sf_dir).select("doc_id", "source", "text"), (3, 1, 2), share=1.5, most=2.0)
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(documents(spark, sf_dir), shingle=4, distance=4)
    return groups.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op9_tokeniser_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.judge(documents(spark, sf_dir)).drop("key", "size").withColumnRenamed("grp", "band")


def op10_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(documents(spark, sf_dir)).drop("key")


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = importance_ranks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return ranks.select("doc_id", "n_features", "weight", "score", "rank")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), clusters=16, rounds=3)


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), every=20, most=20)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_toxicity": op2_toxicity,
    "op3_line_dedup": op3_line_dedup,
    "op4_personal_data": op4_personal_data,
    "op5_license_scan": op5_license_scan,
    "op6_mix_sources": op6_mix_sources,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op8_decontaminate": op8_decontaminate,
    "op9_tokeniser_quality": op9_tokeniser_quality,
    "op10_paragraph_dedup": op10_paragraph_dedup,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_centroid_clustering": op12_centroid_clustering,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

# The level of the targets: sources in order of size / weight fill up until the rest can share what is left.
OP6_SQL = """
WITH sized AS (
  SELECT doc_id, source, text, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS k,
         CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size
  FROM documents
), sources AS (
  SELECT k, CAST(sum(size) AS DOUBLE) AS s, [3, 1, 2][CAST((row_number() OVER (ORDER BY k) - 1) % 3 + 1 AS INT)] AS w
  FROM sized GROUP BY k
), filled AS (
  SELECT *, coalesce(sum(2.0 * s) OVER before, 0) AS c, sum(s) OVER () AS t,
         sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS r
  FROM sources WINDOW before AS (ORDER BY s / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT 1.5 * t - c AS rest, r FROM filled WHERE NOT 2.0 * s * r < w * (1.5 * t - c) ORDER BY s / w, k LIMIT 1
), aimed AS (
  SELECT k, CAST(s AS BIGINT) AS source_size,
         CASE WHEN 2.0 * s * level.r < w * rest THEN 2.0 * s ELSE w * rest / level.r END AS target
  FROM sources LEFT JOIN level ON true
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS rate,
         CAST('0x' || md5('17|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || coalesce(text, ''))[:13] AS BIGINT)
           / 4503599627370496.0 AS u
  FROM sized JOIN aimed USING (k)
)
SELECT doc_id, size, source_size, target, CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rated
"""



def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def op5_sql() -> str:
    """Sentence by sentence with positions, then one step a rule."""
    known = ", ".join(f"({_quote(s)}, {_quote(i)})" for s, i in licenses.SENTENCES.items())
    steps, names = [], []
    for k, (name, rule) in enumerate(licenses.RULES):
        pattern = _quote(licenses.rule_pattern(rule))
        steps.append(
            f"r{k + 1} AS (SELECT * REPLACE (regexp_replace(s, {pattern}, ',', 'g') AS s),"
            f" regexp_matches(s, {pattern}) AS h{k} FROM r{k})"
        )
        names.append((name, f"h{k}"))
    found = ", ".join(f"CASE WHEN {h} THEN {_quote(n)} END" for n, h in names)
    # What is not known is taken apart: units, then at semicolons, breaks, wrapping.
    parts = ", ".join(
        rf"""part{k + 1} AS (
  SELECT row_no, place, said, known.id FROM (
    SELECT *, regexp_replace(regexp_replace(said, '[^a-z0-9.-]+', ' ', 'g'), '^[ .-]+|[ .-]+$', '', 'g') AS sentence
    FROM (SELECT row_no, list_append(place, p) AS place, said[p] AS said
          FROM (SELECT row_no, place, said, unnest(range(1, len(said) + 1)) AS p
                FROM (SELECT row_no, place, string_split(said, {cut}) AS said FROM part{k} WHERE id IS NULL)))
  ) LEFT JOIN known USING (sentence)
)"""
        for k, cut in enumerate(("chr(2)", "';'", "chr(1)", "chr(3)"))
    )
    return rf"""
WITH known(sentence, id) AS (VALUES {known}),
cut AS (
  SELECT doc_id, row_number() OVER () AS row_no, regexp_replace(regexp_replace(lower(replace(regexp_replace(regexp_replace(
    regexp_replace(coalesce(text, ''), '\n[ \t\r#*/;-]*', chr(10), 'g'), '\n\n+', chr(2), 'g'), '\n([a-z(])', chr(3) || '\1', 'g'),
    chr(10), chr(1))), '\bv\.[ \x01\x03]+([0-9])', 'v \1', 'g'), '([.!?]+)[ \t\r\x01\x03]+', '\1' || chr(2), 'g') AS body
  FROM documents
), part0 AS (SELECT row_no, [] AS place, body AS said, CAST(NULL AS VARCHAR) AS id FROM cut),
{parts},
ids AS (
  SELECT row_no, string_agg(id, ',' ORDER BY place) AS sentences
  FROM ({" UNION ALL ".join(f"SELECT row_no, place, id FROM part{k}" for k in range(1, 5))}) WHERE id IS NOT NULL GROUP BY row_no
), r0 AS (
  SELECT doc_id, coalesce(sentences, '') AS sentences, ',' || coalesce(sentences, '') || ',' AS s
  FROM cut LEFT JOIN ids USING (row_no)
), {", ".join(steps)}
SELECT doc_id, sentences, CASE WHEN sentences = '' THEN '' ELSE array_to_string(list_distinct_ordered, ',') END AS licenses
FROM (SELECT *, list_filter(hits, lambda x, i: list_position(hits, x) = i) AS list_distinct_ordered
      FROM (SELECT *, list_filter([{found}], lambda x: x IS NOT NULL) AS hits FROM r{len(licenses.RULES)}))
"""


def op11_sql() -> str:
    """CRC-32 byte by byte over the distinct features, from its polynomial."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return rf"""
WITH rows AS (
  SELECT row_number() OVER () AS row_no, doc_id, text FROM documents
  UNION ALL SELECT -row_number() OVER (), NULL, text FROM benchmark
), said AS (
  SELECT row_no, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM rows
), features AS (
  SELECT row_no, unnest(list_concat(words, list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) AS feature
  FROM said
), counted AS (SELECT row_no, feature, count(*) AS n FROM features GROUP BY ALL),
hashed AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, len(hex(encode(feature))) // 2 + 1),
    lambda i: CAST('0x' || hex(encode(feature))[2 * i - 1:2 * i] AS BIGINT))), lambda c, b:
    xor([{", ".join(map(str, table))}][xor(c & 255, b) + 1], c >> 8)), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT feature FROM counted)
), bucketed AS (SELECT row_no, bucket, sum(n) AS n FROM counted JOIN hashed USING (feature) GROUP BY ALL),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (row_no > 0), 0) AS s, coalesce(sum(n) FILTER (row_no < 0), 0) AS t
  FROM bucketed GROUP BY bucket
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (sum(s) OVER () + 10000) /
    ((CAST(s AS DOUBLE) + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain
  FROM totals
), weights AS (
  SELECT row_no, CAST(sum(n) AS BIGINT) AS n_features, CAST(sum(n * gain) AS BIGINT) AS g
  FROM bucketed JOIN gains USING (bucket) GROUP BY row_no
), scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features,
    CASE WHEN n_features IS NULL THEN 0 ELSE (g - ((g % n_features) + n_features) % n_features) // n_features END AS weight,
    CAST('0x' || sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), ''))[:8] AS BIGINT) AS h
  FROM said LEFT JOIN weights USING (row_no) WHERE row_no > 0
), noisy AS (
  SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored
), placed AS (
  SELECT *, CASE WHEN n_words >= 20 THEN row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id, n_features) END AS place,
    count(*) FILTER (n_words >= 20) OVER () * 25 // 100 AS most
  FROM noisy
)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN place <= most THEN place END AS rank
FROM placed
"""


def op12_sql() -> str:
    """Round by round, every vector against every centroid, component by component."""
    steps = []
    for k in range(4):
        steps.append(f"""near{k} AS (
  SELECT row_no, arg_min(cluster, (d, cluster)) AS cluster, min(d) AS d
  FROM (SELECT row_no, cluster, sum((v.x - c.x) * (v.x - c.x)) AS d FROM parts v JOIN c{k} c USING (p) GROUP BY ALL)
  GROUP BY row_no
)""")
        if k < 3:
            steps.append(f"""c{k + 1} AS (
  SELECT c.cluster, c.p, CASE WHEN n IS NULL THEN c.x ELSE (s - ((s % n) + n) % n) // n END AS x
  FROM c{k} c LEFT JOIN (SELECT cluster, p, sum(x) AS s, count(*) AS n FROM parts JOIN near{k} USING (row_no) GROUP BY ALL)
    USING (cluster, p)
)""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS row_no, vec_id,
    list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
), parts AS (SELECT row_no, unnest(range(1, 65)) AS p, unnest(v) AS x FROM kept),
firsts AS (
  SELECT row_no, row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)), v) - 1 AS cluster
  FROM kept QUALIFY cluster < 16
), c0 AS (SELECT cluster, p, x FROM firsts JOIN parts USING (row_no)),
{", ".join(steps)},
named AS (SELECT cluster, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY p)) AS centroid_sha256 FROM c3 GROUP BY cluster)
SELECT vec_id, CAST(cluster AS INT) AS cluster, CAST(d AS BIGINT) AS distance,
  CAST(sum(d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM near3 JOIN kept USING (row_no) JOIN named USING (cluster)
"""


ORACLE_SQL: dict[str, str] = {
    "op5_license_scan": op5_sql(),
    "op6_mix_sources": OP6_SQL,
    "op11_importance_resampling": op11_sql(),
    "op12_centroid_clustering": op12_sql(),
}

"""The corpus pipeline: documents through text operators, each stage stored before the next one reads it."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid
from millrace.llm.decontaminate import decontaminate
from millrace.llm.line_dedup import dedup_lines
from millrace.llm.mixing import mix
from millrace.llm.shared import documents, shared_folder
from millrace.llm.simhash import keep_one

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


# A text of a learnt language reaches the score: all but one in a thousand do, or the bound is even odds.
LOST_TEXTS, EVEN_ODDS = 0.001, 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a language go: no letter in them, or a score below what texts of a learnt language reach.

    The bound is taken from the documents the model has not learnt from. Noise and unlearnt languages stay below
    it, for their n-grams are unknown; code that is mostly English words may reach it.
    """
    kept_back = langid.held_out(F.col("doc_id"))
    model = langid.fit(docs.where(~kept_back))
    bound = langid.least_score(docs.where(kept_back), model, LOST_TEXTS, EVEN_ODDS)
    return langid.keep_identified(docs, model, bound)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line chunks that an earlier document has are taken out of the texts; no document goes."""
    return dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return keep_one(docs, shingle=4, distance=4)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks, numbered in ``copy``."""
    return mix(docs, copy_column="copy", weights=(3, 1, 2), share=1.5, most=2.0)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
]

# Language prediction and fingerprints have no counterpart in SQL; the stages are tested one by one.
ORACLE_SQL: str | None = None


def oracles() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet to the shared folder and read back."""
    folder, docs = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}", documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

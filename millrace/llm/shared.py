"""Helpers of the text operators: row keys, reliable checkpoints, names that do not clash."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_A_FILE = 250_000
# White space of all word rules here: ASCII only, as ``bytes.split()`` sees it.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary folder, because there driver and executors are one
    process.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="millrace-llm-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpointed(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there, without the plan that made them.

    Where it is known how many small rows there are at most, they go to as few files as hold them well.
    """
    if rows is not None:
        df = df.coalesce(max(1, -(-rows // ROWS_A_FILE)))
    context = df.sparkSession.sparkContext
    folder = shared_folder(df.sparkSession)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """The rows as a Parquet table of the shared folder: for wide rows that several steps read in parts.

    The table is scratch data of the session, to be removed with the folder it is in.
    """
    path = f"{shared_folder(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.parquet(path)


def free_name(taken: Iterable[str], wish: str) -> str:
    """A column name that is not among those taken; Spark compares names without case."""
    used, name = {t.lower() for t in taken}, wish
    while name.lower() in used:
        name = f"_{name}"
    return name


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def row_key(doc_id: Column, text: Column) -> Column:
    """128 bits that tell documents apart: never null, equal only for equal id and text."""
    part = lambda c: F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), c.cast("string")))
    return F.unhex(F.md5(F.concat(part(doc_id), F.lit("\x00"), part(text)).cast("binary")))


def values(column: pa.Array, kind: pa.DataType | None = None, lot: int = 256) -> Iterator:
    """The values of an Arrow column as Python objects, a few at a time: a batch is never copied whole."""
    for start in range(0, len(column), lot):
        part = column.slice(start, lot)
        yield from (part if kind is None else part.cast(kind)).to_pylist()


def columns_of(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that others cannot clash with what an operator adds."""
    return df.select(*(quoted(n).alias(n) for n in names))

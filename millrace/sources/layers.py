"""Layer tables: one folder per layer and table, in whatever format the session can write."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.insert import absent_rows
from millrace.operators.quality import require_count, row_count, stack_reports


@dataclass(frozen=True)
class Layout:
    """Where the layers live. ``fmt`` is ``parquet``, or ``delta`` when its package is on the classpath."""

    root: str
    fmt: str = "parquet"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/{layer}/{table}"

    def checkpoint(self, layer: str, table: str) -> str:
        return f"{self.root.rstrip('/')}/_checkpoints/{layer}/{table}"


def read_layer(spark: SparkSession, layout: Layout, layer: str, table: str) -> DataFrame:
    return spark.read.format(layout.fmt).load(layout.path(layer, table))


def read_layer_stream(
    spark: SparkSession,
    layout: Layout,
    layer: str,
    table: str,
    schema: T.StructType | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """A layer table as a stream. File formats need the schema; ``max_files`` caps a micro-batch's backlog."""
    reader = spark.readStream.format(layout.fmt)
    if schema is not None and layout.fmt != "delta":
        reader = reader.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(layout.path(layer, table))


def write_layer(df: DataFrame, layout: Layout, layer: str, table: str, mode: str = "overwrite") -> None:
    writer = df.write.format(layout.fmt).mode(mode)
    if layout.fmt == "delta" and mode == "overwrite":
        writer = writer.option("overwriteSchema", "true")
    writer.save(layout.path(layer, table))


def write_partitions(
    df: DataFrame,
    layout: Layout,
    layer: str,
    table: str,
    columns: Sequence[str],
    mode: str = "overwrite",
    gather: bool = True,
) -> int:
    """Write a table partitioned by some columns, and count its rows on their way out.

    Rows are rebalanced by partition: AQE cuts a partition that holds most of the rows into several files and lets
    one task write many small ones. Without ``gather`` no row is moved, and every task writes a file of each partition.
    """
    seen = Observation()
    rows = df.observe(seen, F.expr("count(1) as rows"))
    if gather:
        rows = rows.hint("rebalance", *columns)
    rows.write.format(layout.fmt).mode(mode).partitionBy(*columns).save(layout.path(layer, table))
    return seen.get["rows"]


def overwrite_partitions(df: DataFrame, layout: Layout, layer: str, table: str, columns: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows for; all others keep their files."""
    writer = df.hint("rebalance", *columns).write.format(layout.fmt).mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy(*columns).save(layout.path(layer, table))


def write_counted(df: DataFrame, layout: Layout, layer: str, table: str) -> int:
    """Overwrite a table and count the rows on their way out, as an observed metric of the write itself."""
    seen = Observation()
    write_layer(df.observe(seen, F.expr("count(1) as rows")), layout, layer, table)
    return seen.get["rows"]


def stored_counts(spark: SparkSession, layout: Layout, layer: str, tables: Iterable[str]) -> dict[str, int]:
    """Rows per stored table, in one job; columnar formats answer from their footers."""
    report = stack_reports([row_count(read_layer(spark, layout, layer, t), t) for t in tables])
    return {row["table"]: row["rows"] for row in report.toLocalIterator()}


def require_stored(spark: SparkSession, layout: Layout, layer: str, expected: Mapping[str, int]) -> None:
    """What was counted while writing must be what can be read back."""
    found = stored_counts(spark, layout, layer, expected)
    for table, rows in expected.items():
        require_count(f"{layer}.{table}", rows, found[table])


def write_checked(df: DataFrame, layout: Layout, layer: str, table: str) -> int:
    """Write one table, computing the frame once, and compare with what can be read back."""
    rows = write_counted(df, layout, layer, table)
    require_stored(df.sparkSession, layout, layer, {table: rows})
    return rows


def insert_if_absent(new: DataFrame, layout: Layout, layer: str, table: str, key: str) -> None:
    """Append the rows of ``new`` whose key the stored table does not have.

    File formats get an anti join and an append, for one writer at a time; Delta gets a MERGE, which also
    holds against concurrent writers.
    """
    spark = new.sparkSession
    target = read_layer(spark, layout, layer, table)
    fresh = absent_rows(target, new, key)
    if layout.fmt != "delta":
        write_layer(fresh, layout, layer, table, mode="append")
        return
    view = f"fresh_{uuid.uuid4().hex}"
    fresh.createOrReplaceTempView(view)
    spark.sql(
        f"MERGE INTO delta.`{layout.path(layer, table)}` t USING {view} s "
        f"ON t.`{key}` = s.`{key}` WHEN NOT MATCHED THEN INSERT *"
    )

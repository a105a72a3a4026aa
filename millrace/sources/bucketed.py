"""Layer tables whose rows lie in buckets of a key, so that joins, sums and checks by that key need no shuffle.

The rows are dealt to buckets once, when the table is written. Two tables in the same number of buckets of their join
keys are joined bucket by bucket; rows of a key are together for sums, dedup and uniqueness. A key that holds a large
part of all rows fills one bucket, which one task reads: deal such tables by another key (facts by their own key), or
keep the plain layout, where AQE splits it. Buckets are known to the session's catalog, not to the files: a new
session calls :func:`register`.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from millrace.functions.expressions import literal, name
from millrace.sources.layers import Layout


def table_name(layout: Layout, layer: str, table: str) -> str:
    """The catalog's name of a bucketed table; its folder decides it."""
    return f"bucketed_{hashlib.sha256(layout.path(layer, table).encode()).hexdigest()[:24]}"


def write_bucketed(df: DataFrame, layout: Layout, layer: str, table: str, key: str, buckets: int) -> None:
    """Overwrite a table, dealt into ``buckets`` by ``key`` and sorted by it; a file a bucket."""
    rows = df.repartition(buckets, key)
    writer = rows.write.format("parquet").mode("overwrite").bucketBy(buckets, key).sortBy(key)
    writer.option("path", layout.path(layer, table)).saveAsTable(table_name(layout, layer, table))


def register(spark: SparkSession, layout: Layout, layer: str, table: str, key: str, buckets: int) -> None:
    """Tell this session's catalog about a bucketed table that another session has written."""
    path = layout.path(layer, table)
    schema = spark.read.parquet(path).schema
    columns = ", ".join(f"{name(f.name)} {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table_name(layout, layer, table)} ({columns}) USING parquet"
        f" CLUSTERED BY ({name(key)}) SORTED BY ({name(key)}) INTO {buckets} BUCKETS LOCATION {literal(path)}"
    )


def read_bucketed(spark: SparkSession, layout: Layout, layer: str, table: str) -> DataFrame:
    return spark.table(table_name(layout, layer, table))

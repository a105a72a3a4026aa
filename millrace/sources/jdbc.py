"""JDBC tables in, JDBC tables out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from millrace.operators.quality import QualityError, require_count

FETCH_ROWS = 10_000
BATCH_ROWS = 5_000


@dataclass(frozen=True)
class JdbcConnection:
    """Credentials come from the caller; ``repr`` leaves the password out."""

    url: str
    user: str
    password: str = field(repr=False)
    driver: str = "org.postgresql.Driver"
    schema: str | None = None

    def table(self, name: str) -> str:
        return f"{self.schema}.{name}" if self.schema else name

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
            "dbtable": table,
        }


def scan_options(conn: JdbcConnection, table: str) -> dict[str, str]:
    return {**conn.options(conn.table(table)), "fetchsize": str(FETCH_ROWS)}


def range_predicates(column: str, bounds: Sequence[object]) -> list[str]:
    """Conditions that cut a table at the bounds, each row into exactly one part; NULLs go with the first."""
    cuts = [str(b) if isinstance(b, (int, float)) else f"'{b}'" for b in dict.fromkeys(bounds)]
    if not cuts:
        return ["1 = 1"]
    first = f"{column} <= {cuts[0]} or {column} is null"
    between = [f"{column} > {low} and {column} <= {high}" for low, high in zip(cuts, cuts[1:])]
    return [first, *between, f"{column} > {cuts[-1]}"]


def quantile_predicates(spark: SparkSession, conn: JdbcConnection, table: str, column: str, parts: int) -> list[str]:
    """Ranges with about equally many rows, however the values are spread; the store finds the bounds.

    ``parts`` rows come back. An outlier or a gap in the keys moves a bound and no rows.
    """
    tile = f"{column} as k, ntile({parts}) over (order by {column}) as tile"
    tiles = f"select {tile} from {conn.table(table)} where {column} is not null"
    query = f"(select tile, max(k) as high from ({tiles}) tiles group by tile) bounds"
    rows = spark.read.format("jdbc").options(**conn.options(query)).load().collect()
    bounds = [r["high"] for r in sorted(rows, key=lambda r: r["tile"])]
    return range_predicates(column, bounds[:-1])


def read_jdbc(
    spark: SparkSession, conn: JdbcConnection, table: str, predicates: Sequence[str] | None = None
) -> DataFrame:
    """A table scan over one connection, or over one for each predicate."""
    options = scan_options(conn, table)
    if not predicates:
        return spark.read.format("jdbc").options(**options).load()
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=list(predicates), properties=properties)


def publish_options(conn: JdbcConnection, table: str, truncate: bool, connections: int) -> dict[str, str]:
    return {
        **conn.options(conn.table(table)),
        "batchsize": str(BATCH_ROWS),
        "truncate": str(truncate).lower(),
        "numPartitions": str(connections),
    }


@dataclass(frozen=True)
class JdbcSource:
    """The operational store as a source of the Bronze layer.

    Tables listed in ``keys`` are scanned in ``connections`` ranges of that column, those in ``predicates`` by the
    given conditions, the others over one connection.
    """

    conn: JdbcConnection
    connections: int
    keys: Mapping[str, str] = field(default_factory=dict)
    predicates: Mapping[str, Sequence[str]] = field(default_factory=dict)
    system: str = "postgresql"

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        parts = self.predicates.get(table)
        if not parts and table in self.keys and self.connections > 1:
            parts = quantile_predicates(spark, self.conn, table, self.keys[table], self.connections)
        return read_jdbc(spark, self.conn, table, parts)


@dataclass(frozen=True)
class JdbcTarget:
    """A serving database the Gold layer is published to.

    ``connections`` is how many tasks write at once, by what the database takes. ``truncate`` keeps the tables'
    own definitions and grants instead of dropping them.
    """

    conn: JdbcConnection
    connections: int
    truncate: bool = False

    def write(self, df: DataFrame, table: str) -> None:
        options = publish_options(self.conn, table, self.truncate, self.connections)
        df.write.format("jdbc").options(**options).mode("overwrite").save()

    def count(self, spark: SparkSession, table: str) -> int:
        """Counted by the database; one row comes back."""
        counted = f"(select count(*) as n from {self.conn.table(table)}) counted"
        return spark.read.format("jdbc").options(**self.conn.options(counted)).load().first()[0]


def publish(df: DataFrame, target, table: str) -> int:
    """Write one table and compare source and published counts; empty tables are refused."""
    expected = df.count()
    if not expected:
        raise QualityError(f"{table} has no rows to publish")
    target.write(df, table)
    published = target.count(df.sparkSession, table)
    require_count(table, expected, published)
    return published

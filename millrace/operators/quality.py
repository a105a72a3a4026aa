"""Data-quality reports. Each makes one pass over its table and returns a few rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import literal, name
from millrace.operators.dedupe import key_groups


class QualityError(RuntimeError):
    """A table broke a rule the pipeline must not go on with."""


def stack_reports(reports: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def with_total(report: DataFrame) -> DataFrame:
    """A last row ``total`` over all tables of a report of counts."""
    sums = [f"sum({name(c)}) as {name(c)}" for c in report.columns if c != "table"]
    return report.unionByName(report.selectExpr("'total' as table", *sums))


def row_count(df: DataFrame, table: str) -> DataFrame:
    return df.selectExpr("count(1) as rows").selectExpr(f"{literal(table)} as table", "rows")


def row_accounting(df: DataFrame, table: str, key: str, accepted: str, tie_break: Sequence[str]) -> DataFrame:
    """bronze = silver + duplicates + invalid; ``accepted`` names a boolean column."""
    return key_groups(df, key, accepted, tie_break).selectExpr(
        "coalesce(sum(copies), 0L) as bronze",
        "coalesce(sum(copies - 1), 0L) as duplicates",
        "count_if(not winner_accepted) as invalid",
        "count_if(winner_accepted) as silver",
    ).selectExpr(f"{literal(table)} as table", "*")


def duplicate_report(df: DataFrame, table: str, key: str, accepted: str, tie_break: Sequence[str]) -> DataFrame:
    """Keys with copies, rows dropped for them, and keys lost because an invalid copy won over a valid one."""
    return key_groups(df, key, accepted, tie_break).selectExpr(
        "count_if(copies > 1) as keys",
        "coalesce(sum(copies - 1), 0L) as extra_rows",
        "count_if(any_accepted and not winner_accepted) as keys_lost",
    ).selectExpr(f"{literal(table)} as table", "*")


def rejections(df: DataFrame, table: str, rules: Mapping[str, str]) -> DataFrame:
    """How many rows of the frame break each rule."""
    counts = df.selectExpr(*(f"count_if(not {rule}) as {name(label)}" for label, rule in rules.items()))
    return _tall(counts, list(rules), "rule", "n", table)


def null_counts(df: DataFrame, table: str) -> DataFrame:
    counts = df.selectExpr(*(f"count_if({name(c)} is null) as {name(c)}" for c in df.columns))
    return _tall(counts, df.columns, "column", "nulls", table)


def key_uniqueness(df: DataFrame, table: str, key: str) -> DataFrame:
    """Rows and distinct keys; NULL counts as one key value."""
    per_key = df.groupBy(key).agg(F.expr("count(1) as n"))
    totals = per_key.selectExpr("coalesce(sum(n), 0L) as rows", "count(1) as keys")
    return totals.selectExpr(f"{literal(table)} as table", "*")


def latest(df: DataFrame, by: str, n: int, columns: Sequence[str], tie_break: Sequence[str]) -> DataFrame:
    """The ``n`` newest rows; planned as a per-task top-n, never as a global sort."""
    order = [F.col(by).desc(), *(F.col(c).desc() for c in tie_break)]
    return df.orderBy(*order).limit(n).select(*columns)


def require_rows(df: DataFrame, table: str) -> None:
    if df.isEmpty():
        raise QualityError(f"{table} has no rows")


def require_unique(frames: Mapping[str, DataFrame], keys: Mapping[str, str]) -> None:
    """Check the key of every frame in one job."""
    report = stack_reports([key_uniqueness(frames[table], table, key) for table, key in keys.items()])
    broken = [r for r in report.toLocalIterator() if r["rows"] != r["keys"]]
    if broken:
        found = "; ".join(f"{r['table']}.{keys[r['table']]}: {r['rows']} rows, {r['keys']} keys" for r in broken)
        raise QualityError(f"keys are not unique: {found}")


def require_count(table: str, expected: int, actual: int) -> None:
    if expected != actual:
        raise QualityError(f"{table}: expected {expected} rows, found {actual}")


def _tall(counts: DataFrame, names: Sequence[str], label: str, value: str, table: str) -> DataFrame:
    pairs = ", ".join(f"{literal(n)}, {name(n)}" for n in names)
    tall = counts.selectExpr(f"stack({len(names)}, {pairs}) as ({name(label)}, {name(value)})")
    return tall.selectExpr(f"{literal(table)} as table", "*")

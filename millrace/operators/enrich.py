"""Left-outer enrichment and anti joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import name


def enrich(fact: DataFrame, dim: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``fact`` with ``columns`` of ``dim``; facts without a match keep NULLs.

    No hint: AQE broadcasts a side whose size it has seen at run time, and otherwise splits a partition that one
    hot key has swollen.
    """
    return fact.join(dim.select(key, *columns), key, "left")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child key values missing in the parent, with the number of rows carrying each.

    Child rows are counted per key before the join, so it sees each key once however often it repeats.
    """
    keys = child.where(f"{name(child_key)} is not null").groupBy(child_key)
    counted = keys.agg(F.expr("count(1) as n"))
    known = parent.selectExpr(f"{name(parent_key)} as {name(child_key)}").distinct()
    return counted.join(known, child_key, "left_anti")

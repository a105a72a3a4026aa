"""Insert rows whose unique key is not there yet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from millrace.functions.expressions import name
from millrace.operators.dedupe import dedupe


def absent_rows(target: DataFrame, new: DataFrame, key: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Rows of ``new`` to append: one per key unknown to ``target``. NULL keys never conflict."""
    keyed = dedupe(new.where(f"{name(key)} is not null"), key, tie_break)
    known = target.select(key).distinct()
    unknown = keyed.join(known, key, "left_anti").select(*new.columns)
    return unknown.unionByName(new.where(f"{name(key)} is null"))


def append_new(target: DataFrame, new: DataFrame, key: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """``target`` and the absent rows of ``new`` as one frame."""
    return target.unionByName(absent_rows(target, new, key, tie_break), allowMissingColumns=True)

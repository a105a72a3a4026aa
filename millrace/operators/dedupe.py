"""One row per key, chosen by a total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.expressions import name


def total_order(columns: Sequence[str], key: str, tie_break: Sequence[str] = ()) -> list[str]:
    """``tie_break`` first, then every other business column, so equal ranks mean equal rows."""
    return [*tie_break, *(c for c in columns if c != key and c not in tie_break and not c.startswith("_"))]


def dedupe(df: DataFrame, key: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Keep the first row of each key; NULL keys count as one key.

    ``row_number() = 1`` is planned as a group limit below the exchange as well, so a map task sends at most
    one row per key and a heavily copied key never piles up in one reducer.
    """
    order = total_order(df.columns, key, tie_break) or [key]
    ranking = ", ".join(f"{name(c)} asc nulls first" for c in order)
    ranked = df.selectExpr("*", f"row_number() over (partition by {name(key)} order by {ranking}) as _rank")
    return ranked.where("_rank = 1").drop("_rank")


def key_groups(df: DataFrame, key: str, accepted: str, tie_break: Sequence[str] = ()) -> DataFrame:
    """Per key: how many copies, whether the winner is accepted, whether any copy would have been.

    ``accepted`` names a boolean column. A plain aggregate: copies are combined before the exchange and the
    winner is the smallest row in the order :func:`dedupe` uses.
    """
    order = [c for c in total_order(df.columns, key, tie_break) if c != accepted]
    fields = ", ".join(name(c) for c in (*order, accepted))
    picked = df.selectExpr(name(key), f"struct({fields}) as _row", f"{name(accepted)} as _accepted")
    return picked.groupBy(key).agg(
        F.expr("count(1) as copies"),
        F.expr(f"min(_row).{name(accepted)} as winner_accepted"),
        F.expr("max(_accepted) as any_accepted"),
    )

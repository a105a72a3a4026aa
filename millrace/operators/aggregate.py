"""Group-by reports declared as measures, in one step or, across a join, in two."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.expressions import mean_from_parts, name
from millrace.operators.enrich import enrich


@dataclass(frozen=True)
class Measure:
    """``how`` is one of sum, avg, count, min, max; ``digits`` rounds half up, ``None`` leaves it."""

    alias: str
    how: str
    column: str
    digits: int | None = None

    def direct(self) -> str:
        return self._final(f"{self.how}({name(self.column)})")

    def partial(self) -> list[str]:
        column = name(self.column)
        if self.how == "avg":
            return [f"sum({column}) as {self._part('sum')}", f"count({column}) as {self._part('n')}"]
        return [f"{self.how}({column}) as {name(self.alias)}"]

    def merged(self, source: T.DataType) -> str:
        """The value :meth:`direct` would give, in the same type, from rows of :meth:`partial`."""
        decimal = isinstance(source, T.DecimalType)
        if self.how == "avg":
            total, n = f"sum({self._part('sum')})", f"sum({self._part('n')})"
            if not decimal:
                return self._final(mean_from_parts(total, n, None))
            precision, scale = min(source.precision + 4, 38), min(source.scale + 4, 38)
            return self._final(f"cast({mean_from_parts(total, n, scale)} as decimal({precision},{scale}))")
        value = f"{'sum' if self.how == 'count' else self.how}({name(self.alias)})"
        if self.how == "sum" and decimal:
            value = f"cast({value} as decimal({min(source.precision + 10, 38)},{source.scale}))"
        return self._final(value)

    def _final(self, value: str) -> str:
        return f"{value if self.digits is None else f'round({value}, {self.digits})'} as {name(self.alias)}"

    def _part(self, which: str) -> str:
        return name(f"{self.alias}__{which}")


def summarise(df: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    return _grouped(df, keys, [m.direct() for m in measures])


def summarise_enriched(
    fact: DataFrame,
    dim: DataFrame,
    join_key: str,
    fact_keys: Sequence[str],
    dim_keys: Sequence[str],
    measures: Sequence[Measure],
) -> DataFrame:
    """Group facts by columns of their own and columns of a joined dimension, which must be unique on the join key.

    Without columns of their own, facts are summed up per join key before the join, so it moves sums instead of rows
    and a hot key arrives as a handful of rows. With such columns, a day or a kind, few rows of one task agree in all
    of them and the join key: the sums would be about as many as the rows and wider, so rows are joined, and a hot key
    is divided as in :func:`enrich`. One program for every size of the dimension.
    """
    if fact_keys:
        needed = dict.fromkeys([join_key, *fact_keys, *(m.column for m in measures)])
        return summarise(enrich(fact.select(*map(name, needed)), dim, join_key, dim_keys), [*fact_keys, *dim_keys], measures)
    joined = enrich(partial_sums(fact, [join_key], measures), dim, join_key, dim_keys)
    return merge_partials(joined, dim_keys, measures, source_types(fact))


def source_types(fact: DataFrame) -> dict[str, T.DataType]:
    return {f.name: f.dataType for f in fact.schema.fields}


def partial_sums(fact: DataFrame, keys: Sequence[str], measures: Sequence[Measure]) -> DataFrame:
    """Rows that :func:`merge_partials` can go on with; measures of one name must be the same measure."""
    columns = {c.rsplit(" as ", 1)[1]: c for m in measures for c in m.partial()}
    if any(columns[c.rsplit(" as ", 1)[1]] != c for m in measures for c in m.partial()):
        raise ValueError("two measures share a name")
    return _grouped(fact, keys, list(columns.values()))


def merge_partials(
    partials: DataFrame, keys: Sequence[str], measures: Sequence[Measure], sources: Mapping[str, T.DataType]
) -> DataFrame:
    """The measures over rows of :func:`partial_sums`; ``sources`` are the types of the columns they were made of."""
    return _grouped(partials, keys, [m.merged(sources[m.column]) for m in measures])


def _grouped(df: DataFrame, keys: Sequence[str], expressions: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*map(F.expr, expressions))

"""SQL expressions as text, for ``selectExpr``, ``where`` and ``F.expr``.

Text keeps contracts plain data and costs one call into the JVM per projection however wide it is; what Spark
runs is the same generated code either way.
"""

from __future__ import annotations

from collections.abc import Iterable


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def trimmed(x: str) -> str:
    return f"trim({x})"


def upper_trimmed(x: str) -> str:
    return f"upper(trim({x}))"


def lower_trimmed(x: str) -> str:
    return f"lower(trim({x}))"


def title_trimmed(x: str) -> str:
    return f"initcap(trim({x}))"


def one_of(x: str, values: Iterable[str]) -> str:
    return f"{x} in ({', '.join(map(literal, values))})"


def within(x: str, low: float, high: float | None) -> str:
    """Inclusive bounds; ``high`` may be open."""
    return f"{x} >= {low}" if high is None else f"{x} between {low} and {high}"


def holds(rule: str) -> str:
    """SQL filters keep a row only if the predicate is TRUE, so an unknown result counts as failed."""
    return f"coalesce({rule}, false)"


def unless_null(optional: Iterable[str], rule: str) -> str:
    """The rule, waived when any of the optional columns is NULL."""
    return " or ".join([*(f"{c} is null" for c in optional), f"({rule})"])


def guarded_ratio(numerator: str, denominator: str) -> str:
    """NULL unless the denominator is positive."""
    return f"case when {denominator} > 0 then ({numerator}) / {denominator} end"


def elapsed_hours(start: str, end: str) -> str:
    """Hours between two timestamps, each floored to its whole second; NULL while still open."""
    return f"(unix_seconds({end}) - unix_seconds({start})) / 3600.0D"


def flag(condition: str) -> str:
    return f"case when {condition} then 1 else 0 end"


def mean_from_parts(total: str, n: str, mean_scale: int | None) -> str:
    """The average whose sum and count were aggregated beforehand.

    ``mean_scale`` is the scale Spark's own ``avg`` would give for a decimal input (``None`` for doubles).
    Whole part and remainder are divided apart, so the quotient keeps that scale however large the sum is.
    """
    if mean_scale is None:
        return f"case when {n} > 0 then {total} / {n} end"
    count = f"cast({n} as decimal(20,0))"
    rest = f"({total} % {count})"
    whole = f"cast(({total} - {rest}) / {count} as decimal({37 - mean_scale},0))"
    fraction = f"cast(cast({rest} as decimal(38,{mean_scale})) / {count} as decimal({mean_scale + 1},{mean_scale}))"
    return f"case when {n} > 0 then {whole} + {fraction} end"

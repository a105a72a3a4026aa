"""Table contracts: what a clean row looks like, as data, and the operators compiled from it."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from millrace.functions.expressions import holds, literal, name, one_of, within
from millrace.operators.dedupe import dedupe


@dataclass(frozen=True)
class Reference:
    """A foreign key: ``column`` must exist as the key of ``table``."""

    column: str
    table: str


@dataclass(frozen=True)
class TableContract:
    """Rules and derived columns are SQL over the standardised columns."""

    name: str
    key: str
    required: tuple[str, ...]
    standardise: Mapping[str, Callable[[str], str]] = field(default_factory=dict)
    domains: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    ranges: Mapping[str, tuple[float, float | None]] = field(default_factory=dict)
    cross: Mapping[str, str] = field(default_factory=dict)
    derived: Mapping[str, str] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()

    def rules(self) -> dict[str, str]:
        """Rule name to a predicate that is TRUE or FALSE, never NULL."""
        rules = {f"required:{c}": f"({name(c)} is not null)" for c in self.required}
        rules |= {f"domain:{c}": holds(one_of(name(c), values)) for c, values in self.domains.items()}
        rules |= {f"range:{c}": holds(within(name(c), *bounds)) for c, bounds in self.ranges.items()}
        rules |= {f"cross:{label}": holds(rule) for label, rule in self.cross.items()}
        return rules

    def accepted(self) -> str:
        return " and ".join(self.rules().values())

    def violations(self) -> str:
        """An array of the names of all broken rules, in contract order."""
        broken = (f"if({rule}, null, {literal(label)})" for label, rule in self.rules().items())
        return f"array_compact(array({', '.join(broken)}))"


def standardised(df: DataFrame, contract: TableContract) -> DataFrame:
    """Tidy the text columns in one projection; NULLs stay NULL and blanks become empty strings."""
    tidy = contract.standardise
    return df.selectExpr(*(f"{tidy[c](name(c))} as {name(c)}" if c in tidy else name(c) for c in df.columns))


def with_derived(df: DataFrame, contract: TableContract) -> DataFrame:
    return df.selectExpr("*", *(f"{sql} as {name(c)}" for c, sql in contract.derived.items()))


def accept(df: DataFrame, contract: TableContract) -> DataFrame:
    """Standardise, drop rows that break a rule, add derived columns; works on streams too."""
    return with_derived(standardised(df, contract).where(contract.accepted()), contract)


def clean(df: DataFrame, contract: TableContract, tie_break: Sequence[str] = ()) -> DataFrame:
    """Raw rows to clean rows: dedup first, then the rules, so an invalid winner loses its key."""
    return accept(dedupe(df, contract.key, tie_break), contract)


def quarantine(df: DataFrame, contract: TableContract, tie_break: Sequence[str] = ()) -> DataFrame:
    """The rows :func:`clean` drops after dedup, each with the rules it broke."""
    tidy = standardised(dedupe(df, contract.key, tie_break), contract)
    return tidy.where(f"not ({contract.accepted()})").selectExpr("*", f"{contract.violations()} as violations")

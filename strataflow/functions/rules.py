"""Data-quality rules as values.

A rule names a column and a condition. Six kinds are built from parameters;
``condition`` takes any SQL predicate. A NULL outcome counts as failed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from strataflow.functions.columns import number


@dataclass(frozen=True)
class Rule:
    column: str
    kind: str
    args: tuple = ()

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"

    def test(self, dtypes: dict[str, str]) -> Column:
        """The condition as a column, reading text columns as numbers where needed."""
        col = F.col(self.column)
        dtype = dtypes.get(self.column, "")
        if self.kind == "not_null":
            return col.isNotNull()
        if self.kind == "positive":
            return number(col, dtype) > 0
        if self.kind == "non_negative":
            return number(col, dtype) >= 0
        if self.kind == "allowed_values":
            return col.isin(*self.args)
        if self.kind == "regex":
            return col.rlike(self.args[0])
        if self.kind == "range":
            return number(col, dtype).between(*self.args)
        if self.kind == "condition":
            return F.expr(self.args[0])
        raise ValueError(f"unknown rule kind {self.kind!r}")


def not_null(*columns: str) -> list[Rule]:
    return [Rule(c, "not_null") for c in columns]


def positive(*columns: str) -> list[Rule]:
    return [Rule(c, "positive") for c in columns]


def non_negative(*columns: str) -> list[Rule]:
    return [Rule(c, "non_negative") for c in columns]


def allowed(column: str, *values) -> list[Rule]:
    return [Rule(column, "allowed_values", values)]


def matches(column: str, pattern: str) -> list[Rule]:
    """``pattern`` is searched for, so anchor it to test the whole value."""
    return [Rule(column, "regex", (pattern,))]


def within(column: str, low, high) -> list[Rule]:
    return [Rule(column, "range", (low, high))]


def condition(column: str, predicate: str) -> list[Rule]:
    return [Rule(column, "condition", (predicate,))]


def rules_of(catalog: dict[str, Sequence[Rule]], table: str) -> list[Rule]:
    """Rules of a table, its name compared without regard to case."""
    folded = {name.lower(): rules for name, rules in catalog.items()}
    return list(folded.get(table.lower(), ()))


def catalog_from_table(rows: DataFrame) -> dict[str, list[Rule]]:
    """Read a rule table ``(nombre_tabla, columna, condicion)``.

    Rules are configuration kept by hand, so they are read to the driver.
    """
    catalog: dict[str, list[Rule]] = {}
    for row in rows.select("nombre_tabla", "columna", "condicion").collect():
        catalog.setdefault(row[0].lower(), []).extend(condition(row[1].lower(), row[2]))
    return catalog


def conjunction(rules: Sequence[Rule], df: DataFrame) -> Column:
    """All rules at once; NULL when none fails but one is NULL."""
    dtypes = dict(df.dtypes)
    tests = [r.test(dtypes) for r in sorted(rules, key=lambda r: r.column)]
    return reduce(and_, tests) if tests else F.lit(True)


def passes(rules: Sequence[Rule], df: DataFrame) -> Column:
    """True when every rule holds, False when one fails or is NULL."""
    return F.coalesce(conjunction(rules, df), F.lit(False))

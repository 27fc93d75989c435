"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F


def snake_case(name: str) -> str:
    """``FechaModificacion`` -> ``fecha_modificacion``."""
    return re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name).lower()


def decode(column: Column, values: Mapping) -> Column:
    """Look a code up in a small fixed mapping; unknown codes give NULL."""
    branches = iter(values.items())
    code, text = next(branches)
    chain = F.when(column == F.lit(code), F.lit(text))
    for code, text in branches:
        chain = chain.when(column == F.lit(code), F.lit(text))
    return chain


def date_key(column: Column) -> Column:
    """A date or timestamp as the integer ``YYYYMMDD``; NULL stays NULL."""
    day = F.to_date(column)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def micros(column: Column) -> Column:
    return F.unix_micros(column.cast("timestamp"))


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from ``start`` to ``end`` (may be negative)."""
    minute = 60_000_000
    first, last = micros(start), micros(end)
    floor_first = first - F.pmod(first, F.lit(minute))
    floor_last = last - F.pmod(last, F.lit(minute))
    return ((floor_last - floor_first) / minute).cast("long")


def hours_between(start: Column, end: Column) -> Column:
    return minutes_between(start, end) / 60


def person_name(column: Column) -> tuple[Column, Column]:
    """Split a full name into given name and surnames.

    Four words are read as two given names and two surnames; otherwise the
    first word is the given name and the rest, if any, the surnames.
    """
    words = F.split(column, " ")
    given = F.when(F.size(words) == 4, 2).otherwise(1)
    rest = F.greatest(F.size(words) - given, F.lit(0))
    first = F.array_join(F.slice(words, F.lit(1), given), " ")
    last = F.array_join(F.slice(words, given + 1, rest), " ")
    return first, F.nullif(last, F.lit(""))


def strip_prefix(text: Column, prefix: Column, separator: str = " - ") -> Column:
    """Drop ``prefix + separator`` from the front of ``text`` if it is there."""
    head = F.concat(prefix, F.lit(separator))
    return F.when(F.startswith(text, head), F.substr(text, F.length(head) + 1)).otherwise(text)


def number(column: Column, dtype: str) -> Column:
    """Text as a number, NULL where it is none; other types unchanged."""
    return column.try_cast("double") if dtype == "string" else column


def any_differs(pairs: Iterable[tuple[Column, Column]]) -> Column:
    """True when any pair differs; two NULLs count as equal."""
    return reduce(or_, (~left.eqNullSafe(right) for left, right in pairs), F.lit(False))

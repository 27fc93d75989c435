"""Slowly changing dimensions of type 1, and of types 1 and 2 mixed.

The source holds one row per business key; reduce it with
``changes.latest_per_key`` first. Keys missing from the source stay as they are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from strataflow.functions.columns import any_differs
from strataflow.operators.keys import assign_keys, last_key
from strataflow.session import materialize

VALID_FROM, VALID_TO, CURRENT = "fecha_inicio", "fecha_fin", "es_actual"


def _pairs(dim: DataFrame, source: DataFrame, key: str, attributes: Sequence[str], on_current: bool) -> DataFrame:
    """Dimension and source rows beside each other, each of them once, met or not.

    The one join that a load needs. It shuffles both sides, as a load writes
    what it is given of the dimension anyway.
    """
    new = source.select(
        F.col(key).alias("_key"),
        F.lit(True).alias("_hit"),
        *(F.col(c).alias(f"_new_{c}") for c in attributes),
    )
    match = F.col(key) == F.col("_key")
    if on_current:
        match &= F.col(CURRENT)
    return dim.withColumn("_held", F.lit(True)).join(new, match, "full_outer")


def _row(dim: DataFrame, values: Mapping[str, Column]) -> Column:
    """A row of the dimension; columns without a value are NULL."""
    none = F.lit(None)
    return F.struct(*(values.get(f.name, none).cast(f.dataType).alias(f.name) for f in dim.schema))


def _versions(pairs: DataFrame, old: Column, new: Column, fresh: Column) -> DataFrame:
    """Rows of all pairs: the old one where there is one, the new one where it is ``fresh``."""
    rows = F.array(F.when(F.col("_held"), old), F.when(F.col("_hit") & fresh, new))
    return pairs.select(F.inline(F.filter(rows, lambda r: r.isNotNull())))


def _numbered(rows: DataFrame, sk: str, key: str, last: int) -> DataFrame:
    """Rows without a surrogate key get one. They are stored first, as two parts are read from them."""
    rows = materialize(rows, "dimension")
    fresh = rows.filter(F.col(sk).isNull()).drop(sk)
    return rows.filter(F.col(sk).isNotNull()).unionByName(assign_keys(fresh, sk, [key], last))


def scd1_rows(dim: DataFrame, source: DataFrame, key: str, attributes: Sequence[str]) -> DataFrame:
    """What ``scd1_merge`` makes of the dimension; new rows have no surrogate key yet."""
    pairs = _pairs(dim, source.select(key, *attributes), key, attributes, on_current=False)
    new = {key: F.col("_key"), **{c: F.col(f"_new_{c}") for c in attributes}}
    old = {c: F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)) if c in attributes else F.col(c) for c in dim.columns}
    return _versions(pairs, _row(dim, old), _row(dim, new), F.col("_held").isNull())


def scd1_merge(
    dim: DataFrame | None,
    source: DataFrame,
    key: str,
    attributes: Sequence[str],
    sk: str,
    last: int | None = None,
) -> DataFrame:
    """Overwrite the attributes of known keys, append unknown keys.

    ``last`` is the highest surrogate key in use when ``dim`` is only a part
    of the dimension.
    """
    last = last_key(dim, sk) if last is None else last
    if dim is None:
        return assign_keys(source.select(key, *attributes), sk, [key], last)
    return _numbered(scd1_rows(dim, source, key, attributes), sk, key, last)


def scd2_rows(
    dim: DataFrame, source: DataFrame, key: str, overwrite: Sequence[str], versioned: Sequence[str], as_of: date
) -> DataFrame:
    """What ``scd2_merge`` makes of the dimension; new versions have no surrogate key yet.

    A pair of a current version and a source row gives the version, closed if a
    versioned attribute differs, and then the new version too; a past version
    gives itself, a source row alone a new version.
    """
    attributes = [*overwrite, *versioned]
    pairs = _pairs(dim, source.select(key, *attributes), key, attributes, on_current=True)
    hit = F.col("_hit") & F.col("_held")
    closing = F.coalesce(hit, F.lit(False)) & any_differs((F.col(c), F.col(f"_new_{c}")) for c in versioned)
    old = {c: F.when(hit, F.col(f"_new_{c}")).otherwise(F.col(c)) if c in overwrite else F.col(c) for c in dim.columns}
    old[VALID_TO] = F.when(closing, F.date_sub(F.lit(as_of), 1)).otherwise(F.col(VALID_TO))
    old[CURRENT] = F.col(CURRENT) & ~closing
    new = {key: F.col("_key"), VALID_FROM: F.lit(as_of), CURRENT: F.lit(True), **{c: F.col(f"_new_{c}") for c in attributes}}
    return _versions(pairs, _row(dim, old), _row(dim, new), F.col("_held").isNull() | closing)


def scd2_merge(
    dim: DataFrame | None,
    source: DataFrame,
    key: str,
    overwrite: Sequence[str],
    versioned: Sequence[str],
    sk: str,
    as_of: date,
    last: int | None = None,
) -> DataFrame:
    """Type 1 attributes overwrite the current version, type 2 attributes
    close it (the day before ``as_of``) and open a new one.

    The overwrite comes first: a version closed in this load already carries
    the new type 1 values. Past versions are never touched.
    """
    last = last_key(dim, sk) if last is None else last
    if dim is None:
        opened = source.select(
            key,
            *overwrite,
            *versioned,
            F.lit(as_of).cast("date").alias(VALID_FROM),
            F.lit(None).cast("date").alias(VALID_TO),
            F.lit(True).alias(CURRENT),
        )
        return assign_keys(opened, sk, [key], last)
    return _numbered(scd2_rows(dim, source, key, overwrite, versioned, as_of), sk, key, last)


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(CURRENT)

"""Split rows by data-quality rules and report what failed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from strataflow.functions.rules import Rule, conjunction, passes


def valid_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows for which every rule is true. Each rule is pushed to the scan by itself."""
    return df.filter(conjunction(rules, df))


def quarantined_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Exactly the rows ``valid_rows`` leaves out."""
    return df.filter(~passes(rules, df))


def split_rows(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    return valid_rows(df, rules), quarantined_rows(df, rules)


def failure_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Failed rows per rule, counted for all rules in one pass over the data."""
    dtypes = dict(df.dtypes)
    counts = [
        F.count_if(~F.coalesce(r.test(dtypes), F.lit(False))).alias(f"r{i}")
        for i, r in enumerate(rules)
    ]
    entries = [
        F.struct(
            F.lit(r.name).alias("rule"),
            F.lit(r.column).alias("column_name"),
            F.col(f"r{i}").alias("failures"),
        )
        for i, r in enumerate(rules)
    ]
    return df.agg(*counts).select(F.inline(F.array(*entries)))

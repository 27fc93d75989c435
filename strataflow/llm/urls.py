"""URL filters: given rules by host and path, and rules mined from what those label.

Spark's FP-growth finds token combinations that go with a verdict; rules pruned
by support and confidence are matched through an inverted index on their rarest
token.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.session import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_SUPPORT = 0.01  # share of labelled URLs that hold a combination
MIN_CONFIDENCE = 0.9


@dataclass(frozen=True)
class Rule:
    """``host`` and its subdomains, under ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty for null or no ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(F.coalesce(rest, F.lit("")), r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), F.coalesce(path, F.lit(""))


def longest_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, or null. ``rules`` is a short fixed list."""
    found = F.lit(None)
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        found = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens: scheme, host labels and endings, path parts, file ending, query names."""
    labels = F.split(host, r"\.")
    steps = F.filter(F.split(path, "/"), lambda x: x != "")
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"\?([^#]*)", 1)
    prefixed = [
        F.transform(F.filter(labels, lambda x: x != ""), lambda x: F.concat(F.lit("host:"), x)),
        F.array(F.concat(F.lit("end:"), F.element_at(labels, -1))),
        F.transform(steps, lambda x: F.concat(F.lit("path:"), F.regexp_replace(x, "[0-9]+", "#"))),
        F.transform(
            F.filter(F.split(query, "&"), lambda x: x != ""),
            lambda x: F.concat(F.lit("query:"), F.regexp_extract(x, "^[^=]*", 0)),
        ),
        F.array(F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^[A-Za-z][A-Za-z0-9+.-]*(?=://)", 0)))),
    ]
    return F.array_distinct(F.concat(*prefixed))


def mine(labelled: DataFrame, *, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules (``antecedent``, ``verdict``, ``confidence``, ``support``) from rows (``items``, ``verdict``).

    Tokens below the support are dropped before mining, and a rule is dropped
    when a part of its combination says the same at least as surely.
    """
    n = labelled.count()
    empty = labelled.sparkSession.createDataFrame([], "antecedent array<string>, verdict string, confidence double, support double")
    if not n:
        return empty
    common = (
        labelled.select(F.explode("items").alias("item")).groupBy("item").count()
        .where(F.col("count") >= max(1.0, min_support * n))
    )
    kept = (
        labelled.withColumn("row", F.monotonically_increasing_id())
        .select("row", "verdict", F.explode("items").alias("item"))
        .join(common.select("item"), "item")
        .groupBy("row", "verdict")
        .agg(F.collect_set("item").alias("items"))
    )
    baskets = materialize(
        kept.select(F.concat("items", F.array(F.concat(F.lit("verdict:"), "verdict"))).alias("items")), "baskets"
    )
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(baskets)
    found = materialize(
        model.associationRules.where(
            F.element_at("consequent", 1).startswith("verdict:")
            & ~F.exists("antecedent", lambda x: x.startswith("verdict:"))
        ).select(
            F.sort_array("antecedent").alias("antecedent"),
            F.substring(F.element_at("consequent", 1), 9, 1 << 20).alias("verdict"),
            "confidence",
            "support",
        ),
        "rules",
    )
    # A shorter rule that covers another holds all its tokens but some: meet on one shared token.
    parts = found.select(
        F.col("antecedent").alias("less"), F.col("verdict").alias("v"), F.col("confidence").alias("c"),
        F.element_at("antecedent", 1).alias("token"),
    )
    covered = (
        found.withColumn("token", F.explode("antecedent"))
        .join(parts, "token")
        .where(
            (F.col("v") == F.col("verdict"))
            & (F.size("less") < F.size("antecedent"))
            & (F.size(F.array_except("less", "antecedent")) == 0)
            & (F.col("c") >= F.col("confidence"))
        )
        .select("antecedent", "verdict")
        .distinct()
    )
    return found.join(covered, ["antecedent", "verdict"], "left_anti")


def judge(
    pages: DataFrame,
    rules: Sequence[Rule],
    *,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """One row per input row: ``id_col``, host, path, rule, verdict, ``mined`` and ``confidence``.

    The longest given rule that fits decides; its verdicts label the URLs that
    the mined rules are learnt from. Where none fits, the surest matching mined
    rule decides (then the better supported, then the first by its tokens), else
    ``default``. Null urls and urls without ``://`` have an empty host and path
    and get the verdict of their tokens. Null or repeated ids and repeated rows
    are kept; other columns are not read; an empty table gives an empty result.
    """
    url = F.col(url_col)
    host, path = host_and_path(url)
    rows = materialize(
        pages.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), url.alias("url"), host.alias("host"), path.alias("path"))
        .withColumn("given", longest_rule(F.col("host"), F.col("path"), rules))
        .withColumn("items", tokens(F.col("url"), F.col("host"), F.col("path")))
        .drop("url"),
        "urls",
    )
    mined = mine(
        rows.where("given is not null").select("items", F.col("given.verdict").alias("verdict")),
        min_support=min_support,
        min_confidence=min_confidence,
    )
    open_rows = rows.where("given is null")
    seen = open_rows.select(F.explode("items").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    # The index: every rule under the one of its tokens that the open rows hold least often.
    index = (
        mined.withColumn("token", F.explode("antecedent"))
        .join(seen, "token")
        .groupBy("antecedent", "verdict", "confidence", "support")
        .agg(F.min_by("token", F.struct("n", "token")).alias("token"), F.count("*").alias("held"))
        .where(F.col("held") == F.size("antecedent"))
    )
    best = (
        open_rows.select("row", "items", F.explode("items").alias("token"))
        .join(index, "token")
        .where(F.size(F.array_except("antecedent", "items")) == 0)
        .groupBy("row")
        .agg(
            F.min(
                F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), "antecedent", "verdict", "confidence")
            ).alias("best")
        )
    )
    return rows.join(best.select("row", "best.antecedent", "best.verdict", "best.confidence"), "row", "left").select(
        F.col("id").alias(id_col),
        "host",
        "path",
        F.col("given.rule").alias("rule"),
        F.coalesce("given.verdict", "verdict", F.lit(default)).alias("verdict"),
        F.col("antecedent").alias("mined"),
        F.col("confidence"),
    )

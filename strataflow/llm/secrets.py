"""Secrets in texts, told apart by who owns their values across the corpus.

A value that many owners carry is a copied example; one that a single owner
carries and that looks random is a live credential.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.text import free_name, text_column
from strataflow.session import materialize

# The kinds of the contract, in their order, and what makes a match count.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "owned")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

BARE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")  # a value without a name before it
MIN_ENTROPY = 3.0  # bits a character
LIVE_OWNERS = 2  # a live value has at most so many owners
LIVE_REPOSITORIES = 8  # and is in at most so many repositories

_SPAN = "array<struct<start:int,end:int,kind:int,hash:binary,random:boolean>>"


def _random(value: str) -> bool:
    """Does the value look drawn at random: letters and digits, high entropy? What is made up but
    looks random is told by how widely it is copied."""
    if not (any(c.isdigit() for c in value) and any(c.isalpha() for c in value)):
        return False
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    return entropy >= MIN_ENTROPY


def candidates(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, value): the base matches, and bare values outside them."""
    found = []
    folded = text.lower() if text.isascii() else text.encode("ascii", "replace").decode().lower()
    if any(word in folded for word in KEYWORDS):
        found += [(*m.span(), 0, m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(*m.span(), 1, m[0]) for m in ACCESS.finditer(text)]
    found += [(*m.span(), 2, m[0]) for m in HEX.finditer(text)]
    found.sort(key=lambda s: (s[0], s[2]))
    bare, k, covered = [], 0, 0
    for m in BARE.finditer(text):
        lo, hi = m.span()
        while k < len(found) and found[k][0] < hi:
            covered = max(covered, found[k][1])
            k += 1
        if covered <= lo and _random(m[0]):
            bare.append((lo, hi, 3, m[0]))
    return found + bare


def scan(
    df: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    repo_cols: Sequence[str] = ("source", "lang"),
    owner_col: str = "source",
    live_owners: int = LIVE_OWNERS,
    live_repositories: int = LIVE_REPOSITORIES,
) -> DataFrame:
    """One row per input row: ``id_col``, ``text_hash`` and ``spans`` in order of start, then kind.

    A span is (start, end, kind, owners, repositories, verdict): code points,
    end exclusive; verdict ``live`` (random-looking, at most ``live_owners``
    distinct owners and ``live_repositories`` repositories), ``example`` (more
    of either: widely copied) or ``weak``. Base kinds are
    always reported; a bare value (kind ``owned``) only when it is live.

    Null and empty texts have no spans. Null repositories and owners count as
    one unnamed owner. Rows with equal or null ids stay apart. Columns of other
    names are not read. An empty table gives an empty result. Counts are
    distinct before they are shuffled, so a value in a third of all rows
    reaches its counter once per task, owner and repository.
    """
    kind = df.schema[id_col].dataType.simpleString()
    source = df.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("")).alias("owner"),
        F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repo_cols]).alias("repo"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
    )
    span = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.int32()), ("hash", pa.binary()), ("random", pa.bool_())])
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                [
                    {"start": s, "end": e, "kind": k, "hash": hashlib.sha256(v.encode()).digest(), "random": _random(v)}
                    for s, e, k, v in candidates(text)
                ]
                for text in text_column(batch, "text").to_pylist()
            ]
            kept = [batch.column(c) for c in ("row", "id", "owner", "repo", "text_hash")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, span)], ["row", "id", "owner", "repo", "text_hash", "found"])

    found = materialize(
        source.mapInArrow(find, f"row bigint, id {kind}, owner string, repo string, text_hash bigint, found {_SPAN}"), "secrets"
    )
    each = found.where(F.size("found") > 0).select("row", "owner", "repo", F.explode("found").alias("s"))
    counts = (
        each.select(F.col("s.hash").alias("hash"), "owner", "repo")
        .distinct()
        .groupBy("hash")
        .agg(F.count_distinct("owner").alias("owners"), F.count_distinct("repo").alias("repositories"))
    )
    counts = materialize(counts, "owners")  # stored, so that the spans of a value that is everywhere can be split
    copied = (F.col("owners") > live_owners) | (F.col("repositories") > live_repositories)
    judged = (
        each.select("row", "s.*")
        .join(counts, "hash")
        .withColumn(
            "verdict",
            F.when(copied, "example").when(F.col("random"), "live").otherwise("weak"),
        )
        .where((F.col("kind") < 3) | (F.col("verdict") == "live"))
        .groupBy("row")
        .agg(
            F.sort_array(
                F.collect_list(F.struct("start", "kind", "end", "owners", "repositories", "verdict"))
            ).alias("spans")
        )
    )
    named = F.transform(
        F.coalesce("spans", F.array().cast("array<struct<start:int,kind:int,end:int,owners:bigint,repositories:bigint,verdict:string>>")),
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1).alias("kind"),
            s["owners"].alias("owners"),
            s["repositories"].alias("repositories"),
            s["verdict"].alias("verdict"),
        ),
    )
    return found.join(judged, "row", "left").select(F.col("id").alias(id_col), "text_hash", named.alias("spans"))


def redact(
    df: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", marks: dict[str, str] | None = None, **options
) -> DataFrame:
    """``df`` with every found secret replaced by a mark for its verdict.

    Only rows that hold a secret are changed; order of columns and all other
    values stay. Rows are matched by id and text, so equal rows change alike.
    Null and empty texts and ids stay as they are, columns may have any names,
    and an empty table gives an empty result.
    """
    marks = marks or {"live": "[LIVE_SECRET]", "example": "[EXAMPLE_SECRET]", "weak": "[SECRET]"}
    own, own_hash, found, done = (free_name(df.columns, c) for c in ("own_id", "own_hash", "found_spans", "done"))
    spans = (
        scan(df, id_col=id_col, text_col=text_col, **options)
        .where(F.size("spans") > 0)
        .groupBy(F.col(id_col).alias(own), F.col("text_hash").alias(own_hash))
        .agg(F.first("spans").alias(found))
    )
    text = F.col(text_col)
    # Overlapping spans are one: what counts is where the copied text goes on.
    pieces = F.aggregate(
        found,
        F.struct(F.lit("").alias("out"), F.lit(0).alias("at")),
        lambda acc, s: F.struct(
            F.when(
                s["start"] >= acc["at"],
                F.concat(
                    acc["out"],
                    F.substring(text, acc["at"] + 1, s["start"] - acc["at"]),
                    F.element_at(F.create_map(*[F.lit(x) for pair in marks.items() for x in pair]), s["verdict"]),
                ),
            ).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], s["end"]).alias("at"),
        ),
    )
    spans = materialize(spans, "spans")
    joined = df.join(spans, F.col(id_col).eqNullSafe(F.col(own)) & (F.xxhash64(text.cast("string")) == F.col(own_hash)), "left")
    joined = joined.withColumn(done, F.when(F.col(found).isNotNull(), pieces))
    rest = F.substring(text, F.col(done)["at"] + 1, F.length(text))
    changed = F.when(F.col(found).isNotNull(), F.concat(F.col(done)["out"], rest)).otherwise(text)
    return joined.select(*[changed.alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns])

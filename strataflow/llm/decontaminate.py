"""Benchmark passages in training texts, found by spaced seeds.

Fixed masks pick some of the words of a window and ignore the others, so a
passage with replaced words still has windows whose picked words are all alike.
Equal hashes give an alignment of text and item; an alignment with as many hits
as a passage must have is verified word by word.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.text import free_name
from strataflow.session import materialize

# Places of a window that a mask compares.
MASKS = ((0, 1, 2, 3), (0, 1, 3, 4))
FIVE = ((0, 1, 2, 4), (0, 2, 3, 4))  # besides, for items of five words
# Every stretch that counts has so many hits of MASKS at least, by the item's words (FIVE's with
# them for five); more words have LEAST_HITS. The tests enumerate all stretches.
HITS = {5: 1, 6: 1, 7: 1, 8: 2, 9: 3, 10: 1, 11: 2, 12: 3, 13: 4, 14: 5, 15: 3}
LEAST_HITS = 4
SHORTEST = 5  # words of an item that can be found at all
OVERLAP = 13  # like words that make a passage, or the share below of a shorter item
SHARE = 80  # per cent of a stretch that must be alike
BROADCAST_ROWS = 2_000_000  # beyond, hashes are joined by a shuffle

_FROM, _TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\"()", "abcdefghijklmnopqrstuvwxyz"
_SPACES = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Words of a text: A-Z lower-cased, without ``.,;:!?"()``."""
    plain = F.btrim(F.translate(F.coalesce(text.cast("string"), F.lit("")), _FROM, _TO), F.lit(_SPACES))
    return F.when(F.length(plain) > 0, F.split(plain, r"[\x20\x09-\x0D]+")).otherwise(F.array().cast("array<string>"))


def _span(mask: tuple[int, ...]) -> int:
    return mask[-1] + 1


def _keys(hashes: Column, n: Column, number: int, mask: tuple[int, ...]) -> Column:
    """The mask's hash at every place of a row of word hashes."""
    keys = F.transform(
        F.sequence(F.lit(0), n - _span(mask)), lambda i: F.xxhash64(F.lit(number), *[F.get(hashes, i + o) for o in mask])
    )
    return F.when(n >= _span(mask), keys).otherwise(F.array().cast("array<bigint>"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), 0)


def _stretch(item: Column, text: Column, shift: Column) -> Column:
    """The stretch of the aligned words with the most like words of all that are alike enough.

    Struct (first, last, alike): places in the text, the last exclusive; null
    without a like word. Of several the first.
    """
    low = F.greatest(F.lit(0), -shift)
    high = F.least(F.size(item), F.size(text) - shift)
    like = F.filter(F.sequence(low, high - 1), lambda j: F.get(item, j) == F.get(text, j + shift))

    # From like word u to v, alike = v - u + 1 and length = like[v] - like[u] + 1. With
    # f(u) = 100 u - SHARE like[u] it is alike enough when f(u) <= f(v) + 100 - SHARE.
    def longest(like: Column) -> Column:
        f = F.transform(like, lambda q, u: u * 100 - q * SHARE)
        return _let(f, lambda f: _let(
            F.struct(
                F.transform(f, lambda x, u: F.array_min(F.slice(f, 1, u + 1))).alias("least"),
                F.transform(f, lambda x, v: F.array_max(F.slice(f, v + 1, F.size(f) - v))).alias("most"),
            ),
            lambda m: walk(like, m["least"], m["most"]),
        ))

    # Both only fall: while some start up to u fits some end from v on, v moves, else u.
    def walk(like: Column, least: Column, most: Column) -> Column:
        def step(acc: Column, _: Column) -> Column:
            fits = F.get(least, acc["u"]) <= F.get(most, acc["v"]) + (100 - SHARE)
            alike = acc["v"] - acc["u"] + 1
            more = fits & (alike > acc["alike"])
            return F.struct(
                F.when(fits, acc["u"]).otherwise(acc["u"] + 1).alias("u"),
                F.when(fits, acc["v"] + 1).otherwise(acc["v"]).alias("v"),
                F.when(more, alike).otherwise(acc["alike"]).alias("alike"),
                F.when(more, acc["u"]).otherwise(acc["from"]).alias("from"),
            )

        start = F.struct(*[F.lit(0).alias(c) for c in ("u", "v", "alike", "from")])
        return F.aggregate(F.sequence(F.lit(1), F.size(like) * 2), start, step, lambda acc: F.struct(
            (F.get(like, acc["from"]) + shift).alias("first"),
            (F.get(like, acc["from"] + acc["alike"] - 1) + shift + 1).alias("last"),
            acc["alike"].alias("alike"),
        ))

    return _let(like, lambda like: F.when(F.size(like) > 0, longest(like)))


def leaks(
    docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text"
) -> DataFrame:
    """(text_hash, item, first, last, alike): stretches of texts that repeat an item.

    One row per text, item and alignment, with its longest stretch; ``text_hash`` is xxhash64 of the text.
    """
    items = materialize(
        benchmark.select(
            F.coalesce(F.col(item_col).cast("bigint"), F.lit(-1)).alias("item"), words(F.col(item_text_col)).alias("item_words")
        )
        .where(F.size("item_words") >= SHORTEST)
        .distinct()
        .withColumn("item_key", F.xxhash64("item", "item_words")),
        "items",
    )
    five = bool(items.where(F.size("item_words") == SHORTEST).head(1))
    masks = [*MASKS, *(FIVE if five else ())]
    need = F.lit(LEAST_HITS)
    for size, least in HITS.items():
        need = F.when(F.size("item_words") == size, least).otherwise(need)
    hashed = items.select("item_key", F.transform("item_words", lambda x: F.xxhash64(x)).alias("h"), need.alias("need"))
    keys = None
    for number, mask in enumerate(masks):
        part = (hashed if number < len(MASKS) else hashed.where(F.size("h") == SHORTEST)).select(
            "item_key",
            "need",
            F.lit(number).alias("mask"),
            F.posexplode(_keys(F.col("h"), F.size("h"), number, mask)).alias("item_at", "key"),
        )
        keys = part if keys is None else keys.unionByName(part)
    keys = materialize(keys, "keys")
    few = keys.count() <= BROADCAST_ROWS
    texts = docs.select(F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"), F.col(text_col).cast("string").alias("text"))
    rows = texts.select("text_hash", F.transform(words(F.col("text")), lambda x: F.xxhash64(x)).alias("h")).select("text_hash", "h", F.size("h").alias("n"))
    places = rows.select("text_hash", "n", F.posexplode(F.concat(*[_keys(F.col("h"), F.col("n"), k, m) for k, m in enumerate(masks)])).alias("at", "key"))
    # The masks' places follow each other: take off those of the masks before.
    before, offset = F.lit(0), F.lit(None).cast("int")
    for number, mask in enumerate(masks):
        offset = F.when(F.col("mask") == number, before).otherwise(offset)
        before = before + F.greatest(F.lit(0), F.col("n") - (_span(mask) - 1))
    hits = (
        places.join(F.broadcast(keys) if few else keys, "key")
        .groupBy("text_hash", "item_key", (F.col("at") - offset - F.col("item_at")).alias("shift"))
        .agg(F.count("*").alias("hits"), F.first("need").alias("need"))
        .where("hits >= need")
        .select("text_hash", "item_key", "shift")
    )
    hits = materialize(hits, "hits")
    hit_texts = hits.select("text_hash").distinct()
    found = hit_texts.count() <= BROADCAST_ROWS
    # One copy of each text is enough: copies have one hash.
    chosen = (
        texts.join(F.broadcast(hit_texts) if found else hit_texts, "text_hash", "left_semi")
        .groupBy("text_hash").agg(F.first("text").alias("text"))
        .select("text_hash", words(F.col("text")).alias("text_words"))
    )
    return (
        hits.join(items, "item_key")
        .join(chosen, "text_hash")
        .select("text_hash", "item", F.size("item_words").alias("size"), _stretch(F.col("item_words"), F.col("text_words"), F.col("shift")).alias("s"))
        .where(F.col("s.alike") >= F.least(F.lit(OVERLAP), F.ceil(F.col("size") * SHARE / 100)))
        .select("text_hash", "item", "s.first", "s.last", "s.alike")
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per input row: ``id_col``, ``text_hash``, ``contaminated``, ``items`` and ``spans``.

    ``spans`` holds (item, first, last, alike): words ``first`` to ``last`` of
    the text, ``alike`` of which equal the item's. A passage counts from 13
    like words on, or from 80 % of a shorter item, and 80 % of the stretch.

    Null and empty texts and items match nothing, nor do items of fewer than
    five words; items without an id are item -1. Null ids and repeated rows are
    kept; other columns are not read; empty tables give no match or no rows.
    """
    found = (
        leaks(docs, benchmark, text_col=text_col, item_col=item_col, item_text_col=item_text_col)
        .groupBy("text_hash", "item")
        .agg(F.max(F.struct("alike", "first", "last")).alias("b"))
        .groupBy("text_hash")
        .agg(F.sort_array(F.collect_list(F.struct("item", F.col("b.first").alias("first"), F.col("b.last").alias("last"), F.col("b.alike").alias("alike")))).alias("spans"))
    )
    found = materialize(found, "found")  # stored, so that the copies of one text can be split
    rows = docs.select(F.col(id_col), F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"))
    spans = F.coalesce("spans", F.array().cast("array<struct<item:bigint,first:int,last:int,alike:int>>"))
    return (
        rows.join(found, "text_hash", "left")
        .select(F.col(id_col), "text_hash", spans.alias("spans"))
        .select(id_col, "text_hash", (F.size("spans") > 0).alias("contaminated"), F.transform("spans", lambda s: s["item"]).alias("items"), "spans")
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", **columns) -> DataFrame:
    """The rows of ``docs`` that ``contamination`` does not flag, with all their columns.

    Null and empty texts and all rows of an empty benchmark's corpus stay;
    repeated rows stay or go together; columns may have any names.
    """
    own = free_name(docs.columns, "leaked_hash")
    bad = leaks(docs, benchmark, text_col=text_col, **columns).select(F.col("text_hash").alias(own)).distinct()
    bad = materialize(bad, "contaminated")
    few = bad.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(bad) if few else bad, F.xxhash64(docs[text_col].cast("string")) == bad[own], "left_anti")

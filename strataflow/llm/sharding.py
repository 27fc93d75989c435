"""Shards of bounded size by extendible hashing.

The directory is indexed by the leading bits of a key's hash. It starts as one
bucket; a bucket over the byte limit is split on one more bit, the others stay.
Only histograms of hash prefixes are worked on, never the texts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.session import materialize

BITS = 60  # of the hash
BLOCK = 12  # bits of directory that one histogram covers


def key_hash(key: Column) -> Column:
    """The first 60 bits of the key's MD5; a null key counts as empty."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, BITS // 4), 16, 10).cast("bigint")


def _split(rows: DataFrame, first: int, limit: int) -> DataFrame:
    """For each prefix of ``first + BLOCK`` bits: the depth of its bucket, that bucket's
    bytes and rows; null depth where more bits are needed. ``rows`` has h and bytes."""
    last = first + BLOCK
    fine = rows.groupBy(F.shiftright("h", BITS - last).alias("fine")).agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("n")
    )
    at = fine.select("*", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("depth")).withColumn(
        "prefix", F.expr(f"shiftright(fine, {last} - depth)")
    )
    fits = (
        at.groupBy("depth", "prefix")
        .agg(F.sum("bytes").alias("bucket_bytes"), F.sum("n").alias("bucket_rows"))
        .where((F.col("bucket_bytes") <= limit) | (F.col("bucket_rows") == 1))
    )
    return (
        at.join(fits, ["depth", "prefix"], "left")
        .groupBy("fine")
        .agg(
            F.min(
                F.when(F.col("bucket_bytes").isNotNull(), F.struct("depth", "bucket_bytes", "bucket_rows"))
            ).alias("bucket")
        )
    )


def _assign(rows: DataFrame, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Rows with their bucket, and those that all bits together leave in one oversized bucket."""
    done = []
    for first in range(0, BITS, BLOCK):
        last = first + BLOCK
        directory = materialize(_split(rows, first, limit), "directory")
        found = rows.withColumn("fine", F.shiftright("h", BITS - last)).join(directory, "fine")
        bits = F.expr(f"if(bucket.depth = 0, '', lpad(bin(shiftright(h, {BITS} - bucket.depth)), bucket.depth, '0'))")
        done.append(
            found.where("bucket.depth is not null").select(
                "row",
                bits.alias("shard"),
                F.col("bucket.depth").alias("depth"),
                F.col("bucket.bucket_bytes").alias("shard_bytes"),
                F.col("bucket.bucket_rows").alias("shard_rows"),
            )
        )
        if directory.where("bucket.depth is null").isEmpty():
            return reduce(DataFrame.unionByName, done), None
        rows = found.where("bucket.depth is null").drop("fine", "bucket")
    return reduce(DataFrame.unionByName, done), rows


def shards(df: DataFrame, limit: int, *, key_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``key_col``, ``shard``, ``depth``, ``shard_bytes``, ``shard_rows``.

    ``shard`` is the bit string of the bucket. No shard has more than ``limit``
    bytes of UTF-8 text, but for a single row that is larger by itself, which
    gets a shard of its own. Null and empty texts have no bytes; a null key
    counts as the empty one. Rows that share a key hash to one bucket; if they
    are too large together, they go on to be split by a number of the row
    (``~`` in the shard's name), so that no key is too hot. An empty table has
    no shards. Other columns are not read.
    """
    rows = materialize(
        df.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(key_col).alias("key"),
            key_hash(F.col(key_col)).alias("h"),
            F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)).cast("bigint").alias("bytes"),
        ),
        "shards",
    )
    placed, left = _assign(rows.select("row", "h", "bytes"), limit)
    if left is not None:
        # One key's rows: deal them out by row number, in as many parts as their bytes ask for.
        whole = F.expr(f"lpad(bin(h), {BITS}, '0')")
        sizes = left.groupBy("h").agg(F.sum("bytes").alias("all"), F.max("bytes").alias("most"))
        parts = left.join(sizes, "h").select(
            "row",
            F.concat(whole, F.lit("~"), F.pmod(key_hash(F.col("row")), F.ceil(F.col("all") / limit * 2)).cast("string")).alias("part"),
            "bytes",
        )
        overflow = _pages(materialize(parts, "overflow"), limit)
        placed = placed.unionByName(overflow)
    return rows.select("row", F.col("key").alias(key_col)).join(placed, "row").drop("row")


def _pages(parts: DataFrame, limit: int) -> DataFrame:
    """Cut each part (about half a limit of bytes) where its running sum passes the limit."""
    order = Window.partitionBy("part").orderBy("row")
    before = F.sum("bytes").over(order) - F.col("bytes")
    # Two rows of one page start less than half a limit apart, and large rows stand alone.
    page = F.when(F.col("bytes") * 2 > limit, F.concat(F.lit("r"), F.col("row").cast("string"))).otherwise(
        F.floor(before * 2 / limit).cast("string")
    )
    named = parts.withColumn("shard", F.concat("part", F.lit("."), page))
    total = Window.partitionBy("shard")
    return named.select(
        "row",
        "shard",
        F.lit(BITS).alias("depth"),
        F.sum("bytes").over(total).alias("shard_bytes"),
        F.count("*").over(total).alias("shard_rows"),
    )


def write_shards(df: DataFrame, path: str, limit: int, *, key_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``df`` to Parquet, a folder per shard (``_shard=b`` and its bits); keys must be unique and not null."""
    placed = shards(df, limit, key_col=key_col, text_col=text_col).select(key_col, F.concat(F.lit("b"), "shard").alias("_shard"))
    df.join(placed, key_col).repartition("_shard").write.partitionBy("_shard").parquet(path)

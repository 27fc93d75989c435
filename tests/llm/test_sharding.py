"""Extendible hashing against a bucket-by-bucket brute force, and against SQL."""

import hashlib

from pyspark.sql import functions as F

from oracle_check import compare, connect
from strataflow.llm.queries import ORACLE, QUERIES
from strataflow.llm.sharding import shards, write_shards

SF = "/root/testdata/sf0.01"


def _brute(sizes, limit):
    """Directory of one bucket; split what is over the limit until nothing is."""
    bits = {k: format(int(hashlib.md5(str(k).encode()).hexdigest()[:15], 16), "060b") for k in sizes}
    todo, done = [("", list(sizes))], {}
    while todo:
        prefix, keys = todo.pop()
        if len(keys) <= 1 or sum(sizes[k] for k in keys) <= limit:
            done.update({k: prefix for k in keys})
            continue
        for bit in "01":
            todo.append((prefix + bit, [k for k in keys if bits[k].startswith(prefix + bit)]))
    return done


def test_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = {r.doc_id: len(r.text.encode()) for r in docs.collect()}
    for limit in (3000, 40_000):
        got = {r.doc_id: r.shard for r in shards(docs, limit).collect()}
        assert got == _brute(sizes, limit)


def test_query_equals_sql(spark):
    name = "op4_extendible_sharding"
    assert compare(spark, connect(SF), SF, name, QUERIES[name], ORACLE[name]) is None


def test_hot_key_nulls_and_clashing_columns(spark):
    rows = [(7, "x" * 100)] * 300 + [(None, None), (None, "ab"), (1, ""), (2, "y" * 5000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit(1)).withColumn("h", F.lit("z"))
    got = shards(df, 1000).collect()
    assert len(got) == len(rows)
    total, count = {}, {}
    for r in got:
        size = {7: 100, 2: 5000, 1: 0, None: 2}[r.doc_id] if r.doc_id is not None else 0
        total[r.shard] = total.get(r.shard, 0) + size
        count[r.shard] = count.get(r.shard, 0) + 1
    assert all(v <= 1000 or count[k] == 1 for k, v in total.items())
    assert all(r.shard_rows == count[r.shard] for r in got)
    assert shards(df.limit(0), 1000).count() == 0


def test_written_shards_hold_all_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    write_shards(docs, str(tmp_path / "out"), 300_000)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == docs.count()
    assert back.groupBy("_shard").agg(F.sum(F.octet_length("text")).alias("b")).where("b > 300000").isEmpty()


def test_query_splits_a_small_corpus(spark, tmp_path):
    """The query's limit lets three megabytes fall into several shards."""
    rows = [(k, "x" * 100_000) for k in range(30)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op4_extendible_sharding"](spark, str(tmp_path)).collect()
    assert len(got) == 30 and len({r.shard for r in got}) > 2
    assert all(r.shard_bytes <= 1 << 20 for r in got)

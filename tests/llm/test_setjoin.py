"""The grouped prefix join against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from strataflow.llm.components import components
from strataflow.llm.queries import QUERIES
from strataflow.llm.setjoin import keep_one, similar_sets

_FOLD = bytes(range(256)).replace(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def _set(text, size):
    w = (text or "").encode().translate(_FOLD).split()
    return {tuple(w[k : k + size]) for k in range(len(w) - size + 1)} or ({tuple(w)} if w else set())


def _brute(docs, size, num, den):
    sets = [(i, _set(t, size)) for i, t in docs]
    parent = list(range(len(sets)))

    def find(k):
        while parent[k] != k:
            parent[k] = k = parent[parent[k]]
        return k

    where = {}
    for k, (i, s) in enumerate(sets):
        if i is not None:
            for x in s:
                where.setdefault(x, []).append(k)
    for k, (i, s) in enumerate(sets):
        common = {}
        for x in s if i is not None else ():
            for j in where[x]:
                if j < k:
                    common[j] = common.get(j, 0) + 1
        for j, c in common.items():
            if den * c >= num * (len(s) + len(sets[j][1]) - c):
                parent[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least[find(k)] if i is not None else None) for k, (i, s) in enumerate(sets)), key=repr)


def _got(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in frame.collect()), key=repr)


def test_query_over_the_whole_table(spark):
    path = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    expected = _brute(docs, 3, 90, 100)
    assert _got(QUERIES["op2_grouped_prefix_join"](spark, path)) == expected
    assert any(i != c for i, _, c in expected)


@pytest.mark.parametrize("similarity", [(90, 100), (80, 100), (1, 2)])
def test_near_copies_chains_and_common_words(spark, similarity):
    rng = random.Random(similarity[0])
    base = [[rng.choice("abcdefghijklmnopqrstuvwxyz") + rng.choice("abc") for _ in range(n)] for n in (3, 8, 25, 60, 60)]
    docs = []
    for i in range(260):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = rng.choice(["x", "y", f"u{rng.randrange(40)}"])
        docs.append((i, " ".join(w[: rng.randrange(len(w) - 2, len(w) + 1)])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert _got(similar_sets(df, 2, similarity)) == _brute(docs, 2, *similarity)


def test_cases(spark):
    docs = [(1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "one"), (None, "one two"), (7, "É two three"), (8, "é two three"),
            (9, "a b c d"), (9, "x y z w"), (3, "x y z w"), (9, "a b c d"), (10, "long " * 60_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("sid", F.lit(0))
    assert _got(similar_sets(df, 3, (90, 100))) == _brute(docs, 3, 90, 100)
    assert similar_sets(df.limit(0), 3, (90, 100)).count() == 0


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


def test_keep_one_tells_rows_apart_that_share_an_id(spark):
    plain = [f"text number {k} about {' '.join(f'thing{k}x{j}' for j in range(12))}" for k in range(6)]
    near = plain[0] + " thing0x12"
    rows = [(1, plain[0]), (1, plain[1]), (2, plain[2]), (2, near), (3, plain[1]), (4, plain[3]), (4, plain[3]), (None, plain[0]), (5, None), (5, ""), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for clash in ("row", "_many", "_first", "gone", "number", "class", "id", "sid"):
        df = df.withColumn(clash, F.lit("x"))
    got = keep_one(df, 5, (80, 100))
    assert got.columns == df.columns
    kept = sorted(((r.doc_id, r.text) for r in got.collect()), key=repr)
    expected = [(1, plain[0]), (1, plain[1]), (2, plain[2]), (4, plain[3]), (None, plain[0]), (5, None), (5, ""), (5, None)]
    assert kept == sorted(expected, key=repr)
    unique = df.where("doc_id in (2, 3) and text <> ''").withColumn("doc_id", F.monotonically_increasing_id())
    assert keep_one(unique, 5, (80, 100)).columns == df.columns and keep_one(df.limit(0)).count() == 0


def test_links_through_shared_ids_are_not_lost(spark):
    rng = random.Random(8)
    base = [" ".join(f"w{rng.randrange(400)}" for _ in range(40)) for _ in range(12)]
    docs = []
    for k in range(150):
        words = rng.choice(base).split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(40)] = f"n{rng.randrange(30)}"
        docs.append((rng.randrange(40), " ".join(words)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert _got(similar_sets(df, 3, (60, 100))) == _brute(docs, 3, 60, 100)


def test_ids_that_are_no_integers_are_refused(spark):
    with pytest.raises(TypeError):
        similar_sets(spark.createDataFrame([("a", "x y z")], "doc_id string, text string"))

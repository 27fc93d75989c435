"""Repeated passages against a dictionary of all windows."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm.queries import QUERIES
from strataflow.llm.repeats import Tree, remove_repeats, word_codes
from strataflow.llm.text import mix


def _brute(docs, size):
    """``docs``: (id, text) rows; gives (id, words, removed, kept) rows."""
    words = [(i, (t or "").encode().split()) for i, t in docs]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - size + 1):
                window = tuple(w[k : k + size])
                first[window] = min(first.get(window, i), i)
    out = []
    for i, w in words:
        gone = set()
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k : k + size])] < i:
                gone.update(range(k, k + size))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return out


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_over_the_whole_table(spark, sf):
    path = f"/root/testdata/sf{sf}"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{path}/documents.parquet").collect()]
    expected = sorted((i, n, m, hashlib.sha256(k.encode()).hexdigest()) for i, n, m, k in _brute(docs, 13))
    got = sorted((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in QUERIES["op3_suffix_repeats"](spark, path).collect())
    assert got == expected
    assert sum(m for _, _, m, _ in got) > 0


@pytest.mark.parametrize("group", [3, 50, 10_000])
def test_common_prefixes_are_split(spark, group):
    rng = random.Random(group)
    line = " ".join(rng.choice("abcdefgh") for _ in range(20))
    docs = [(i, " ".join(rng.choice("ab") for _ in range(rng.randrange(60))) + " " + line * rng.randrange(2)) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in remove_repeats(df, 6, group=group).collect()]
    assert sorted(got) == sorted(_brute(docs, 6))


def test_cases(spark):
    text = " ".join(f"w{k}" for k in range(30))
    docs = [(5, text), (5, text), (5, "x " + text), (2, None), (3, ""), (None, text), (None, text), (9, text.replace(" ", "\n\t")), (1, "a b"),
            (7, "z" * 300_000 + " " + text)]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("spans", F.lit(0))
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in remove_repeats(df, 13).collect()]
    assert sorted(got, key=repr) == sorted(_brute(docs, 13), key=repr)
    assert remove_repeats(df.limit(0), 13).count() == 0


def _shared(a, b):
    return next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("step", [1, -1])
def test_tree_nodes_are_common_prefixes(step):
    rng = np.random.default_rng(step + 5)
    codes = word_codes(mix(rng.integers(1, 3, 400).astype(np.uint64)))
    lengths = rng.integers(0, 9, 120)
    starts = rng.integers(10, 390, 120)
    tree = Tree(codes, starts, lengths, 8, step)
    read = [[codes[s + step * j].tobytes() for j in range(n)] for s, n in zip(starts, lengths)]
    for depth in range(9):
        node = tree.nodes(depth)
        long = np.flatnonzero(lengths >= depth)
        for i in long:
            assert [node[i] == node[j] for j in long] == [_shared(read[i], read[j]) >= depth for j in long]


@pytest.mark.parametrize("size", [1, 3, 4, 5, 13])
def test_windows_of_a_smaller_id(spark, size):
    rng = random.Random(size)
    base = [rng.choice("abcdefghijkl") for _ in range(40)]
    docs = []
    for i in range(60):  # copies with a word replaced here and there
        copy = [w if rng.random() > 0.05 else rng.choice("xyz") for w in base[rng.randrange(10) : rng.randrange(15, 41)]]
        docs.append((rng.randrange(40), " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.n_words, r.n_removed, r.kept) for r in remove_repeats(df, size).collect()]
    assert sorted(got) == sorted(_brute(docs, size))

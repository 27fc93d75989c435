"""FP-tree search against SQL, and against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_check import compare, connect
from strataflow.llm import lexical
from strataflow.llm.lexical import FPTree, Items, rank_documents, terms
from strataflow.llm.queries import ORACLE, QUERIES


def _terms(text):
    fold = {c: chr(ord(c) + 32) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
    return re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(fold.get(c, c) for c in text or ""))


def _brute(docs, items, k):
    counted = [(i, Counter(_terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    N, L = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        asked, scores = Counter(_terms(text)), []
        for i, c in counted:
            m = 100 - 25 + (25 * sum(c.values()) * N) // L
            score = sum(
                n * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                for t, n in asked.items() if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k], 1)]
    return sorted(out, key=repr)


def _got(frame):
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    name, path = "op13_fp_tree_search", f"/root/testdata/sf{sf}"
    assert compare(spark, connect(path), path, name, QUERIES[name], ORACLE[name]) is None


def test_terms():
    text = "Ab-c9_ÀÉ İx\x7fy\x80z 日本 語 [q]{r}@`"
    assert terms(text) == _terms(text) == ["ab", "c9", "ÀÉ", "İx", "y\x80z", "日本 語", "q", "r"]
    assert terms(None) == terms("- \n") == []


@pytest.mark.parametrize("tree_postings, page, group", [(1 << 20, 64, 256), (40, 2, 3), (300, 8, 5)])
def test_equals_all_scores(spark, monkeypatch, tree_postings, page, group):
    for name, value in (("TREE_POSTINGS", tree_postings), ("PAGE", page), ("ITEM_GROUP", group)):
        monkeypatch.setattr(lexical, name, value)
    rng = random.Random(page)
    words = [f"w{int(rng.paretovariate(0.6)) % 150}" for _ in range(4000)]
    docs = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 60)))) for i in range(400)]
    docs += [(1000 + i, docs[7][1]) for i in range(150)] + [(5, "again w1"), (5, "again w1"), (None, docs[7][1]), (None, None), (2000, "w1 " * 30_000)]
    rng.shuffle(docs)
    items = [(i, " ".join(rng.choices(words, k=rng.randrange(1, 25)))) for i in range(12)] + [(90, docs[7][1])]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    asked = spark.createDataFrame(items, "item_id long, text string")
    expected = _brute(docs, items, 20)
    assert _got(rank_documents(df, asked)) == expected
    assert _got(rank_documents(df, asked, item_bytes=200)) == expected  # several passes


def test_trees_share_paths_and_leave_out_what_cannot_win():
    rng = np.random.default_rng(2)
    n, vocabulary = 3000, 60
    rows = [np.flatnonzero(rng.random(vocabulary) < 1 / (1 + np.arange(vocabulary) / 3)) for _ in range(n)]
    start = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    term, tf = np.concatenate(rows), rng.integers(1, 6, start[-1])
    m = rng.integers(76, 300, n)
    tree = FPTree(start, term, tf, m)
    assert sorted(tree.order) == list(range(n))
    seen, todo = [], [tree.root]
    while todo:
        node = todo.pop()
        held = [(set(rows[i]), i) for i in tree.order[node.lo : node.hi]]
        assert set(node.terms) == set().union(*(t for t, _ in held)) and node.least == min(m[i] for _, i in held)
        for t, most in zip(node.terms, node.most):
            assert most == max(tf[start[i] + np.searchsorted(rows[i], t)] for s, i in held if t in s)
        if node.children:
            assert [c.lo for c in node.children] + [node.hi] == [node.lo] + [c.hi for c in node.children]
            todo += node.children
        else:
            seen += range(node.lo, node.hi)
            assert node.hi - node.lo <= lexical.PAGE
    assert sorted(seen) == list(range(n))
    weight = 100 + 200 * np.arange(vocabulary)
    item = np.array([0, 0, 1, 1, 1])
    asked = np.array([55, 58, 3, 40, 59])
    items = Items(2, asked, item, np.array([1, 2, 1, 1, 1]), weight, 5)
    items.add(tree, np.arange(n))
    for j in range(2):
        scores = np.zeros(n, np.int64)
        for t, c in zip(asked[item == j], np.array([1, 2, 1, 1, 1])[item == j]):
            for i in range(n):
                at = np.flatnonzero(rows[i] == t)
                if len(at):
                    x = int(tf[start[i] + at[0]])
                    scores[i] += c * weight[t] * ((1000000000 * x) // (1000 * x + 12 * int(m[i])))
        best = np.lexsort((np.arange(n), -scores))[:5]
        assert items.score[j].tolist() == scores[best].tolist() and items.row[j].tolist() == best.tolist()
    assert items.scored < 2 * n


def test_subtrees_that_cannot_win_are_not_scored():
    rng = np.random.default_rng(3)
    topics = [np.sort(rng.choice(np.arange(200), 12, replace=False)) for _ in range(40)]
    rows = [topics[k % 40] for k in range(8000)]
    start, term = np.arange(0, 12 * 8000 + 1, 12), np.concatenate(rows)
    tree = FPTree(start, term, rng.integers(1, 4, len(term)), rng.integers(76, 300, 8000))
    asked = np.unique(topics[7][:6])
    items = Items(1, asked, np.zeros(6, int), np.ones(6, int), np.full(200, 500), 20)
    items.add(tree, np.arange(8000))
    assert (items.row[0] % 40 == 7).all() and items.scored < 8000 / 4


def test_large_sums_are_exact():
    weight = np.array([1 << 25, 3])
    items = Items(1, np.array([0, 1]), np.array([0, 0]), np.array([1 << 14, 1]), weight, 2)
    assert items.kind is np.int64
    tree = FPTree(np.array([0, 2, 3]), np.array([0, 1, 0]), np.array([1, 1, 1]), np.array([100, 100]))
    items.add(tree, np.arange(2))
    part = 1000000000 // (1000 + 1200)
    assert items.score[0].tolist() == [((1 << 39) + 3) * part, (1 << 39) * part]


def test_cases(spark):
    docs = [(1, None), (2, ""), (3, "?!"), (4, "One two"), (4, "one TWO"), (None, "one two"), (6, "É three"), (7, "é three"), (8, "x " * 100_000 + "rare")]
    items = [(1, "one"), (1, "one"), (1, "two three"), (None, "rare É"), (3, None), (4, ""), (5, "unknown words"), (6, "x x rare x")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    for clash in ("id", "item", "score", "rank", "salt", "name", "n", "terms"):
        df, asked = df.withColumn(clash, F.lit("x")), asked.withColumn(clash, F.lit("x"))
    assert _got(rank_documents(df, asked)) == _brute(docs, items, 20)
    for a, b in ((df.limit(0), asked), (df, asked.limit(0)), (df, asked.where("item_id in (3, 4)"))):
        assert rank_documents(a, b).count() == 0
    named = df.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    got = rank_documents(named, asked.where("item_id = 6")).collect()
    assert [(r["rank"], r.doc_id) for r in got] == [(1, "d8")]

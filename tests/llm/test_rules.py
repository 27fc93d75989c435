"""Decision lists: counts against a brute force, learning on made rules and on labels held back, and cases."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strataflow.llm import rules
from strataflow.llm.queries import QUERIES

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _brute(text):
    t = text or ""
    w = _WORD.findall(t)
    lines = [x for x in t.split("\n") if _WORD.search(x)]
    windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    often = Counter(windows)
    repeated = {k + j for k, x in enumerate(windows) if often[x] > 1 for j in range(3)}
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
        "n_chars": len(t), "n_capitals": sum("A" <= c <= "Z" for c in t), "n_digits": sum("0" <= c <= "9" for c in t),
        "n_shouts": sum(c in "!?" for c in t), "n_lines": len(lines), "n_distinct": len(set(w)), "n_again": sum(a == b for a, b in zip(w, w[1:])),
    }


def _base_failed(m):
    return m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]


def test_counts_of_odd_texts():
    texts = ["", None, "  \n\n", "a b c a b c", "x\nx \nx\n x\r\n x\r\n\n\nx", "é ü é ü # <é>", "a a a a", "a b", "a\vb\fc\td",
             "tail\n", "  l l", "w " * 70_000 + "\n" + "z" * 600_000 + "\nq" * 3]
    got = rules.measures(pa.array([t or "" for t in texts], pa.large_string()))
    assert set(got) == set(rules.COUNTS)
    assert [{c: int(got[c][k]) for c in rules.COUNTS} for k in range(len(texts))] == [{c: _brute(t)[c] for c in rules.COUNTS} for t in texts]


def test_query_over_the_whole_table(spark):
    path = "/root/testdata/sf0.01"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = QUERIES["op12_decision_list"](spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        m = _brute(docs[r.doc_id])
        assert {c: r[c] for c in rules.COUNTS[:5]} == {c: m[c] for c in rules.COUNTS[:5]}
        assert r.base_failed == _base_failed(m) and not (r.base_failed and r.kept)
        assert r.base_failed == (r.rule is None)


def test_labels_held_back(spark):
    path = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string")) % 2
    found = rules.judge(docs, labels.where(half == 0)).join(labels.where(half == 1), "doc_id").where("not base_failed")
    table = {(r.quality, r.kept): r["count"] for r in found.groupBy("quality", "kept").count().collect()}
    good, bad = (table.get((q, True), 0) + table.get((q, False), 0) for q in (1, 0))
    assert good > 1000 and table.get((1, False), 0) / good < 0.005
    assert bad > 100 and table.get((0, False), 0) / bad > 0.95


def test_best_threshold_is_the_best_of_all():
    rng = np.random.default_rng(4)
    for _ in range(30):
        x, t = rng.integers(0, 6, (25, 3)) / 4, rng.random(25) < 0.4
        if not t.any() or t.all():
            continue
        best = 0.0
        for j in range(3):
            for bound in np.unique(x[:, j]):
                for rows in (x[:, j] <= bound, x[:, j] > bound):
                    if t[rows].any():
                        best = max(best, t[rows].sum() * (np.log2(t[rows].mean()) - np.log2(t.mean())))
        found = rules._best_test(x, t, ["a", "b", "c"])
        assert (found is None and best < 1e-9) or abs(found[0] - best) < 1e-6


def test_learns_conjunctions_in_order_and_survives_noise(spark):
    rng = np.random.default_rng(5)
    names = ["symbol_share", "digit_share", "word_length"]
    x = rng.random((6000, 3))
    bad = ((x[:, 0] > 0.8) & (x[:, 1] <= 0.6)) | ((x[:, 2] <= 0.1) & (x[:, 1] > 0.7))
    noisy = bad ^ (rng.random(len(bad)) < 0.02)
    found = rules.learn(x, ~noisy, names)
    fresh = rng.random((3000, 3))
    truth = ((fresh[:, 0] > 0.8) & (fresh[:, 1] <= 0.6)) | ((fresh[:, 2] <= 0.1) & (fresh[:, 1] > 0.7))
    df = spark.createDataFrame([(k, *map(float, v)) for k, v in enumerate(fresh)], ["k", *names])
    got = {r.k: (r.good, r.which) for r in df.select("k", found.verdict().alias("good"), found.which().alias("which")).collect()}
    assert np.mean([got[k][0] != t for k, t in enumerate(truth)]) > 0.97
    # The expression asks the rules in their order.
    for k, v in enumerate(fresh):
        hits = [i for i, r in enumerate(found.rules, 1) if all(t.holds(v[names.index(t.feature)]) for t in r.tests)]
        assert got[k][1] == (hits[0] if hits else 0)
        assert got[k][0] == (found.rules[hits[0] - 1].good if hits else True)
    assert all(1 <= len(r.tests) <= rules.MAX_TESTS for r in found.rules) and str(found).startswith("CASE")


def test_an_exception_comes_before_the_rule_it_limits():
    rng = np.random.default_rng(6)
    x = np.column_stack([rng.random(4000), np.zeros(4000)])
    x[:, 1] = rng.integers(0, 2, 4000)
    bad = (x[:, 0] > 0.5) & ~((x[:, 0] > 0.7) & (x[:, 0] <= 0.75))
    found = rules.learn(x, ~bad, ["symbol_share", "digit_share"])
    covered = lambda v: next((r.good for r in found.rules if all(t.holds(v[["symbol_share", "digit_share"].index(t.feature)]) for t in r.tests)), True)
    assert np.mean([covered(v) == (not b) for v, b in zip(x, bad)]) > 0.98


def test_nothing_to_learn_from():
    assert rules.learn(np.zeros((0, 2)), np.zeros(0, bool), ["a", "b"]).rules == ()
    assert rules.learn(np.random.default_rng(1).random((50, 2)), np.ones(50, bool), ["a", "b"]).rules == ()
    same = rules.learn(np.zeros((60, 2)), np.arange(60) % 2 == 0, ["a", "b"])
    assert same.rules == ()


def test_cases(spark):
    plain = " ".join(f"word{k}" for k in range(60))
    junk = " ".join(f"#{k}$%" for k in range(60))
    docs = [(k, plain.replace("word", f"w{k}x")) for k in range(40)] + [(100 + k, junk.replace("#", f"#{k}")) for k in range(40)]
    docs += [(None, junk), (None, plain), (1, junk), (500, None), (501, ""), (502, "a b c " * 50_000), (503, junk * 2000), (503, junk * 2000)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for clash in ("id", "n_words", "kept", "rule", "quality", "symbol_share", "_id"):
        df = df.withColumn(clash, F.lit("x"))
    labels = [(k, 1, 0) for k in range(2, 40)] + [(100 + k, 0, 0) for k in range(40)] + [(2, 0, 0), (None, 0, 0), (3, None, 0), (4, 7, 0), (900, 0, 0)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("symbol_share", F.lit(0.9))
    got = rules.judge(df, marks)
    rows = got.collect()
    assert len(rows) == len(docs) and got.columns == ["doc_id", *rules.COUNTS, "base_failed", "kept", "rule"]
    texts = Counter((i, _base_failed(_brute(t)), not _base_failed(_brute(t)) and not (t or "").startswith("#")) for i, t in docs)
    assert Counter((r.doc_id, r.base_failed, r.kept) for r in rows) == texts
    alone = rules.judge(df, marks.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in alone)
    assert rules.judge(df.limit(0), marks).count() == 0


def test_the_sample_is_bounded_and_the_same_each_time(spark):
    stats = rules.measure(spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.repeat(F.lit("word "), 60), F.sequence(F.col("id"), F.col("id") + 40).cast("string")).alias("text")))
    labels = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("quality"))
    seen = []
    learn = rules.learn
    try:
        rules.learn = lambda x, good, names: seen.append((x.tolist(), good.tolist())) or learn(x, good, names)
        for rows in (50, 50, 10_000):
            rules.fit(stats, labels, rows=rows)
    finally:
        rules.learn = learn
    few = stats.where(~rules.base_failed()).count()
    assert seen[0] == seen[1] and len(seen[0][0]) == min(50, few) and len(seen[2][0]) == few

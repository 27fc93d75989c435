"""Weak labels: expectation-maximisation on made votes, measures by hand, and accuracy on held labels."""

import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strataflow.llm import quality
from strataflow.llm.quality import BAD, GOOD, LABELLERS, SILENT, _Texts, classify, estimate
from strataflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.1"


def test_estimate_finds_the_labellers_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(40_000) < 0.3
    right = (0.95, 0.9, 0.8, 0.7)
    votes = np.stack([np.where(rng.random(len(truth)) < p, truth, ~truth).astype(int) for p in right], 1)
    votes[rng.random(votes.shape) < 0.2] = SILENT
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, answers, share = estimate(patterns, counts.astype(float))
    assert abs(share - 0.3) < 0.03
    for k, p in enumerate(right):
        assert abs(answers[k, 1, BAD] - p) < 0.05 and abs(answers[k, 0, GOOD] - p) < 0.05
    best = {tuple(v): p > 0.5 for v, p in zip(patterns, posterior)}
    assert np.mean([best[tuple(v)] == t for v, t in zip(votes, truth)]) > 0.94


def test_measures_by_hand():
    text = "AB cd! cd! #x\nline\nline\nline"
    m = dict(zip((x[0] for x in LABELLERS), _Texts(pa.array(["", text, "é a"], pa.large_string())).measures()[1]))
    assert abs(m["symbols"] - 1 / len(text)) < 1e-9 and abs(m["symbol_words"] - 1 / 7) < 1e-9
    assert abs(m["shouts"] - 2 / 7) < 1e-9 and abs(m["repeats"] - 3 / 7) < 1e-9
    assert abs(m["same_lines"] - 2 / 4) < 1e-9 and abs(m["capitals"] - 2 / 19) < 1e-9
    assert abs(m["same_triples"] - 0) < 1e-9


def test_accuracy_on_labels_it_has_not_seen(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = QUERIES["op7_weak_label_quality"](spark, SF)
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    table = {(r.quality, r.rejected): r["count"] for r in got.join(labels, "doc_id").groupBy("quality", "rejected").count().collect()}
    assert table.get((1, True), 0) / (table[1, True] + table[1, False] if (1, True) in table else 1) < 0.005
    assert table[0, True] / (table[0, True] + table.get((0, False), 0)) > 0.95


def test_cases(spark):
    good = [(k, f"a plain line about topic {k} and nothing else to see here number {k * 7}") for k in range(40)]
    bad = [(100 + k, f"BUY!! NOW!! ### $$$ {k}!! BUY!! BUY!! BUY!!") for k in range(10)]
    rows = [*good, *bad, (None, "BUY!! NOW!! ### $$$!! BUY!! BUY!! BUY!!"), (500, None), (501, ""), (0, good[0][1]), (502, "word " * 60_000), (503, "\n\n")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("votes", F.lit("clash")).withColumn("score", F.lit(1))
    got = [(r.doc_id, r.rejected, r.posterior_bad) for r in classify(df).collect()]
    assert len(got) == len(rows)
    # 502, the only text of its kind, is left to what the labellers make of it.
    wrong = [(i, r) for i, r, _ in got if i != 502 and r != (i is None or 100 <= i < 200)]
    assert wrong == []
    assert classify(df.limit(0)).count() == 0


def test_training_holds_eight_bytes_a_feature():
    """The driver trains beside Spark: features and their counts are held in a few arrays of whole numbers."""
    rng = np.random.default_rng(1)
    texts = [rng.integers(0, quality.BUCKETS, 400).astype(np.int32) for _ in range(3000)]
    targets = rng.integers(0, 2, len(texts)).astype(float)
    tracemalloc.start()
    quality.LinearScorer.train(texts, targets, epochs=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 3 * 8 * quality.BUCKETS + 9 * sum(map(len, texts))


def test_training_weighs_repeated_features_by_their_share():
    texts = [np.array(t, np.int32) for t in ([1, 1, 1, 2], [2, 3], [], [7])]
    targets, rate = np.array([1.0, 0.0, 0.5, 0.25]), 1.0
    scorer = quality.LinearScorer.train(texts, targets, epochs=3, rate=rate)
    weights, total, bias, rng = np.zeros(quality.BUCKETS), np.full(quality.BUCKETS, 1e-4), 0.0, np.random.default_rng(3)
    for epoch in range(3):
        for i in rng.permutation(len(texts)):
            index, n = np.unique(texts[i], return_counts=True)
            x = n / max(1, len(texts[i]))
            wrong = 1 / (1 + np.exp(-np.clip(weights[index] @ x + bias, -50, 50))) - targets[i]
            total[index] += (wrong * x) ** 2
            weights[index] -= rate / (1 + epoch / 4) * wrong * x / np.sqrt(total[index])
            bias -= 0.02 * wrong
    assert np.array_equal(scorer.weights, weights) and scorer.bias == float(bias)

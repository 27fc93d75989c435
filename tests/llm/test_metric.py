"""M-tree search against all inner products, and against SQL."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from oracle_check import compare, connect
from strataflow.llm import metric
from strataflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.01"


def _brute(rows, is_query, k, scale=1024.0):
    good = {
        (i, tuple(math.floor(scale * x) for x in v))
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for q, x in good:
        if is_query(q):
            scored = sorted((-sum(a * b for a, b in zip(x, y)), i) for i, y in good if i != q)
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def _got(frame):
    return sorted((r.query_id, r["rank"], r.id, r.score) for r in frame.collect())


def test_query_equals_sql(spark):
    name = "op8_mtree_search"
    assert compare(spark, connect(SF), SF, name, QUERIES[name], ORACLE[name]) is None


def test_tree_equals_all_products_and_saves_some():
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 300, (40, 3))
    vectors = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(0, 5, (4000, 3)))
    tree = metric.MTree(vectors, float((vectors**2).sum(1).max()))
    for q in vectors[:40]:
        scores = (vectors @ q).astype(int)
        cut = np.sort(scores)[-5]
        assert sorted(tree.search(q, 5)) == sorted((int(s), i) for i, s in enumerate(scores) if s >= cut)
    assert tree.computed < 0.5 * 40 * 4000


@pytest.mark.parametrize("cell_rows, tree_rows", [(5000, 20_000), (20, 7)])
def test_small_cells_ties_and_copies(spark, monkeypatch, cell_rows, tree_rows):
    monkeypatch.setattr(metric, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(metric, "TREE_ROWS", tree_rows)
    monkeypatch.setattr(metric, "QUERY_ROWS", 9)
    rng = np.random.default_rng(cell_rows)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 3) / 2]) for i in range(150)] + [(200 + i, [1.0, 0.5, 0.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    assert _got(metric.top_inner_products(df, F.col("vec_id") % 10 == 0, 6)) == _brute(rows, lambda q: q % 10 == 0, 6)


def test_cases(spark):
    rows = [(0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 0.0]), (None, [5.0, 5.0]),
            (5, [0.5]), (6, []), (7, [3.0, 1.0]), (100, [-1.0, 0.00001])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("id", F.lit("clash")).withColumn("cell", F.lit("x"))
    assert _got(metric.top_inner_products(df, F.col("vec_id") % 100 == 0)) == _brute(rows, lambda q: q % 100 == 0, 10)
    assert metric.top_inner_products(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert metric.top_inner_products(df, F.col("vec_id") == 9).count() == 0


def test_large_components_are_exact_or_refused(spark):
    rows = [(0, [2.0**30, 1.0]), (1, [2.0**25 + 2, 3.0]), (2, [2.0**25, 2.0]), (3, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert _got(metric.top_inner_products(df, F.col("vec_id") == 3)) == _brute(rows, lambda q: q == 3, 10)
    tree = metric.MTree(np.array([[3.0, 1.0], [2.0, 1.0]]), 10.0)
    q = np.array([2.0**53, 1.0])
    assert sorted(tree.search(q, 2)) == sorted([(3 * 2**53 + 1, 0), (2 * 2**53 + 1, 1)])
    with pytest.raises(Exception, match="too large"):
        metric.top_inner_products(df.withColumn("embedding", F.array(F.lit(1e18), F.lit(0.0))), F.col("vec_id") == 0).collect()

"""The filter audit against SQL, and against removing documents one by one in every order."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from oracle_check import compare, connect
from strataflow.llm.audit import audit, lehmer_interval, orders, removal_edges
from strataflow.llm.queries import ORACLE, QUERIES

COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_SPACES = " \t\n\x0b\x0c\r"


def _words(text):
    out = "".join("\0" if c in _SPACES else c for c in text).split("\0")
    return [w for w in out if w]


def _brute(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    rows = []
    for i, text, lang in docs:
        t, w = text or "", _words(text or "")
        capitals = sum("A" <= c <= "Z" for c in t)
        fails = {k for k, bad in zip("ABCD", (len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * capitals > 3 * len(t), any(c in "#$%&*|" for c in t))) if bad}
        if i is not None and any(j is not None and j < i and (u or "") == t for j, u, _ in docs):
            fails.add("E")
        rows.append((lang or "", i, fails))
    out = {}
    for part in {p for p, _, _ in rows}:
        mine = [(i, f) for p, i, f in rows if p == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for step, k in enumerate(order, 1):
                hit = [(i, f) for i, f in left if k in f]
                again = sum(k in f for _, f in gone)
                left, gone = [x for x in left if k not in x[1]], gone + hit
                shapley[k] += len(hit)
                out[part, "".join(order), step] = [len(left), len(hit), again, sum(f == {k} for _, f in mine),
                                                   sum(i in good for i, _ in hit), sum(i in toxic for i, _ in hit), k]
        for at, row in out.items():
            if at[0] == part:
                row[-1] = shapley[row[-1]]
    return sorted((*at, *row) for at, row in out.items())


def _got(frame):
    return sorted(tuple(r) for r in frame.select(*COLUMNS).collect())


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query_equals_sql(spark, sf):
    name, path = "op11_filter_audit", f"/root/testdata/sf{sf}"
    assert compare(spark, connect(path), path, name, QUERIES[name], ORACLE[name]) is None


def test_ranks_and_intervals():
    listed = orders()
    assert listed == sorted(listed) and len(listed) == 120
    for k in range(6):
        for prefix in permutations(range(5), k):
            lo, hi = lehmer_interval(prefix, 5)
            text = "".join("ABCDE"[p] for p in prefix)
            assert [r for r, o in enumerate(listed) if o.startswith(text)] == list(range(lo, hi))


def test_edges_say_when_a_mask_goes():
    for n in (1, 3, 5):
        edges, listed = removal_edges(n), list(permutations(range(n)))
        for mask in range(1 << n):
            for step in range(1, n + 1):
                for rank, order in enumerate(listed):
                    running = sum(c for m, s, r, c in edges if (m, s) == (mask, step) and r <= rank)
                    hits = [k for k, f in enumerate(order, 1) if mask >> f & 1]
                    assert running == (hits[:1] == [step])


def test_cases(spark):
    long = " ".join(f"w{k}" for k in range(250))
    docs = [
        (5, long, "en"), (3, long, "en"), (3, long, "en"), (9, long, "xx"), (None, long, "en"), (None, long, None),
        (1, None, None), (2, "", ""), (4, "\t\x0b\n", "en"), (6, "a " * 300, "en"), (7, long + " #", "en"), (8, long.upper(), "en"),
        (10, "AAA", "en"), (11, "é" * 97 + "ABC", "fr"), (12, "é" * 96 + "ABCD", "fr"), (13, " one two " * 150, "fr"),
        (14, "Word " * 200_000, "de"), (14, "other", "de"), (15, long, "en"),
    ]
    labels = [(3, 1, 0), (3, 0, 1), (5, 1, 1), (9, 0, 0), (None, 1, 1), (14, 1, 0), (15, None, None), (77, 1, 1)]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(3)
    for clash in ("part", "mask", "id", "hash", "docs", "rank"):
        df = df.withColumn(clash, F.lit("x"))
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("id", F.lit(1))
    assert _got(audit(df, marks)) == _brute(docs, labels)
    assert _got(audit(df.limit(0), marks)) == []
    assert _got(audit(df, marks.limit(0))) == _brute(docs, [])

"""Spaced seeds against a loop over all alignments, and passages with replaced words."""

import random
import re

from pyspark.sql import functions as F

from strataflow.llm.decontaminate import FIVE, HITS, LEAST_HITS, MASKS, OVERLAP, SHORTEST, contamination
from strataflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _words(text):
    fold = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"} | {ord(c): None for c in ".,;:!?\"()"}
    return [w for w in re.split(r"[ \t\n\v\f\r]+", (text or "").translate(fold)) if w]


def _brute(text, items):
    """Items of a text: every alignment that a mask hits, scored by all its stretches' best."""
    w, out = _words(text), set()
    for item, b in items:
        b = _words(b)
        if len(b) < SHORTEST:
            continue
        masks = [m for m in MASKS if m[-1] < len(b)] or [tuple(range(len(b)))]
        for mask in masks:
            index = {}
            for j in range(len(b) - mask[-1]):
                index.setdefault(tuple(b[j + o] for o in mask), []).append(j)
            for i in range(len(w) - mask[-1]):
                for j in index.get(tuple(w[i + o] for o in mask), ()):
                    shift = i - j
                    score = top = first = last = start = 0
                    for k in range(max(0, -shift), min(len(b), len(w) - shift)):
                        score += 1 if b[k] == w[k + shift] else -2
                        if score <= 0:
                            score, start = 0, k + 1
                        elif score > top:
                            top, first, last = score, start if start else max(0, -shift), k + 1
                    alike = sum(b[k] == w[k + shift] for k in range(first, last))
                    if alike >= min(OVERLAP, -(-len(b) * 80 // 100)) and alike * 100 >= (last - first) * 80:
                        out.add(item)
    return sorted(out)


def test_query_over_the_whole_table(spark):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op5_spaced_seeds"](spark, SF).collect()}
    assert set(got) == set(docs)
    for i, text in docs.items():
        assert got[i].items == _brute(text, items)
        assert got[i].contaminated == bool(got[i].items)
        whole = [k for k, b in items if " ".join(_words(b)) in " ".join(_words(text))]
        assert set(whole) <= set(got[i].items)
    assert any(r.contaminated for r in got.values())


def test_replaced_words_are_tolerated_and_clean_texts_left_alone(spark):
    rng = random.Random(2)
    item = [f"w{rng.randrange(500)}" for _ in range(40)]
    changed = list(item)
    for k in (3, 11, 17, 26, 33):
        changed[k] = "other"
    noise = lambda n: [f"n{rng.randrange(900)}" for _ in range(n)]
    rows = [(1, noise(30) + changed + noise(30)), (2, noise(80)), (3, noise(9) + item[:7] + noise(9)), (4, noise(5) + item[10:26]), (5, item[::2] + noise(9))]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame([(9, " ".join(item).upper().replace(" ", ", "))], "item_id long, text string")
    got = {r.doc_id: r for r in contamination(docs, bench).collect()}
    assert [i for i in sorted(got) if got[i].contaminated] == [1, 4]
    span = got[1].spans[0]
    assert (span.item, span.first, span.last, span.alike) == (9, 30, 70, 35)


def test_cases(spark):
    items = [(1, "alpha beta gamma delta epsilon zeta"), (1, "alpha beta gamma delta epsilon zeta"), (2, None), (None, "one two three four five six seven"), (3, "too short"), (4, "")]
    texts = [(1, None), (2, ""), (None, "x alpha beta gamma delta epsilon zeta y"), (3, "One two, three four five six seven!"), (3, "One two, three four five six seven!"), (4, "z " * 50_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("item", F.lit("clash")).withColumn("spans", F.lit(0)).withColumn("key", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n", F.lit(0)).withColumn("doc_id", F.lit(0))
    got = sorted(((r.doc_id or 0, r.items) for r in contamination(docs, bench).collect()))
    assert got == [(0, [1]), (1, []), (2, []), (3, [-1]), (3, [-1]), (4, [])]
    assert contamination(docs.limit(0), bench).count() == 0
    assert contamination(docs, bench.limit(0)).where("contaminated").count() == 0


def _rule(text, items):
    """Items of a text by the rule alone: all alignments, all stretches."""
    w, out = _words(text), set()
    for item, b in items:
        b = _words(b)
        for shift in range(1 - len(b), len(w)) if len(b) >= SHORTEST else ():
            like = [b[k] == w[k + shift] for k in range(max(0, -shift), min(len(b), len(w) - shift))]
            for i in range(len(like)):
                alike = 0
                for j in range(i, len(like)):
                    alike += like[j]
                    if alike >= min(OVERLAP, -(-len(b) * 80 // 100)) and alike * 5 >= (j - i + 1) * 4:
                        out.add(item)
    return sorted(out)


def _changed(cases, name="w"):
    """Texts and items, one of each for a case (words, replaced places), and the items that each text holds by the rule."""
    texts, items = [], []
    for number, (n, changed) in enumerate(cases):
        item = [f"{name}{number}x{k}" for k in range(n)]
        items.append((number, " ".join(item)))
        texts.append((number, " ".join(["a", "b", *["other" if k in changed else w for k, w in enumerate(item)], "c"])))
    return texts, items, {i: _rule(t, items[i : i + 1]) for i, t in texts}


def test_any_stretch_decides(spark):
    # A short end behind a replaced word counts, and so does a part of a stretch that is too unlike as a whole.
    cases = [(17, {2, 14}), (15, {2, 12}), (20, {2, 4, 12, 17}), (16, {2, 13}), (60, {2, *range(20, 60, 2)}), (17, {2, 8, 13, 14})]
    texts, items, want = _changed(cases)
    got = {r.doc_id: r for r in contamination(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {i: r.items for i, r in got.items()} == want
    assert want[0] == [0] and want[5] == []
    span = got[0].spans[0]
    assert (span.first, span.last, span.alike) == (2, 19, 15)


def _least_hits(masks, n):
    """The fewest hits of any stretch that counts for an item of n words, over all stretches.

    26 like words or more can be cut in two of 13 at least, one of them 80 % alike: 31 places are enough.
    """
    need, span, best = min(OVERLAP, -(-4 * n // 5)), max(m[-1] for m in masks) + 1, None
    states = {((1,), 1): 0}
    for length in range(1, min(n, 31) + 1):
        if length > 1:
            longer = {}
            for (tail, alike), hits in states.items():
                for like in (0, 1):
                    t = (*tail, like)[-span:]
                    more = hits + sum(len(t) > m[-1] and all(t[len(t) - 1 - m[-1] + o] for o in m) for m in masks)
                    key = (t, alike + like)
                    longer[key] = min(more, longer.get(key, more))
            states = longer
        found = [h for (t, alike), h in states.items() if t[-1] and alike >= need and alike * 5 >= length * 4]
        best = min([*found, best] if best is not None else found, default=None)
    return best


def test_every_stretch_that_counts_has_its_hits():
    for n in range(SHORTEST, 40):
        assert _least_hits(MASKS + FIVE if n == SHORTEST else MASKS, n) >= HITS.get(n, LEAST_HITS) >= 1


def test_sparse_replacements_are_hit(spark):
    fifth = [(n, set(range(phase, n, 5))) for n in (30, 60, 200) for phase in (0, 4)]
    single = [(n, {k}) for n in range(5, 11) for k in range(n)]
    several = [(15, {3, 7, 11}), (16, {3, 7, 11}), (20, {3, 7, 11, 15}), (10, {2, 6}), (11, {3, 7})]
    texts, items, want = _changed(fifth + single + several)
    got = contamination(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {r.doc_id: r.items for r in got} == want == {i: [i] for i in want}

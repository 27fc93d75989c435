"""Quality rules learnt as a decision list.

Every text is reduced to a few counts. From the counts of labelled texts a list
of rules is learnt by sequential covering: a rule, a conjunction of thresholds,
is grown on one part of the rows until it covers hardly anything of the other
class, pruned on the rest, and what it covers is set aside before the next one
is grown. The list becomes one ordered Spark expression (``when`` ...
``otherwise``), which judges all rows inside the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.text import SPACES, chunks, mix, row_sums, span_hashes, text_bytes, text_column, window_hashes, window_rows, word_spans
from strataflow.session import materialize

# The contract's base rules.
SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50  # fewer fail
MAX_REPEATED = 50  # repeated words above so many in a hundred fail
WINDOW = 3

SAMPLE_ROWS = 20_000  # bound of the labelled rows that the list is learnt from
MAX_TESTS = 4  # thresholds in one rule
PRECISION = {False: 0.9, True: 0.98}  # that a rule for bad, or good, texts must reach on rows it was not grown on

#: Counts of a text, in the order in which they are measured.
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_chars", "n_capitals", "n_digits", "n_shouts", "n_lines", "n_distinct", "n_again",
)
#: What rules may test: a count by another one.
FEATURES = {
    "word_length": ("word_chars", "n_words"),
    "symbol_share": ("n_symbols", "n_chars"),
    "dup_line_share": ("n_dup_lines", "n_lines"),
    "repeat_share": ("n_repeat_words", "n_words"),
    "capital_share": ("n_capitals", "n_chars"),
    "digit_share": ("n_digits", "n_chars"),
    "shouts_a_word": ("n_shouts", "n_words"),
    "words_a_line": ("n_words", "n_lines"),
    "distinct_share": ("n_distinct", "n_words"),
    "again_share": ("n_again", "n_words"),
}

_BYTE = np.arange(256)
_SPACE = np.isin(_BYTE, list(SPACES))
_IS = {
    "n_symbols": np.isin(_BYTE, list(SYMBOLS)),
    "n_chars": (_BYTE & 0xC0) != 0x80,
    "word_chars": ((_BYTE & 0xC0) != 0x80) & ~_SPACE,
    "n_capitals": (_BYTE >= 65) & (_BYTE <= 90),
    "n_digits": (_BYTE >= 48) & (_BYTE <= 57),
    "n_shouts": np.isin(_BYTE, list(b"!?")),
}


def _by_row(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal hashes of one row together, and where that order equals the one before."""
    keys = mix(hashes ^ mix(rows.astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    same = np.zeros(len(keys), bool)
    same[1:] = keys[1:] == keys[:-1]
    return order, same


def _old(hashes: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """How many of each row's hashes it has had before."""
    order, same = _by_row(hashes, rows)
    return np.bincount(rows[order[same]], minlength=n)


def measures(column: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` of each text; words and lines are told apart by 64 bits."""
    n = len(column)
    data, offsets = text_bytes(column)
    out = {name: row_sums(table[data], offsets) for name, table in _IS.items()}
    # Lines: between line feeds, with a word; white space in them counts.
    _, starts, lengths, bounds = word_spans(column, inside=_BYTE != 10)
    with_word = np.add.reduceat(~_SPACE[data], starts) > 0 if len(starts) else np.zeros(0, bool)
    row = np.repeat(np.arange(n), np.diff(bounds))[with_word]
    out["n_lines"] = np.bincount(row, minlength=n)
    out["n_dup_lines"] = _old(span_hashes(data, starts[with_word], lengths[with_word], spaces=True), row, n)
    data, starts, lengths, bounds = word_spans(column)
    words = span_hashes(data, starts, lengths)
    row = np.repeat(np.arange(n), np.diff(bounds))
    out["n_words"] = np.diff(bounds)
    out["n_distinct"] = out["n_words"] - _old(words, row, n)
    again = np.flatnonzero((words[1:] == words[:-1]) & (row[1:] == row[:-1])) + 1
    out["n_again"] = np.bincount(row[again], minlength=n)
    windows = window_hashes(words, WINDOW)
    _, inside = window_rows(bounds, WINDOW, len(windows))
    at = np.flatnonzero(inside)
    order, same = _by_row(windows[at], row[at])
    twice = same.copy()
    twice[:-1] |= same[1:]
    covered = np.zeros(len(words) + WINDOW, bool)
    for k in range(WINDOW):
        covered[at[order[twice]] + k] = True
    out["n_repeat_words"] = row_sums(covered[: len(words)], bounds)
    return out


def measure(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id_col`` and ``COUNTS`` of its whole text.

    A null text is empty. Null ids and repeated rows are kept; other columns
    are not read. A chunk's arrays are all that a task holds.
    """
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, "text"):
                part = batch.slice(lo, hi - lo)
                found = measures(text_column(part, "text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), *[pa.array(found[c], pa.int64()) for c in COUNTS]], ["id", *COUNTS])

    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(count, f"id {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS)).withColumnRenamed("id", id_col)


def base_failed() -> Column:
    """Does a row of ``measure`` fail the base rules?"""
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def feature(name: str) -> Column:
    """A feature from ``COUNTS``; 0 where there is nothing to divide by."""
    top, bottom = FEATURES[name]
    return F.col(top).cast("double") / F.greatest(F.col(bottom), F.lit(1))


@dataclass(frozen=True)
class Test:
    """``feature > bound`` if above, else ``feature <= bound``."""

    feature: str
    above: bool
    bound: float

    def column(self) -> Column:
        value = F.col(self.feature)
        return value > self.bound if self.above else value <= self.bound

    def holds(self, values: np.ndarray) -> np.ndarray:
        return values > self.bound if self.above else values <= self.bound

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.bound!r}"


@dataclass(frozen=True)
class Rule:
    """All tests hold: the text is good, or bad. ``hits`` and ``misses`` count on the rows it was pruned on."""

    tests: tuple[Test, ...]
    good: bool
    hits: int
    misses: int

    def column(self) -> Column:
        out = self.tests[0].column()
        for test in self.tests[1:]:
            out &= test.column()
        return out


@dataclass(frozen=True)
class DecisionList:
    """Rules in the order in which they are asked; a text that none covers is good."""

    rules: tuple[Rule, ...]

    def _first(self, answers: Sequence, otherwise) -> Column:
        if not self.rules:
            return F.lit(otherwise)
        out = F
        for rule, answer in zip(self.rules, answers):
            out = out.when(rule.column(), answer)
        return out.otherwise(otherwise)

    def verdict(self) -> Column:
        """Is a row good? An ordered conditional expression over ``FEATURES``."""
        return self._first([r.good for r in self.rules], True)

    def which(self) -> Column:
        """Number of the rule that decides, from 1; 0 where none does."""
        return self._first(range(1, len(self.rules) + 1), 0)

    def __str__(self) -> str:
        cases = [f"WHEN {' AND '.join(map(str, r.tests))} THEN {'good' if r.good else 'bad'}" for r in self.rules]
        return "\n".join(["CASE", *cases, "ELSE good END"])


def _short(a: float, b: float) -> float:
    """The number with the fewest digits that is at least ``a`` and below ``b``."""
    middle = (a + b) / 2
    return next((x for x in (float(f"{middle:.{k}g}") for k in range(1, 18)) if a <= x < b), a)


def _best_test(x: np.ndarray, target: np.ndarray, names: Sequence[str]) -> tuple[float, Test] | None:
    """The threshold with the highest information gain over the rows ``x``."""
    p0, n0 = int(target.sum()), int((~target).sum())
    before, best = np.log2(p0 / (p0 + n0)), None
    for j, name in enumerate(names):
        order = np.argsort(x[:, j], kind="stable")
        v, t = x[order, j], target[order]
        cut = np.flatnonzero(v[1:] > v[:-1])
        p, n = np.cumsum(t)[cut], np.cumsum(~t)[cut]
        for above, (ps, ns) in ((False, (p, n)), (True, (p0 - p, n0 - n))):
            gain = np.where(ps > 0, ps * (np.log2(np.maximum(ps, 1) / np.maximum(ps + ns, 1)) - before), 0)
            if len(gain) and gain.max() > 1e-9 and (best is None or gain.max() > best[0] + 1e-9):
                k = int(np.argmax(gain))
                best = float(gain[k]), Test(name, above, _short(float(v[cut[k]]), float(v[cut[k] + 1])))
    return best


def _covers(tests: Sequence[Test], x: np.ndarray, names: Sequence[str]) -> np.ndarray:
    out = np.ones(len(x), bool)
    for test in tests:
        out &= test.holds(x[:, names.index(test.feature)])
    return out


def _grow(x: np.ndarray, target: np.ndarray, names: Sequence[str]) -> list[Test]:
    tests: list[Test] = []
    rows = np.ones(len(x), bool)
    while len(tests) < MAX_TESTS and target[rows].any() and not target[rows].all():
        best = _best_test(x[rows], target[rows], names)
        if best is None:
            break
        tests.append(best[1])
        rows &= best[1].holds(x[:, names.index(best[1].feature)])
    return tests


def _prune(tests: list[Test], x: np.ndarray, target: np.ndarray, names: Sequence[str]) -> tuple[list[Test], int, int]:
    """The first tests of the rule that do best on rows it was not grown on; what they cover of either class."""
    best, kept = None, (tests, 0, 0)
    for k in range(1, len(tests) + 1):
        rows = _covers(tests[:k], x, names)
        hits, misses = int(target[rows].sum()), int((~target[rows]).sum())
        worth = (hits - misses) / max(1, hits + misses)
        if hits and (best is None or worth > best):
            best, kept = worth, (tests[:k], hits, misses)
    return kept


def learn(x: np.ndarray, good: np.ndarray, names: Sequence[str]) -> DecisionList:
    """A decision list from rows of features ``x`` with their labels; every third row is for pruning.

    At each turn a rule for bad texts is tried first, and only where none is
    precise enough one for good texts, which sets an exception aside; rules for
    good texts that no rule for bad ones follows are dropped. Without rows of
    both classes the list is empty.
    """
    x, good, names = np.asarray(x, float).reshape(len(good), len(names)), np.asarray(good, bool), list(names)
    pruning = np.arange(len(good)) % 3 == 2
    left, rules = np.ones(len(good), bool), []
    while True:
        for verdict in (False, True):
            target = good == verdict
            grown = _grow(x[left & ~pruning], target[left & ~pruning], names)
            if not grown:
                continue
            tests, hits, misses = _prune(grown, x[left & pruning], target[left & pruning], names)
            if hits >= 2 and (hits + 1) / (hits + misses + 2) >= min(PRECISION[verdict], (hits + 1) / (hits + 2)):
                rules.append(Rule(tuple(tests), verdict, hits, misses))
                left &= ~_covers(tests, x, names)
                break
        else:
            break
    while rules and rules[-1].good:
        rules.pop()
    return DecisionList(tuple(rules))


def fit(stats: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", rows: int = SAMPLE_ROWS) -> DecisionList:
    """The list learnt from the labelled rows of ``stats`` that pass the base rules.

    At most ``rows`` of them, the first by a hash of the id, come to the driver
    as ten numbers each. Labels other than 0 and 1 and rows without an id are
    not used; of several labels of one id the largest counts.
    """
    known = labels.where(F.col("quality").isin(0, 1)).groupBy(F.col(id_col).alias("_id")).agg(F.max("quality").alias("_quality"))
    labelled = materialize(
        stats.where(~base_failed())
        .join(known, F.col(id_col) == F.col("_id"))
        .select(F.xxhash64("_id").alias("h"), "_id", (F.col("_quality") == 1).alias("good"), *[feature(f).alias(f) for f in FEATURES]),
        "labelled",
    )
    # A share of the hashes that holds about twice the rows: each task sends its part of those, not its own first rows.
    share = min(1.0, 2 * rows / max(1, labelled.count()))
    last = min((1 << 63) - 1, int((1 << 64) * share) - (1 << 63))
    picked = labelled.where(F.col("h") <= last).orderBy("h", "_id", *FEATURES).limit(rows).collect()
    x = np.array([[r[f] for f in FEATURES] for r in picked], float)
    return learn(x, np.array([r["good"] for r in picked], bool), list(FEATURES))


def judge(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per input row: ``id_col``, ``COUNTS``, ``base_failed``, ``kept`` and ``rule``.

    ``kept`` is false where the base rules fail, else the learnt list's verdict;
    ``rule`` is the number of the rule that decided, 0 for the default and null
    where the base rules did. Null and empty texts have no words and fail. With
    an empty or one-sided ``labels`` the list is empty and the base rules decide
    alone. Null ids and repeated rows are kept; other columns are not read; an
    empty table gives an empty result.
    """
    stats = materialize(measure(docs, id_col=id_col, text_col=text_col), "stats")
    listed = fit(stats, labels, id_col=id_col, rows=rows)
    judged = stats.select("*", base_failed().alias("base_failed"), *[feature(f).alias(f) for f in FEATURES])
    return judged.select(
        id_col,
        *COUNTS,
        "base_failed",
        (~F.col("base_failed") & listed.verdict()).alias("kept"),
        F.when(~F.col("base_failed"), listed.which()).alias("rule"),
    )

"""A quality classifier learnt from heuristics that disagree.

Heuristic labellers vote on every text. Expectation-maximisation over the
counts of all vote patterns estimates how often each is right, without labels;
the posterior of a text's pattern is the target of a hashed linear scorer,
which then judges every text by its words alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.text import chunks, mix, row_sums, span_hashes, text_column, window_hashes, word_spans
from strataflow.session import materialize

BUCKETS = 1 << 17
SAMPLE_ROWS = 8000  # bound of the texts that the scorer is trained on
SAMPLE_WORDS = 20_000  # a longer text is not used for training
REJECT = 0.3  # a text below this score is rejected
GOOD, BAD, SILENT = 0, 1, 2

_BYTE = np.arange(256)
_UPPER = (_BYTE >= 65) & (_BYTE <= 90)
_LETTER = _UPPER | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_SYMBOL = np.isin(_BYTE, list(b"#$%&*@^~|<>{}[]=+\\_`"))
# Letters A, other letters a, digits 0; the rest as it is.
_SHAPE = np.where(_UPPER, 65, np.where(_LETTER, 97, np.where((_BYTE >= 48) & (_BYTE <= 57), 48, _BYTE))).astype(np.uint8)

#: Labellers: a measure of the text, bad from one bound on, good up to the other, else silent.
LABELLERS = (
    ("symbols", 0.05, 0.02),  # share of characters that are symbols
    ("symbol_words", 0.2, 0.05),  # share of words that hold a symbol
    ("capitals", 0.5, 0.2),  # share of ASCII letters that are capitals
    ("shouts", 0.3, 0.05),  # exclamation marks a word
    ("repeats", 0.2, 0.05),  # share of words equal to the word before
    ("same_triples", 0.7, 0.4),  # share of three-word runs that are not new in the text
    ("same_lines", 0.5, 0.3),  # share of lines that are not new in the text
    ("odd_length", 2.5, 1.6),  # mean word length's distance from six characters
)


def _per_row(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return row_sums(values, bounds, np.float64)


def _not_new(hashes: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of each row's hashes it has had before, and how many it has."""
    order = np.lexsort((hashes, rows))
    h, r = hashes[order], rows[order]
    old = np.flatnonzero((h[1:] == h[:-1]) & (r[1:] == r[:-1]))
    return np.bincount(r[old], minlength=n), np.bincount(rows, minlength=n)


class _Texts:
    """Measures and hashed features of a chunk of texts."""

    def __init__(self, column: pa.Array) -> None:
        data, starts, lengths, bounds = word_spans(column)
        self.rows, self.bounds, self.words = len(column), bounds, np.diff(bounds)
        self.row = np.repeat(np.arange(self.rows), self.words)
        self.data, self.starts, self.lengths = data, starts, lengths
        self.hashes = span_hashes(data, starts, lengths)
        first = np.zeros(len(starts), bool)
        first[bounds[:-1][self.words > 0]] = True
        self.again = np.zeros(len(starts), bool)
        self.again[1:] = (self.hashes[1:] == self.hashes[:-1]) & ~first[1:]
        self.column = column

    def measures(self) -> np.ndarray:
        data, n = self.data, np.maximum(1, self.words)
        offsets = np.frombuffer(self.column.buffers()[1], np.int64)[self.column.offset : self.column.offset + self.rows + 1]
        offsets = offsets - offsets[0]
        characters = np.maximum(1, _per_row((data & 0xC0) != 0x80, offsets))
        symbol = _SYMBOL[data]
        ascii_letters = _LETTER[data] & (data < 128)
        holds = np.add.reduceat(symbol, self.starts) > 0 if len(self.starts) else np.zeros(0, bool)
        triples = window_hashes(self.hashes, 3)
        inside = np.flatnonzero(self.row[: len(triples)] == self.row[2:]) if len(self.row) > 2 else np.zeros(0, int)
        old3, all3 = _not_new(triples[inside], self.row[inside], self.rows)
        lines = word_spans(self.column, inside=_BYTE != 10)
        line_row = np.repeat(np.arange(self.rows), np.diff(lines[3]))
        old_lines, all_lines = _not_new(span_hashes(*lines[:3]), line_row, self.rows)
        long = _per_row((data & 0xC0) != 0x80, offsets) - _per_row(data <= 32, offsets)
        return np.stack(
            [
                _per_row(symbol, offsets) / characters,
                _per_row(holds, self.bounds) / n,
                _per_row(_UPPER[data], offsets) / np.maximum(1, _per_row(ascii_letters, offsets)),
                _per_row(data == 33, offsets) / n,
                _per_row(self.again, self.bounds) / n,
                np.where(all3 >= 5, old3 / np.maximum(1, all3), np.nan),
                np.where(all_lines >= 3, old_lines / np.maximum(1, all_lines), np.nan),
                np.abs(long / n - 6),
            ],
            1,
        )

    def votes(self) -> np.ndarray:
        """Vote of each labeller on each row; all are silent on a text without words."""
        m = self.measures()
        bad, good = (np.array([x[k] for x in LABELLERS]) for k in (1, 2))
        out = np.where(m >= bad, BAD, np.where(m <= good, GOOD, SILENT))
        out[self.words == 0] = SILENT
        return out

    def features(self) -> np.ndarray:
        """Two buckets for each word: itself, and the shape of its end with whether it repeats the word before."""
        tail = np.minimum(self.lengths, 3)
        shape = span_hashes(_SHAPE[self.data], self.starts + self.lengths - tail, tail)
        shape = mix(shape + self.again.astype(np.uint64) * np.uint64(0x1000193))
        half = np.uint64(BUCKETS // 2)
        return np.stack([(self.hashes % half).astype(np.int32), (shape % half).astype(np.int32) + BUCKETS // 2], 1)


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Posterior probability of a bad text for each vote pattern, each labeller's
    answers (labeller, truth, vote), and the share of bad texts.

    A silent labeller says nothing either way: short texts are silent more often,
    and no worse for it. The two classes start from the majority of votes; each round re-estimates
    the answers from the posteriors and the posteriors from the answers.
    """
    bad, good = (patterns == BAD).sum(1), (patterns == GOOD).sum(1)
    p = np.where(bad > 0, np.where(bad >= good, 0.95, 0.5), 0.02) if len(patterns) else np.zeros(0)
    p = np.where(bad + good == 0, 0.5, p)
    answers, share = np.ones((patterns.shape[1], 2, 3)), 0.5
    for _ in range(rounds):
        weight = np.stack([counts * (1 - p), counts * p], 1)
        share = float((weight[:, 1].sum() + 1) / (counts.sum() + 5))
        for k in range(patterns.shape[1]):
            for vote in (GOOD, BAD):
                answers[k, :, vote] = weight[patterns[:, k] == vote].sum(0) + 0.5
                answers[k, vote, vote] += 4  # until shown otherwise, a labeller is mostly right
        answers[:, :, :SILENT] /= answers[:, :, :SILENT].sum(2, keepdims=True)
        chance = np.log([1 - share, share]) + sum(np.log(answers[k][:, patterns[:, k]]).T for k in range(patterns.shape[1]))
        new = 1 / (1 + np.exp(np.clip(chance[:, 0] - chance[:, 1], -50, 50)))
        if len(new) == 0 or np.abs(new - p).max() < 1e-9:
            p = new
            break
        p = new
    return p, answers, share


@dataclass
class LinearScorer:
    """Logistic scorer over the mean of a text's hashed features; the score is the chance of a good text."""

    weights: np.ndarray
    bias: float

    def scores(self, features: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = _per_row(self.weights[features].sum(1) if len(features) else np.zeros(0), bounds)
        return 1 / (1 + np.exp(-np.clip(total / np.maximum(1, np.diff(bounds)) + self.bias, -50, 50)))

    @classmethod
    def train(cls, texts: list[np.ndarray], targets: np.ndarray, epochs: int = 20, rate: float = 1.0) -> LinearScorer:
        weights, total, bias = np.zeros(BUCKETS), np.full(BUCKETS, 1e-4), 0.0
        rng = np.random.default_rng(3)
        sizes = [max(1, len(t)) for t in texts]
        # a few large arrays, which go back to the system when they are done with, unlike thousands of small ones
        index, counts = np.empty(sum(sizes), np.int32), np.empty(sum(sizes), np.int32)
        ends = np.zeros(len(texts) + 1, np.int64)
        for k, t in enumerate(texts):
            known, n = np.unique(t, return_counts=True)
            ends[k + 1] = ends[k] + len(known)
            index[ends[k] : ends[k + 1]], counts[ends[k] : ends[k + 1]] = known, n
        for epoch in range(epochs):
            step = rate / (1 + epoch / 4)
            for i in rng.permutation(len(texts)):
                at, x = index[ends[i] : ends[i + 1]], counts[ends[i] : ends[i + 1]] / sizes[i]
                wrong = 1 / (1 + np.exp(-np.clip(weights[at] @ x + bias, -50, 50))) - targets[i]
                g = wrong * x
                total[at] += g * g
                weights[at] -= step * g / np.sqrt(total[at])
                bias -= 0.02 * wrong
        return cls(weights.astype(np.float64), float(bias))


def _fit(docs: DataFrame, text_col: str, rows: int) -> Broadcast:
    """Scorer and posterior of each vote pattern, learnt from the texts of ``docs``."""
    spark = docs.sparkSession
    source = docs.select(F.col(text_col).cast("string").alias("text")).withColumn("text_hash", F.xxhash64("text"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, "text"):
                part = batch.slice(lo, hi - lo)
                texts = _Texts(text_column(part, "text"))
                names = [bytes(v).decode() for v in np.array(list(b"gb-"), np.uint8)[texts.votes()]]
                yield pa.RecordBatch.from_arrays([part.column("text_hash"), pa.array(names, pa.string()), pa.array(texts.words <= SAMPLE_WORDS)], ["text_hash", "votes", "short"])

    voted = materialize(source.mapInArrow(vote, "text_hash bigint, votes string, short boolean"), "votes")
    seen = voted.groupBy("votes").count().orderBy("votes").collect()
    patterns = np.array([["gb-".index(c) for c in r["votes"]] for r in seen], np.int64).reshape(len(seen), len(LABELLERS))
    counts = np.array([r["count"] for r in seen], np.float64)
    posterior, _, _ = estimate(patterns, counts)
    bad = {r["votes"]: float(p) for r, p in zip(seen, posterior)}
    draw = voted.where("short").select("text_hash", "votes").distinct()
    halves = [[v for v, p in bad.items() if (p >= 0.5) == half] for half in (True, False)]
    picked = [draw.where(F.col("votes").isin(v)).orderBy(F.xxhash64("text_hash"), "text_hash").limit(rows // 2) for v in halves if v]
    texts, targets = [], []
    if picked:
        chosen = picked[0].union(picked[1]) if len(picked) > 1 else picked[0]

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo, hi in chunks(batch, "text"):
                    part = batch.slice(lo, hi - lo)
                    t = _Texts(text_column(part, "text"))
                    f = t.features()
                    packed = [f[a:b].tobytes() for a, b in zip(t.bounds[:-1], t.bounds[1:])]
                    yield pa.RecordBatch.from_arrays([part.column("text_hash"), part.column("votes"), pa.array(packed, pa.binary())], ["text_hash", "votes", "features"])

        sample = (
            source
            .join(F.broadcast(chosen), "text_hash")  # ``rows`` hashes at most
            .mapInArrow(read, "text_hash bigint, votes string, features binary")
            .groupBy("text_hash").agg(F.min_by(F.struct("votes", "features"), "votes").alias("x"))
            .orderBy("text_hash")
            .select("x.votes", "x.features")
            .toArrow()
        )
        texts = [np.frombuffer(x.as_buffer(), np.int32) for x in sample.column("features")]
        targets = [1 - bad[v] for v in sample.column("votes").to_pylist()]
    scorer = LinearScorer.train(texts, np.array(targets))
    sample = texts = None
    pa.default_memory_pool().release_unused()  # the driver goes on to other work
    return spark.sparkContext.broadcast((scorer, bad))  # fixed size


def _judge(column: pa.Array, model: tuple[LinearScorer, dict[str, float]], reject: float):
    """Score, posterior, votes and rejection of each text."""
    scorer, known = model
    t = _Texts(column)
    names = [bytes(v).decode() for v in np.array(list(b"gb-"), np.uint8)[t.votes()]]
    p = np.array([known[n] for n in names])
    score = np.where(t.words > 0, scorer.scores(t.features(), t.bounds), 1 - p)
    return score, p, names, (score < reject) & (p >= 0.5)


def classify(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS, reject: float = REJECT) -> DataFrame:
    """One row per input row: ``id_col``, ``score`` (of being good), ``posterior_bad`` (of its
    votes), ``votes`` (a string of g, b and -) and ``rejected``.

    The patterns of all texts are counted (at most 3^8 of them); the scorer is
    fitted on at most ``rows`` texts, drawn by a hash of the text, with an equal
    part from likely bad and likely good ones. A text is rejected when its score
    is below ``reject`` and its labellers do not lean to good. Null and empty
    texts have no votes and are judged by the prior: they are rejected only if
    most of the corpus is. Null ids and repeated rows are kept; other columns
    are not read; an empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    model = _fit(docs, text_col, rows)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, "text"):
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), *map(pa.array, _judge(text_column(part, "text"), model.value, reject))],
                    ["id", "score", "posterior_bad", "votes", "rejected"],
                )

    return source.mapInArrow(judge, f"id {kind}, score double, posterior_bad double, votes string, rejected boolean").withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, *, text_col: str = "text", rows: int = SAMPLE_ROWS, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that ``classify`` does not reject, with all their columns and without a shuffle."""
    model = _fit(docs, text_col, rows)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, text_col):
                part = batch.slice(lo, hi - lo)
                yield part.filter(pa.array(~_judge(text_column(part, text_col), model.value, reject)[3]))

    return docs.mapInArrow(judge, docs.schema)

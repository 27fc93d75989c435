"""Ranked lexical search: branch and bound over document FP-trees.

Documents are cut down to the terms that the items ask for and ordered from
the most frequent term to the rarest, so documents with common beginnings share
a path of a trie. Each subtree knows, for each of its terms, the largest number
of occurrences, and the smallest length norm m: as a score rises with the
occurrences and falls with m, these bound the score of every document below.
A depth-first walk goes down only where the bound reaches an item's current
k-th score. A task builds one tree after another from its own rows and keeps
the best documents of each item, so later trees are cut by what earlier ones
found; the tasks' best are then merged.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.text import chunks, gather, span_hashes, text_column, word_spans
from strataflow.session import materialize

# The contract's terms and constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K1, B = 12, 25

ITEM_BYTES = 1 << 20  # text of the items that are answered in one pass
ITEM_GROUP = 256  # items that walk a tree together
TREE_POSTINGS = 1 << 20  # (document, term) entries of one tree
PAGE = 64  # documents that are scored together
SALTS = 64  # parts in which an item's results are merged first

_BYTE = np.arange(256)
_IN_TERM = ((_BYTE >= 48) & (_BYTE <= 57)) | ((_BYTE >= 65) & (_BYTE <= 90)) | ((_BYTE >= 97) & (_BYTE <= 122)) | (_BYTE >= 128)
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_TERMS = re.compile(TERM)


def terms(text: str | None) -> list[str]:
    """Terms of a text, with repeats; only A-Z are lower-cased."""
    return _TERMS.findall((text or "").translate(_FOLD))


def _print(words: list[str]) -> np.ndarray:
    """Fingerprints of terms, as those of the documents' terms are made."""
    data, starts, lengths, _ = word_spans(pa.array(words, pa.large_string()), inside=_IN_TERM)
    return span_hashes(data, starts, lengths)


def _vectors(docs: DataFrame, known: Broadcast) -> DataFrame:
    """(id, n, terms, tfs) of each document with a term: its length, and occurrences of the known terms.

    ``known`` holds their sorted fingerprints; ``terms`` are places in it.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, "text"):
                part = batch.slice(lo, hi - lo)
                data, starts, lengths, bounds = word_spans(text_column(part, "text"), lower=True, inside=_IN_TERM)
                words = span_hashes(data, starts, lengths)
                n = np.diff(bounds)
                at = np.minimum(np.searchsorted(known.value, words), max(0, len(known.value) - 1))
                hit = np.flatnonzero(known.value[at] == words) if len(known.value) else np.zeros(0, np.int64)
                row = np.searchsorted(bounds, hit, "right") - 1
                pair, tf = np.unique(row * np.int64(len(known.value) + 1) + at[hit], return_counts=True)
                row, term = np.divmod(pair, len(known.value) + 1)
                cuts = np.searchsorted(row, np.arange(part.num_rows + 1)).astype(np.int32)
                whole = [pa.ListArray.from_arrays(pa.array(cuts), pa.array(v.astype(np.int32))) for v in (term, tf)]
                out = pa.RecordBatch.from_arrays([part.column("id"), pa.array(n, pa.int64()), *whole], ["id", "n", "terms", "tfs"])
                yield out.filter(pa.array(n > 0))

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(cut, f"id {kind}, n bigint, terms array<int>, tfs array<int>")


@dataclass(frozen=True)
class Corpus:
    """What the score needs to know: documents with a term, all their terms, and
    for each known term its weight and its place in order of frequency."""

    documents: int
    length: int
    weight: np.ndarray
    place: np.ndarray

    def norm(self, n: np.ndarray) -> np.ndarray:
        return 100 - B + (B * n * self.documents) // max(1, self.length)


def _gain(weight: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of the score, once."""
    return weight * ((1_000_000_000 * tf) // (1000 * tf + K1 * m))


def _corpus(vectors: DataFrame, size: int) -> Corpus:
    """Counts over all documents; one number for each known term comes to the driver."""
    documents, length = vectors.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = np.zeros(size, np.int64)
    for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        df[r["term"]] = r["count"]
    weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * df + 1.0))).astype(np.int64)
    place = np.empty(size, np.int64)
    place[np.lexsort((np.arange(size), -df))] = np.arange(size)
    return Corpus(documents, length, weight, place)


class _Node:
    """A subtree: documents ``lo`` to ``hi`` of the sorted tree, and what bounds their scores."""

    __slots__ = ("lo", "hi", "children", "terms", "most", "least")

    def __init__(self, lo: int, hi: int) -> None:
        self.lo, self.hi, self.children = lo, hi, []


class FPTree:
    """A trie over documents given as frequency-ordered terms.

    ``start`` has the first entry of each document in ``term`` and ``tf`` and
    one number more; ``term`` rises within a document. Paths without a branch
    are one edge. A node's small children that lie side by side share a page of
    at most ``PAGE`` documents, and so do equal documents, those of similar
    norm together.
    """

    def __init__(self, start: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray) -> None:
        size = np.diff(start)
        key = term.astype(">u4").tobytes()
        paths = [key[4 * a : 4 * b] for a, b in zip(start[:-1], start[1:])]
        norms = m.tolist()
        order = np.array(sorted(range(len(paths)), key=lambda i: (paths[i], norms[i])), np.int64)
        self.order, self.size, self.m = order, size[order], m[order]
        self.term, self.tf = gather(term, start[:-1][order], self.size), gather(tf, start[:-1][order], self.size)
        self.start = np.concatenate([[0], np.cumsum(self.size)])
        self.root = self._build() if len(order) else None

    def _split(self, lo: int, hi: int, depth: int) -> list[tuple[int, int, int]]:
        """Where documents that are alike up to ``depth`` part: (lo, hi, depth) of each branch."""
        while True:
            size = self.size[lo:hi]
            at = np.minimum(self.start[lo:hi] + depth, len(self.term) - 1)
            here = np.where(size > depth, self.term[at], -1)
            if here[0] < 0 and here[-1] < 0:  # equal documents: pages by norm
                return [(a, min(a + PAGE, hi), -1) for a in range(lo, hi, PAGE)]
            cuts = np.flatnonzero(np.diff(here)) + 1
            depth += 1
            if len(cuts):
                edges = [lo, *(lo + cuts).tolist(), hi]
                # the first branch may be the documents that end here
                return [(a, b, depth if here[a - lo] >= 0 else depth - 1) for a, b in zip(edges[:-1], edges[1:])]

    def _build(self) -> _Node:
        root = _Node(0, len(self.order))
        todo, made = [(root, 0)], [root]
        while todo:
            node, depth = todo.pop()
            if node.hi - node.lo <= PAGE:
                continue
            page = None
            for lo, hi, deeper in self._split(node.lo, node.hi, depth):
                if page is not None and hi - page.lo <= PAGE:
                    page.hi = hi
                    continue
                child = _Node(lo, hi)
                page = child if hi - lo <= PAGE else None
                node.children.append(child)
                made.append(child)
                if hi - lo > PAGE:
                    todo.append((child, deeper))
        for node in reversed(made):  # children come after their parent
            if node.children:
                found = np.concatenate([c.terms for c in node.children]), np.concatenate([c.most for c in node.children])
                node.least = min(c.least for c in node.children)
            else:
                found = self.term[self.start[node.lo] : self.start[node.hi]], self.tf[self.start[node.lo] : self.start[node.hi]]
                node.least = int(self.m[node.lo : node.hi].min())
            by = np.argsort(found[0], kind="stable")
            terms, most = found[0][by], found[1][by]
            edge = np.flatnonzero(np.diff(terms, prepend=-1))
            node.terms, node.most = terms[edge], (np.maximum.reduceat(most, edge) if len(edge) else most)
        return root


class Items:
    """Items that walk trees together, and the best documents that a task has found for each.

    ``term``, ``item`` and ``count`` say how often an item asks for a term, by
    its place in order of frequency; ``weight`` is in that order too. Sums stay
    below 2^53, or else exact integers are used.
    """

    def __init__(self, n: int, term: np.ndarray, item: np.ndarray, count: np.ndarray, weight: np.ndarray, k: int) -> None:
        self.k, self.weight = k, weight
        self.mine = np.unique(term)
        self.count = np.zeros((len(self.mine), n), np.min_scalar_type(int(count.max(initial=0))))
        self.count[np.searchsorted(self.mine, term), item] = count
        largest = np.bincount(item, weights=1e6 * weight[term] * count, minlength=n).max(initial=0)
        self.kind = np.float64 if largest < 1 << 52 else np.int64
        self.score, self.row = np.zeros((n, k), np.int64), np.zeros((n, k), np.int64)
        self.bound = np.ones(n, np.int64)  # a score must be above 0, and reach the k-th one
        self.scored = 0

    def _asked(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of a node's terms these items ask for, and their rows in ``count``."""
        at = np.minimum(np.searchsorted(self.mine, terms), len(self.mine) - 1)
        use = np.flatnonzero(self.mine[at] == terms)
        return use, at[use]

    def add(self, tree: FPTree, rows: np.ndarray) -> None:
        """Walk the tree, whose documents are ``rows`` in its order; ``rows`` rise with the ids."""
        if tree.root is None or not len(self.mine):
            return
        todo = [(tree.root, np.arange(self.count.shape[1]), None)]
        while todo:
            node, items, bounds = todo.pop()
            if bounds is not None:  # bounds may have risen since it was put there
                items = items[bounds >= self.bound[items]]
            if not len(items):
                continue
            if not node.children:
                self._page(tree, node, items, rows)
                continue
            found = []
            for child in node.children:
                use, at = self._asked(child.terms)
                gains = _gain(self.weight[child.terms[use]], child.most[use], child.least).astype(self.kind)
                most = (gains @ self.count[np.ix_(at, items)].astype(self.kind)).astype(np.int64)
                worth = most >= self.bound[items]
                if worth.any():
                    found.append((int(most.max()), child, items[worth], most[worth]))
            found.sort(key=lambda x: x[0])  # the most promising one is walked first
            todo.extend(x[1:] for x in found)

    def _page(self, tree: FPTree, node: _Node, items: np.ndarray, rows: np.ndarray) -> None:
        use, at = self._asked(node.terms)
        lo, hi = tree.start[node.lo], tree.start[node.hi]
        docs = np.repeat(np.arange(node.hi - node.lo), tree.size[node.lo : node.hi])
        gains = np.zeros((node.hi - node.lo, len(node.terms)), self.kind)
        term = tree.term[lo:hi]
        gains[docs, np.searchsorted(node.terms, term)] = _gain(self.weight[term], tree.tf[lo:hi], tree.m[node.lo : node.hi][docs])
        scores = (gains[:, use] @ self.count[np.ix_(at, items)].astype(self.kind)).astype(np.int64).T
        self.scored += scores.size
        able = np.flatnonzero((scores >= self.bound[items][:, None]).any(1))
        mine = rows[tree.order[node.lo : node.hi]]
        for i in able:
            self._keep(int(items[i]), scores[i], mine)

    def _keep(self, item: int, scores: np.ndarray, rows: np.ndarray) -> None:
        score, row = self.held(item)
        fits = scores >= self.bound[item]
        score, row = np.concatenate([score, scores[fits]]), np.concatenate([row, rows[fits]])
        best = np.lexsort((row, -score))[: self.k]
        self.score[item, : len(best)], self.row[item, : len(best)] = score[best], row[best]
        if len(best) == self.k:
            self.bound[item] = max(1, score[best[-1]])

    def held(self, item: int) -> tuple[np.ndarray, np.ndarray]:
        n = int((self.score[item] > 0).sum())
        return self.score[item, :n], self.row[item, :n]


def _search(vectors: DataFrame, corpus: Broadcast, asked: Broadcast, k: int) -> DataFrame:
    """(item, id, score): each task's ``k`` best documents of each item."""
    kind = vectors.schema["id"].dataType.simpleString()

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = corpus.value
        weight = np.empty_like(c.weight)
        weight[c.place] = c.weight
        groups = _groups(*asked.value, weight, k)
        ids = None  # of the documents that are held
        for batch in batches:
            lengths = np.diff(batch.column("terms").offsets.to_numpy())
            block = np.cumsum(lengths) // TREE_POSTINGS
            edges = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:]):
                part = batch.slice(lo, hi - lo)
                tree = FPTree(*_entries(part, c))
                # Documents are ranked by id together with those held: of equal scores the smaller id is kept.
                held = 0 if ids is None else len(ids)
                ids = part.column("id") if ids is None else pa.concat_arrays([ids, part.column("id")])
                back = pc.array_sort_indices(ids).to_numpy()
                rank = np.empty(len(ids), np.int64)
                rank[back] = np.arange(len(ids))
                for g in groups:
                    g.row = np.where(g.score > 0, rank[g.row], 0)
                    g.add(tree, rank[held:])
                kept = np.unique(np.concatenate([g.row[g.score > 0] for g in groups])).astype(np.int64)
                ids = ids.take(pa.array(back[kept]))
                for g in groups:
                    g.row = np.where(g.score > 0, np.searchsorted(kept, g.row), 0)
        for j, g in enumerate(groups):
            item, at = np.nonzero(g.score)
            if len(item):
                row, score = g.row[item, at], g.score[item, at]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(j * ITEM_GROUP + item, pa.int32()), ids.take(pa.array(row)), pa.array(score, pa.int64())], ["item", "id", "score"]
                )

    return vectors.mapInArrow(trees, f"item int, id {kind}, score bigint")


def _groups(n: int, term: np.ndarray, item: np.ndarray, count: np.ndarray, weight: np.ndarray, k: int) -> list[Items]:
    out = []
    for lo in range(0, n, ITEM_GROUP):
        mine = (item >= lo) & (item < lo + ITEM_GROUP)
        out.append(Items(min(ITEM_GROUP, n - lo), term[mine], item[mine] - lo, count[mine], weight, k))
    return out


def _entries(part: pa.RecordBatch, corpus: Corpus) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, frequency-ordered terms, occurrences and norm of each document."""
    listed = part.column("terms")
    start = listed.offsets.to_numpy().astype(np.int64)
    term = corpus.place[listed.values.to_numpy()[start[0] : start[-1]]] if start[-1] > start[0] else np.zeros(0, np.int64)
    tf = part.column("tfs")
    first = int(tf.offsets[0].as_py())
    tf = tf.values.to_numpy()[first : first + len(term)].astype(np.int64)
    start = start - start[0]
    row = np.repeat(np.arange(len(start) - 1), np.diff(start))
    order = np.lexsort((term, row))
    return start, term[order], tf[order], corpus.norm(part.column("n").to_numpy().astype(np.int64))


def _best(found: DataFrame, keys: list[Column | str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """The ``k`` best documents for each item: ``item_col``, ``rank``, ``id_col``, ``score``.

    Items are answered in blocks of about ``item_bytes`` of text, each in one
    pass over the documents: what is broadcast and held by a task grows with a
    block, not with the items. N, L and df count all documents.

    Null texts have no terms; items without terms, and documents that share no
    term with a positive weight, give no rows. Equal scores go by ascending id,
    null ids last. Every row of ``docs`` is a document of its own, so repeated
    rows take several ranks. Equal rows of ``items`` are one item; rows that
    share an id but not a text are ranked each for itself. Other columns are
    not read; an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    asked = items.select(F.col(item_col).alias("item"), F.col(item_text_col).cast("string").alias("text")).distinct()
    asked = materialize(asked, "items")
    blocks = int((asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // item_bytes) + 1
    block = F.pmod(F.xxhash64("text", "item"), F.lit(blocks))
    kind = items.schema[item_col].dataType.simpleString()
    out = []
    for b in range(blocks):
        rows = [(r["item"], Counter(terms(r["text"]))) for r in asked.where(block == b).collect()]
        rows = [(i, c) for i, c in rows if c]
        if rows:
            found = _ranked(source, [c for _, c in rows], k)
            names = spark.createDataFrame([(j, i) for j, (i, _) in enumerate(rows)], f"item int, name {kind}")  # one block
            out.append(materialize(found.join(F.broadcast(names), "item").drop("item"), "ranked"))
    if not out:
        out.append(spark.createDataFrame([], f"rank int, id {source.schema['id'].dataType.simpleString()}, score bigint, name {kind}"))
    return reduce(DataFrame.unionByName, out).select(F.col("name").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _ranked(source: DataFrame, items: list[Counter], k: int) -> DataFrame:
    """(item, rank, id, score) for one block of items, given as counts of their terms."""
    send = source.sparkSession.sparkContext.broadcast
    words = sorted(set().union(*items))
    prints = _print(words)
    known = np.sort(prints)
    vectors = materialize(_vectors(source, send(known)), "vectors")
    corpus = _corpus(vectors, len(known))
    place = dict(zip(words, corpus.place[np.searchsorted(known, prints)].tolist()))
    asked = np.array([(place[w], j, n) for j, c in enumerate(items) for w, n in c.items()], np.int64)
    found = _search(vectors.where(F.size("terms") > 0), send(corpus), send((len(items), *asked.T)), k)
    # The tasks' results are merged in parts first, so that no task gets all of an item's.
    salted = found.withColumn("salt", F.pmod(F.xxhash64("id", "score"), F.lit(SALTS)))
    return _best(_best(salted, ["item", "salt"], k).drop("rank", "salt"), ["item"], k)

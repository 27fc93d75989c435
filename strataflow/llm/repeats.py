"""Passages that repeat across documents, by prefix-partitioned suffix trees.

Suffixes begin at anchors: the smallest four-word hash of a window, so equal
windows have equal anchors at equal offsets. A suffix takes along the words
before its anchor that its windows need. Suffixes are dealt out by a prefix of
one to four words, longer where a prefix is too common for one group, up to the
whole window. A group sorts its suffixes by their words and reads the tree off
the common prefixes of neighbours: a node of depth d is a stretch of neighbours
that share d words. A second tree of the words before the anchors, read
backwards, extends nodes to the left. Two windows are equal if they share a node
of both trees and the depths add up to the window; a window whose pair of nodes
has a smaller document repeats it. Neighbouring marked windows are joined.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.text import chunks, gather, hash_words, mix, text_column, whole_ids, window_hashes, window_rows

ANCHOR = 4  # words of an anchor, and longest prefix before the whole window
GROUP = 400_000  # suffixes that a group is meant to hold
DEAL_BYTES = 4 << 20  # text whose own copies are settled before the shuffle
MOST_PREFIXES = 1_000_000  # bound of a list of common prefixes: groups grow beyond 12 TB
TASK_GROUPS = 4  # groups that a task is meant to read
CODE_BYTES = 3  # of a word's fingerprint in the trees

_SCHEMA = pa.schema([("grp", pa.int64()), ("kind", pa.int8()), ("blob", pa.binary())])


def row_tags(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 32-bit fingerprint of each row's words, to tell rows of one id apart."""
    place = np.arange(len(words), dtype=np.uint64) - np.repeat(bounds[:-1], np.diff(bounds)).astype(np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(words ^ place))])
    return ((total[bounds[1:]] - total[bounds[:-1]]) >> np.uint64(32)).astype(np.uint32)


class _Windows:
    """The windows of a chunk: row, place, fingerprint, and anchor of each."""

    def __init__(self, part: pa.RecordBatch, size: int) -> None:
        self.words, self.bounds = hash_words(text_column(part, "text"))
        ids = part.column("id")
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        prints = window_hashes(self.words, size)
        row, inside = window_rows(self.bounds, size, len(prints))
        at = np.flatnonzero(inside & known[row])
        self.at, self.row, self.prints = at, row[at], prints[at]
        grams = window_hashes(self.words, min(ANCHOR, size))
        best, where = grams[at], at.copy()
        for o in range(1, size - min(ANCHOR, size) + 1):
            other = grams[at + o]
            better = other < best
            best[better] = other[better]
            where[better] = at[better] + o
        self.anchor = where
        self.tags = row_tags(self.words, self.bounds)

    def runs(self, keep: np.ndarray) -> np.ndarray:
        """Begins of runs of neighbouring kept windows with one anchor (indexes into ``keep``)."""
        new = np.ones(len(keep), bool)
        new[1:] = (np.diff(self.at[keep]) != 1) | (self.anchor[keep][1:] != self.anchor[keep][:-1])
        return np.flatnonzero(new)

    def prefixes(self, anchors: np.ndarray, size: int) -> list[np.ndarray]:
        """Hashes of the first 1, 2, ... words from each anchor on."""
        return [window_hashes(self.words, n)[anchors] for n in range(1, min(ANCHOR, size) + 1)]


def _common(source: DataFrame, size: int, expected: float, group: int) -> list[np.ndarray]:
    """For each prefix length, the sorted hashes of prefixes with over ``group`` suffixes.

    A chunk reports the prefixes that hold at least half the share at which
    they would be too common, so what is not reported adds up to half a group.
    """
    share = group / max(expected, group) / 2

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, "text"):
                windows = _Windows(batch.slice(lo, hi - lo), size)
                anchors = windows.anchor[windows.runs(np.arange(len(windows.at)))]
                for level, prefix in enumerate(windows.prefixes(anchors, size)):
                    value, n = np.unique(prefix, return_counts=True)
                    often = n >= max(1, share * len(anchors))
                    yield pa.RecordBatch.from_pydict(
                        {"level": pa.array([level] * int(often.sum()), pa.int32()), "prefix": value[often].view(np.int64), "n": n[often]}
                    )

    rows = (
        source.mapInArrow(count, "level int, prefix bigint, n bigint")
        .groupBy("level", "prefix").agg(F.sum("n").alias("n")).where(F.col("n") > group).select("level", "prefix").toArrow()
    )
    levels, found = (rows.column(c).to_numpy() for c in ("level", "prefix"))
    return [np.sort(found[levels == k].astype(np.int64).view(np.uint64)) for k in range(min(ANCHOR, size))]


def _in(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    return sorted_values[np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)] == x


def word_codes(words: np.ndarray) -> np.ndarray:
    """A row of ``CODE_BYTES`` bytes for each word, never all zero: zeros fill up short suffixes."""
    code = np.maximum(words >> np.uint64(64 - 8 * CODE_BYTES), np.uint64(1))
    return code.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - CODE_BYTES :]


class Tree:
    """The tree of many word sequences: their sorted order, and the words that neighbours share.

    Sequence i has ``lengths[i]`` words of ``codes``, from ``starts[i]`` on in
    steps of ``step``; words beyond ``depth`` do not count.
    """

    def __init__(self, codes: np.ndarray, starts: np.ndarray, lengths: np.ndarray, depth: int, step: int) -> None:
        if not depth:
            self.order, self.shared = np.arange(len(starts)), -(np.arange(len(starts)) == 0).astype(np.int64)
            return
        place = np.arange(depth)
        inside = place < lengths[:, None]
        rows = codes[np.where(inside, starts[:, None] + step * place, 0)]
        rows[~inside] = 0
        rows = rows.reshape(len(starts), depth * CODE_BYTES)
        padded = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8))).view(">u8").astype(np.uint64)
        self.order = np.lexsort(padded.T[::-1])
        rows = rows[self.order]
        unlike = np.ones((len(rows), depth + 1), bool)
        unlike[1:, :depth] = (rows[1:] != rows[:-1]).reshape(-1, depth, CODE_BYTES).any(2)
        self.shared = unlike.argmax(1)
        self.shared[:1] = -1

    def nodes(self, depth: int) -> np.ndarray:
        """For each sequence, its node of that depth."""
        out = np.empty(len(self.order), np.int64)
        out[self.order] = np.cumsum(self.shared < depth) - 1
        return out


def smaller_elsewhere(
    codes: np.ndarray, anchors: np.ndarray, before: np.ndarray, counts: np.ndarray, ids: np.ndarray, size: int
) -> np.ndarray:
    """For all windows of all suffixes in a row, whether a smaller id has the window too.

    Suffix i has ``counts[i]`` windows, the first one begins ``before[i]`` words before its anchor.
    """
    reach = size - min(ANCHOR, size)
    right = Tree(codes, anchors, counts + size - 1 - before, size, 1)
    left = Tree(codes, anchors - 1, before, reach, -1)
    base = np.cumsum(counts) - counts
    later = np.zeros(int(counts.sum()), bool)
    for offset in range(reach + 1):
        mine = np.flatnonzero((before >= offset) & (before - counts < offset))
        if not len(mine):
            continue
        node = right.nodes(size - offset)[mine] * len(anchors) + left.nodes(offset)[mine]
        order = np.argsort(node, kind="stable")
        begin = np.flatnonzero(np.diff(node[order], prepend=-1))
        least = np.minimum.reduceat(ids[mine][order], begin)
        mine = mine[order]
        later[base[mine] + before[mine] - offset] = ids[mine] > np.repeat(least, np.diff(np.append(begin, len(mine))))
    return later


def _suffixes(part: pa.RecordBatch, size: int, common: list[np.ndarray], groups: int) -> Iterator[tuple[int, int, bytes]]:
    """(group, kind, blob): repeats found by the tree of the chunk (kind 0), and the suffixes of
    its distinct windows (kind 1), each window with the smallest id that has it here."""
    w = _Windows(part, size)
    if not len(w.at):
        return
    ids = w.ids[w.row].astype(np.int64)
    place = w.at - w.bounds[:-1][w.row]
    codes = word_codes(w.words)
    begins = w.runs(np.arange(len(w.at)))
    counts = np.diff(np.append(begins, len(w.at)))
    later = smaller_elsewhere(codes, w.anchor[begins], w.anchor[begins] - w.at[begins], counts, ids[begins], size)
    marks = np.flatnonzero(later)
    if len(marks):
        yield int(mix(w.prints[:1])[0] % np.uint64(groups)), 0, _pack_spans(ids[marks], w.tags[w.row[marks]], place[marks])
    # All rows with the smallest id here go on: they may be copies of a document elsewhere.
    keep = np.flatnonzero(~later)
    begins = w.runs(keep)
    anchors = w.anchor[keep[begins]]
    prefixes = w.prefixes(anchors, size)
    key, still = prefixes[0].copy(), np.ones(len(anchors), bool)
    for level in range(len(prefixes) - 1):
        still &= _in(common[level], prefixes[level])
        key[still] = prefixes[level + 1][still]
    whole = still & _in(common[-1], prefixes[-1])  # too common at any length: each window by itself
    if whole.any():
        run = np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(keep))))
        begins = np.union1d(begins, np.flatnonzero(whole[run]))
        key = np.where(whole[run[begins]], w.prints[keep[begins]], key[run[begins]])
    counts = np.diff(np.append(begins, len(keep)))
    group = (mix(key) % np.uint64(groups)).astype(np.int64)
    by_group = np.argsort(group, kind="stable")
    head = keep[begins][by_group]
    counts, group = counts[by_group], group[by_group]
    sizes = counts + size - 1
    words = gather(codes, w.at[head], sizes)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1))
    for lo, hi in zip(edges[:-1], edges[1:]):
        mine = head[lo:hi]
        yield int(group[lo]), 1, b"".join(
            (
                np.array([hi - lo, ends[hi] - ends[lo]], np.int64).tobytes(),
                _planes(ids[mine], np.int64),
                _planes(w.tags[w.row[mine]], np.uint32),
                _planes(place[mine], np.uint32),
                _planes(w.anchor[mine] - w.at[mine], np.uint16),
                _planes(counts[lo:hi], np.uint16),
                words[ends[lo] : ends[hi]].tobytes(),
            )
        )


def _pack_spans(ids: np.ndarray, tags: np.ndarray, place: np.ndarray) -> bytes:
    """Neighbouring window places of one row as (id, tag, first, number)."""
    if not len(ids):
        return b""
    new = np.ones(len(ids), bool)
    new[1:] = (np.diff(place) != 1) | (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])
    begin = np.flatnonzero(new)
    n = np.diff(np.append(begin, len(ids)))
    return np.stack([ids[begin].astype(np.int64), tags[begin].astype(np.int64), place[begin].astype(np.int64), n]).T.tobytes()


def _planes(values: np.ndarray, kind: type) -> bytes:
    """Numbers as byte planes: the upper ones are nearly all zero, which compresses well."""
    return values.astype(kind).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()


def _numbers(planes: bytes, n: int, at: int, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8, n * width, at).reshape(width, n).T).view(kind).ravel()


def _unpack(blob: bytes) -> list[np.ndarray]:
    suffixes, words = np.frombuffer(blob, np.int64, 2)
    out, at = [], 16
    for kind in (np.int64, np.uint32, np.uint32, np.uint16, np.uint16):
        out.append(_numbers(blob, suffixes, at, kind))
        at += out[-1].nbytes
    return [*out, np.frombuffer(blob, np.uint8, words * CODE_BYTES, at).reshape(-1, CODE_BYTES)]


def _deep_nodes(table: pa.Table, size: int) -> pa.Table:
    """The windows of a group whose deep node has a smaller document, as spans."""
    marks, parts = [], []
    for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()):
        (parts if kind else marks).append(blob)
    if parts:
        ids, tags, place, before, counts, codes = (np.concatenate(c) for c in zip(*map(_unpack, parts)))
        before, counts = before.astype(np.int64), counts.astype(np.int64)
        sizes = counts + size - 1
        hit = np.flatnonzero(smaller_elsewhere(codes, np.cumsum(sizes) - sizes + before, before, counts, ids, size))
        ends = np.cumsum(counts)
        run = np.searchsorted(ends, hit, "right")
        marks.append(_pack_spans(ids[run], tags[run], place[run].astype(np.int64) + hit - (ends - counts)[run]))
    spans = np.frombuffer(b"".join(marks), np.int64).reshape(-1, 4)
    return pa.table({"id": spans[:, 0], "tag": spans[:, 1], "first": spans[:, 2].astype(np.int32), "n": spans[:, 3].astype(np.int32)})


def repeat_spans(df: DataFrame, size: int = 13, *, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """(id, tag, first, n): ``n`` windows from word ``first`` on that a smaller id also has."""
    source = df.select(whole_ids(df, id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    expected = total / 33  # six bytes a word, five and a half windows an anchor
    group = int(max(group, expected / MOST_PREFIXES))
    shared = df.sparkSession.sparkContext.broadcast(_common(source, size, expected, group))
    groups = max(1, int(2 * expected / group))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, "text", limit=DEAL_BYTES):
                rows = list(_suffixes(batch.slice(lo, hi - lo), size, shared.value, groups))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    dealt = source.mapInArrow(deal, "grp bigint, kind tinyint, blob binary")
    tasks = groups // TASK_GROUPS
    if tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        dealt = dealt.repartition(tasks, "grp")
    return dealt.groupBy("grp").applyInArrow(lambda table: _deep_nodes(table, size), "id bigint, tag bigint, first int, n int")


def remove_repeats(df: DataFrame, size: int = 13, *, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """One row per input row: ``id_col``, ``n_words``, ``n_removed``, ``kept`` (words joined by
    one space) and ``repeats`` (removed word ranges, end exclusive).

    A word goes if a window of ``size`` words that covers it also starts in a
    row with a smaller id; windows are judged on the input. Ids are integers.
    Null and empty texts have no words, texts shorter than a window lose none.
    Rows that share an id are no copies of each other, and rows without an id
    neither lose words nor make others lose them. Other columns are not read;
    an empty table gives an empty result. Words are compared by 24 bits of their
    hash, windows word by word.
    """
    spans = repeat_spans(df, size, id_col=id_col, text_col=text_col, group=group)
    per_row = spans.groupBy(F.col("id").alias("key")).agg(F.collect_list(F.struct("tag", "first", "n")).alias("spans"))
    source = df.select(whole_ids(df, id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    # Rows without an id match nothing; their hash keeps them out of one task.
    source = source.withColumn("key", F.coalesce("id", F.xxhash64("text")))
    span_type = pa.list_(pa.list_(pa.int32()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, "text"):
                part = batch.slice(lo, hi - lo)
                column = text_column(part, "text")
                tags = row_tags(*hash_words(column))
                out = {"n_words": [], "n_removed": [], "kept": [], "repeats": []}
                for i, text, tag, marks in zip(
                    part.column("id").to_pylist(), column.to_pylist(), tags.tolist(), part.column("spans").to_pylist()
                ):
                    words = text.encode("utf-8").split()
                    mine = sorted((m["first"], m["n"]) for m in marks or () if m["tag"] == tag and i is not None)
                    keep = bytearray(b"\x01") * len(words)
                    ranges: list[list[int]] = []
                    for first, n in mine:
                        end = first + n + size - 1
                        keep[first:end] = bytes(end - first)
                        if ranges and first <= ranges[-1][1]:
                            ranges[-1][1] = max(ranges[-1][1], end)
                        else:
                            ranges.append([first, end])
                    kept = list(itertools.compress(words, keep)) if mine else words
                    out["n_words"].append(len(words))
                    out["n_removed"].append(len(words) - len(kept))
                    out["kept"].append(b" ".join(kept))
                    out["repeats"].append(ranges)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(out["n_words"], pa.int64()),
                        pa.array(out["n_removed"], pa.int64()),
                        pa.array(out["kept"], pa.binary()).cast(pa.string()),
                        pa.array(out["repeats"], span_type),
                    ],
                    ["id", "n_words", "n_removed", "kept", "repeats"],
                )

    return (
        source.join(per_row, "key", "left")
        .select("id", "text", "spans")
        .mapInArrow(cut, "id bigint, n_words bigint, n_removed bigint, kept string, repeats array<array<int>>")
        .withColumnRenamed("id", id_col)
    )

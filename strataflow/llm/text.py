"""Words and their 64-bit fingerprints, computed over whole Arrow columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACES = b" \t\n\v\f\r"
CHUNK_BYTES = 1 << 20  # text worked on at once; a longer text is a chunk of its own
BLOCK_BYTES = 1 << 18  # text whose bytes are hashed at once

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BYTE = np.random.default_rng(20240611).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_OR_SPACE = _BYTE.copy()
_BYTE[_IS_SPACE] = 0
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 output bits (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def text_column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    """A column as large strings; null counts as empty."""
    column = batch.column(name)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.large_string()).fill_null("")


def chunks(batch: pa.RecordBatch, *names: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts, in all the columns named, have about ``limit`` bytes together."""
    if not batch.num_rows:
        return
    sizes = sum(np.diff(_bytes(text_column(batch, name))[1]) for name in names)
    block = np.cumsum(sizes) // limit
    cuts = np.flatnonzero(np.diff(block)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    yield from zip(edges[:-1], edges[1:])


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def hash_words(column: pa.Array, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words, and where each row's words begin and end.

    A word is a longest run without ASCII white space. ``lower`` folds A-Z.
    The second array has one entry more than the column has rows.
    """
    data, starts, lengths, bounds = word_spans(column, lower=lower)
    return span_hashes(data, starts, lengths), bounds


def word_spans(
    column: pa.Array, *, lower: bool = False, inside: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all rows, start and length of each word, and where each row's words begin and end.

    ``inside`` says for each byte value whether it is part of a word.
    """
    data, offsets = _bytes(column)
    if lower:
        data = _LOWER[data]
    part = np.zeros(len(data) + 1, bool)
    part[:-1] = (~_IS_SPACE if inside is None else inside)[data]
    edges = offsets[(offsets > 0) & (offsets < len(data))]
    marks = part.copy()
    marks[1:] &= ~part[:-1]
    marks[edges] = part[edges]
    starts = np.flatnonzero(marks)
    np.copyto(marks, part)
    marks[:-1] &= ~part[1:]
    marks[edges - 1] = part[edges - 1]
    stops = np.flatnonzero(marks)
    return data, starts, stops + 1 - starts, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, *, spaces: bool = False) -> np.ndarray:
    """Fingerprints of byte spans given in order; white space in them counts only with ``spaces``.

    Works on blocks of about ``BLOCK_BYTES``, so that what it needs beside the
    result does not grow with the input, whatever the length of a span.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    out = np.empty(len(starts), np.uint64)
    values, ends = _BYTE_OR_SPACE if spaces else _BYTE, starts + lengths
    lo = 0
    while lo < len(starts):
        hi = max(lo + 1, int(np.searchsorted(ends, starts[lo] + BLOCK_BYTES, "right")))
        if hi == lo + 1 and lengths[lo] > BLOCK_BYTES:
            out[lo] = _long_span(data[starts[lo] : ends[lo]], values)
        else:
            out[lo:hi] = _block_sums(data, starts[lo:hi], lengths[lo:hi], values)
        lo = hi
    return mix(out)


def _block_sums(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    first, last = int(starts[0]), int(starts[-1] + lengths[-1])
    gaps = np.diff(np.append(starts, last))
    place = np.arange(last - first, dtype=np.int32) - np.repeat((starts - first).astype(np.int32), gaps)
    inside = place < np.repeat(lengths.astype(np.int32), gaps)
    place[~inside] = 0
    value = values[data[first:last]]
    value *= _powers(int(lengths.max()))[place]
    value[~inside] = 0
    return np.add.reduceat(value, starts - first)


def _long_span(data: np.ndarray, values: np.ndarray) -> np.uint64:
    """The sum of one span that is longer than a block, piece by piece."""
    powers = _powers(BLOCK_BYTES + 1)
    total, shift = np.zeros(1, np.uint64), np.ones(1, np.uint64)
    for at in range(0, len(data), BLOCK_BYTES):
        piece = values[data[at : at + BLOCK_BYTES]]
        total += np.sum(piece * powers[: len(piece)], dtype=np.uint64) * shift
        shift *= powers[BLOCK_BYTES]
    return total[0]


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Fingerprint of the ``size`` words from each position on (rows are not told apart)."""
    n = max(0, len(words) - size + 1)
    out = np.zeros(n, np.uint64)
    for j, power in enumerate(_powers(size, _STEP)):
        out += words[j : j + n] * power
    return mix(out + np.uint64(size))


def window_rows(bounds: np.ndarray, size: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row of each of ``n`` window positions, and whether the window stays inside it."""
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    return row, np.arange(n) + size <= bounds[1:][row]


def whole_ids(df: DataFrame, name: str) -> Column:
    """The id column as ``bigint``; ids of other types than integers are refused, not lost."""
    kind = df.schema[name].dataType
    if not isinstance(kind, (T.IntegralType, T.NullType)):
        raise TypeError(f"column {name!r} must hold integers, not {kind.simpleString()}")
    return F.col(name).cast("bigint")


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column of ``taken`` has it, whatever its case."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name += "_"
    return name


def row_sums(values: np.ndarray, bounds: np.ndarray, dtype: type = np.int64) -> np.ndarray:
    """Sum of each row's values; row i has those from ``bounds[i]`` to ``bounds[i + 1]``."""
    out = np.zeros(len(bounds) - 1, dtype)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.add.reduceat(values[: bounds[-1]], bounds[:-1][some], dtype=dtype)
    return out


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows, and where each row's begin and end."""
    return _bytes(column)


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices ``flat[start : start + length]`` one behind the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.repeat(starts - ends + lengths, lengths) + np.arange(total)]

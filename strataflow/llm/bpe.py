"""Byte-pair encoding and decoding as bounded-lookahead streaming transducers.

The encoder reads one symbol after the other. A token is emitted as soon as
``lookahead`` further symbols are known, since no later symbol can change it;
the buffer never holds more than that bound and one block. The decoder is a
state machine that keeps at most an unfinished UTF-8 sequence.
"""

from __future__ import annotations

import codecs
import json
import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strataflow.llm.text import chunks, gather, span_hashes, text_column

BLOCK = 128  # symbols read between two emissions

# Fixed value: white space of the vocabulary file's word pattern.
SPACE = "\t\n\v\f\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    symbols = {b: chr(b) for b in printable}
    spare = iter(range(256, 512))
    return [symbols.get(b) or chr(next(spare)) for b in range(256)]


class _Ranks(dict):
    def __missing__(self, pair):
        return _NEVER


_NEVER = 1 << 60

PIECE = 1 << 19  # characters of a long text that are encoded at once
_CUT = re.compile(" (?=[A-Za-z0-9])")
_SPREAD, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(43)


class MergeList:
    """Vocabulary, ranked merges and the lookahead that suffices for them."""

    def __init__(self, vocabulary: dict[str, int], merges: list, suffix: str = "") -> None:
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        self.suffix, self.vocabulary = suffix, vocabulary
        self.ranks = _Ranks()
        self.made: list[int] = []
        for rank, (left, right) in enumerate(pairs):
            self.ranks[vocabulary[left], vocabulary[right]] = rank
            self.made.append(vocabulary[left + right])
        symbols = byte_symbols()
        self.inner = [vocabulary[s] for s in symbols]
        self.last = [vocabulary[s + suffix] for s in symbols]
        self.lookahead = self._sufficient(pairs)
        self._made = np.asarray(self.made, np.int64)
        keys = np.array([(a << 32) | b for a, b in self.ranks], np.int64)
        slots = (keys.astype(np.uint64) * _SPREAD) >> _SHIFT
        size = 1 << int(64 - int(_SHIFT))
        self._slot_key, self._slot_rank = np.full(size, -1, np.int64), np.full(size, _NEVER, np.int64)
        self._slot_key[slots], self._slot_rank[slots] = keys, np.fromiter(self.ranks.values(), np.int64)
        self._clash = np.bincount(slots.astype(np.int64), minlength=size) > 1

    def _width(self, token: str) -> int:
        return len(token.removesuffix(self.suffix)) if self.suffix and token != self.suffix else len(token)

    def _sufficient(self, pairs: list[tuple[str, str]]) -> int:
        """Symbols to the right of a boundary that can decide whether it lasts.

        Whether merge i = (u, v) applies depends on the symbols of v, and on an
        earlier merge j that takes a right-edge part of v as its left side: that
        one reaches as far again. One pass in rank order carries the longest
        such chain; a token's own width covers merges that reach into it.
        """
        edges: dict[str, set[str]] = defaultdict(set)  # right-edge parts of a token
        reach: dict[str, int] = {}  # of merges so far, by their left side
        longest = widest = 1
        for left, right in pairs:
            parts = edges[right] | {right}
            edges[left + right] |= parts
            far = self._width(right) + max((reach[p] for p in parts if p in reach), default=0)
            reach[left] = max(reach.get(left, 0), far)
            longest, widest = max(longest, far), max(widest, self._width(left + right))
        return longest + widest

    def merge(self, ids: list[int]) -> list[int]:
        """Apply the merges to a short row of symbols: lowest rank first, then leftmost."""
        look, made, never = self.ranks.__getitem__, self.made, _NEVER
        ids = list(ids)
        ranks = list(map(look, zip(ids, ids[1:])))
        while ranks:
            rank = min(ranks)
            if rank == never:
                break
            i = ranks.index(rank)
            ids[i] = whole = made[rank]
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = look((ids[i - 1], whole))
            if i < len(ranks):
                ranks[i] = look((whole, ids[i + 1]))
        return ids

    def tokens(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of many words (byte spans) in a row, and how many each has.

        Words of one length that fit in a quarter block are merged side by
        side; longer ones go through ``stream``.
        """
        counts = np.zeros(len(starts), np.int64)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        order = np.argsort(sizes, kind="stable")
        edges = np.searchsorted(sizes[order], np.arange(1, BLOCK // 4 + 2))
        for size in range(1, BLOCK // 4 + 1):
            rows = order[edges[size - 1] : edges[size]]
            if len(rows):
                ids, n = self._side_by_side(data[starts[rows][:, None] + np.arange(size)])
                counts[rows] = n
                found.append((rows, ids))
        for row in order[edges[-1] :]:
            ids = np.fromiter(self.stream(data[starts[row] : starts[row] + sizes[row]].tobytes()), np.uint32)
            counts[row] = len(ids)
            found.append((np.array([row]), ids))
        flat = np.zeros(int(counts.sum()), np.uint32)
        begin = np.cumsum(counts) - counts
        for rows, ids in found:
            n = counts[rows]
            flat[np.repeat(begin[rows] - np.cumsum(n) + n, n) + np.arange(len(ids))] = ids
        return flat, counts

    def _side_by_side(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge words of one length, a row each: every step takes each row's best pair."""
        count, size = words.shape
        ids = np.asarray(self.inner, np.int64)[words]
        ids[:, -1] = np.asarray(self.last, np.int64)[words[:, -1]]
        left = np.full(count, size, np.int64)  # symbols still in each row
        ranks = self._look(ids[:, :-1], ids[:, 1:])
        rows = np.arange(count)
        while size > 1 and len(rows):
            own = ranks[rows]
            place = own.argmin(1)
            rank = own[np.arange(len(rows)), place]
            going = rank < _NEVER
            rows, place, rank = rows[going], place[going], rank[going]
            if not len(rows):
                break
            # Close the gap behind the merged pair; what falls off the end is never read.
            column = np.arange(size - 1)
            old = ids[rows]
            moved = np.where(column > place[:, None], old[:, 1:], old[:, :-1])
            here = np.arange(len(rows))
            moved[here, place] = self._made[rank]
            shift = np.concatenate([ranks[rows], np.full((len(rows), 1), _NEVER, np.int64)], 1)
            ranks_new = np.where(column > place[:, None], shift[:, 1:], shift[:, :-1])
            left[rows] -= 1
            ids[rows, :-1] = moved
            before = place > 0
            ranks_new[here[before], place[before] - 1] = self._look(moved[here[before], place[before] - 1], moved[here[before], place[before]])
            after = place + 1 < left[rows]
            ranks_new[here[~after], place[~after]] = _NEVER
            ranks_new[here[after], place[after]] = self._look(moved[here[after], place[after]], moved[here[after], place[after] + 1])
            ranks[rows] = ranks_new
        keep = np.arange(size) < left[:, None]
        return ids[keep].astype(np.uint32), left

    def _look(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, by a direct table and a small list of its clashes."""
        key = (left << 32) | right
        slot = (key.astype(np.uint64) * _SPREAD) >> _SHIFT
        rank = np.where(self._slot_key[slot] == key, self._slot_rank[slot], _NEVER)
        lost = self._clash[slot]
        if lost.any():
            rank[lost] = np.fromiter((self.ranks[k >> 32, k & 0xFFFFFFFF] for k in key[lost].tolist()), np.int64)
        return rank

    def stream(self, word: Iterable[int]) -> Iterator[int]:
        """Tokens of one word's bytes, each emitted once it is stable."""
        full = self.lookahead + BLOCK
        if isinstance(word, bytes) and len(word) <= full:
            yield from self.whole(word)
            return
        widths = self.widths
        buffer: list[int] = []
        source = iter(word)
        ahead = next(source, None)
        while ahead is not None:
            byte, ahead = ahead, next(source, None)
            buffer.append(self.inner[byte] if ahead is not None else self.last[byte])
            if len(buffer) == full and ahead is not None:
                done = 0
                for token in self.merge(buffer):
                    if done + widths[token] > full - self.lookahead:
                        break
                    done += widths[token]
                    yield token
                del buffer[:done]
        yield from self.merge(buffer)

    def whole(self, word: bytes) -> list[int]:
        """Tokens of a word that fits the buffer."""
        return self.merge([*map(self.inner.__getitem__, word[:-1]), self.last[word[-1]]]) if word else []

    @cached_property
    def widths(self) -> dict[int, int]:
        return {i: self._width(t) for t, i in self.vocabulary.items()}


def _classes() -> np.ndarray:
    """Class of each code point: 0 white space, 1 letter, 2 number, 3 other."""
    kinds = {"L": 1, "N": 2}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], 3) for c in range(sys.maxunicode + 1)), np.uint8)
    table[list(map(ord, SPACE))] = 0
    return table


class Encoder:
    """Text to ids: normal form, lower case, words, then the transducer for each distinct word."""

    def __init__(self, model: str) -> None:
        spec = json.loads(model)
        bpe = spec["model"]
        self.merges = MergeList(bpe["vocab"], bpe["merges"], bpe.get("end_of_word_suffix") or "")
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.split_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or "(?!)")
        self.classes = _classes()

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's ids begin and end."""
        parts, owner, ids = [], [], []  # pieces between special tokens; the text of each; a special token or -1
        for k, text in enumerate(texts):
            at = 0
            for found in self.split_special.finditer(text) if "<" in text else ():
                parts += [text[at : found.start()], ""]
                ids += [-1, self.special[found[0]]]
                owner += [k, k]
                at = found.end()
            parts.append(text[at:])
            ids.append(-1)
            owner.append(k)
        flat, counts = self._plain([self._normal(p) for p in parts])
        marks = np.array(ids, np.int64)
        if (marks >= 0).any():
            flat = np.insert(flat, np.cumsum(counts)[marks >= 0], marks[marks >= 0].astype(np.uint32))
            counts = counts + (marks >= 0)
        per_text = np.bincount(np.array(owner, np.int64), counts, len(texts)).astype(np.int64)
        return flat, np.concatenate([[0], np.cumsum(per_text)])

    @staticmethod
    def _normal(text: str) -> str:
        if not text.isascii():
            # Lower-casing is by single characters: no final sigma.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return text.lower()

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of normalised texts in a row, and how many each has."""
        joined = "\n".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        if not len(points):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        starts, lengths = self._words(points)
        width = 1 + (points > 0x7F) + (points > 0x7FF).astype(np.int64) + (points > 0xFFFF)
        at = np.concatenate([[0], np.cumsum(width)])
        data = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
        first, size = at[starts], at[starts + lengths] - at[starts]
        _, picked, which = np.unique(span_hashes(data, first, size), return_index=True, return_inverse=True)
        tokens, n = self.merges.tokens(data, first[picked], size[picked])
        flat = gather(tokens, (np.cumsum(n) - n)[which], n[which])
        place = np.searchsorted(starts, begins)
        total = np.concatenate([[0], np.cumsum(n[which])])
        return flat, total[place[1:]] - total[place[:-1]]

    def _words(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Spans of words: letters in a row, single numbers, others in a row, and
        the contractions 's 't 're 've 'm 'll 'd where a word would begin with the mark."""
        kind = self.classes[points]
        begin = np.ones(len(points) + 1, bool)
        begin[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        padded = np.concatenate([points, np.zeros(3, np.uint32)])
        mark = np.flatnonzero((points == 0x27) & begin[:-1])
        one, two = padded[mark + 1], padded[mark + 2]
        short = np.isin(one, [ord(c) for c in "stmd"])
        double = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((two == ord("l")) & (one == ord("l")))
        for found, size in ((short, 2), (double & ~short, 3)):
            begin[mark[found] + 1] = False
            begin[mark[found] + size] = True
        edges = np.flatnonzero(begin)
        starts, lengths = edges[:-1], np.diff(edges)
        keep = kind[starts] != 0
        return starts[keep], lengths[keep]


class Decoder:
    """Ids to text, token by token.

    ``joined`` gives what a vocabulary file without a decoder means: token
    strings with one space between. ``feed``/``flush`` restore the bytes
    behind the tokens and hold back only an unfinished UTF-8 sequence.
    """

    def __init__(self, model: str) -> None:
        spec = json.loads(model)
        self.suffix = spec["model"].get("end_of_word_suffix") or ""
        self.token = {i: t for t, i in spec["model"]["vocab"].items()}
        self.special = {t["id"]: t["content"] for t in spec.get("added_tokens", [])}
        self.token.update(self.special)
        self.byte = {s: b for b, s in enumerate(byte_symbols())}
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def joined(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the token strings with one space between."""
        flat, starts, lengths = self._table
        return gather(flat, starts[ids], lengths[ids])[:-1].tobytes()

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        strings = [self.token.get(i, "").encode() + b" " for i in range(max(self.token) + 1)]
        lengths = np.array(list(map(len, strings)))
        return np.frombuffer(b"".join(strings), np.uint8), np.cumsum(lengths) - lengths, lengths

    def feed(self, token_id: int) -> str:
        token = self.token[token_id]
        if token_id in self.special:
            return self.flush() + token
        ends = bool(self.suffix) and token.endswith(self.suffix)
        data = bytes(self.byte[c] for c in (token.removesuffix(self.suffix) if ends else token))
        return self.state.decode(data) + (self.flush() + " " if ends else "")

    def flush(self) -> str:
        return self.state.decode(b"", True)

    def text(self, ids: Iterable[int]) -> str:
        return "".join(map(self.feed, ids)) + self.flush()


_LOADED: dict[int, tuple[Encoder, Decoder]] = {}


def _loaded(model: str) -> tuple[Encoder, Decoder]:
    key = hash(model)
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(model), Decoder(model)
    return _LOADED[key]


def pieces(text: str, size: int = PIECE) -> Iterator[str]:
    """A text cut into pieces of about ``size`` characters that are encoded alike one by one.

    Cuts are between a space and an ASCII letter or digit: no word, no special
    token without spaces and no composed character reaches over one. A stretch
    without such a place stays whole.
    """
    at = 0
    while len(text) - at > size:
        found = _CUT.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start() + 1]
        at = found.start() + 1
    yield text[at:]


def encode_decode(df: DataFrame, model_path: str, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: its id, ``n_tokens``, ``ids`` (packed unsigned 32-bit, little-endian) and ``decoded``.

    One pass without a shuffle. Null and empty texts give no tokens and an
    empty decoded text; null ids and repeated rows are kept as they are; other
    columns are not read; an empty table gives an empty result. Texts of any
    length are read whole: long ones in pieces, so that beside a text and its
    result a task holds arrays of one piece. The vocabulary file (a bounded few MB) is read on
    the driver and sent to the tasks.
    """
    spark = df.sparkSession
    with open(model_path, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    source = df.select(df[id_col].alias("id"), df[text_col].cast("string").alias("text"))
    schema = pa.schema([("n_tokens", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = _loaded(shared.value)
        cuttable = not any(" " in token for token in encoder.special)
        for batch in batches:
            for lo, hi in chunks(batch, "text"):
                part = batch.slice(lo, hi - lo)
                texts = text_column(part, "text").to_pylist()
                if cuttable and max(map(len, texts)) > PIECE:
                    each = [np.concatenate([encoder.encode(p) for p in pieces(t)]) for t in texts]
                    flat, at = np.concatenate(each), np.cumsum([0, *map(len, each)])
                else:
                    flat, at = encoder.encode_batch(texts)
                ids = [flat[a:b] for a, b in zip(at[:-1], at[1:])]
                columns = [np.diff(at), [x.astype("<u4").tobytes() for x in ids], [decoder.joined(x) for x in ids]]
                arrays = [pa.array(c, f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays([part.column("id"), *arrays], ["id", *schema.names])

    kind = source.schema["id"].dataType.simpleString()
    out = source.mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary, decoded string")
    return out.withColumnRenamed("id", id_col)

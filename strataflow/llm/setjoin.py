"""Documents whose shingle sets are alike: a grouped prefix join.

Shingles are ordered from rare to common. Two sets that are similar enough
share a shingle among the first few of each (their prefixes). Equal sets are
one node, and nodes with the same prefix and size are one group: groups are
paired through their prefixes, and only pairs that pass are expanded to nodes
and verified on the texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.components import components, tasks_for
from strataflow.llm.text import chunks, free_name, hash_words, mix, text_column, whole_ids, window_hashes, window_rows
from strataflow.session import materialize

ORDER_BITS = 21  # size of the table of shingle counts: fixed, whatever the corpus
SLICES = 64
GROUP = 400_000  # postings that one task is meant to hold
MAP_BITS = 512  # of a node's bitmap
DEAL_BYTES = 2 << 20  # text whose copies are found before the shuffle
SEEN = 100_000  # sets that a task remembers having sent
TASK_PAIRS = 2_000  # pairs whose texts one task is meant to compare
BROADCAST_IDS = 2_000_000  # 16 MB; beyond, documents are found by a shuffle join

_WORDS = MAP_BITS // 64
_BITS = [f"m{k}" for k in range(_WORDS)]


class _Sets:
    """Distinct shingles of each row, sorted by row and hash."""

    def __init__(self, column: pa.Array, size: int) -> None:
        words, bounds = hash_words(column, lower=True)
        n = np.diff(bounds)
        prints = window_hashes(words, size)
        row, inside = window_rows(bounds, size, len(prints))
        hashes, rows = [prints[inside]], [row[inside]]
        for short in range(1, size):  # fewer words than a shingle: the whole sequence is one
            few = np.flatnonzero(n == short)
            if len(few):
                hashes.append(window_hashes(words, short)[bounds[few]])
                rows.append(few)
        h, r = np.concatenate(hashes), np.concatenate(rows)
        order = np.lexsort((h, r))
        h, r = h[order], r[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
        self.hash, self.row = h[new], r[new]
        self.n = np.bincount(self.row, minlength=len(column))
        self.bounds = np.concatenate([[0], np.cumsum(self.n)])
        self.sid = mix(self._sums(mix(self.hash ^ np.uint64(0x5DEECE66D))) + self.n.astype(np.uint64)).view(np.int64)

    def _sums(self, values: np.ndarray) -> np.ndarray:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
        return total[self.bounds[1:]] - total[self.bounds[:-1]]


def _planes(counts: np.ndarray) -> bytes:
    """Counts as four byte planes: the upper ones are nearly all zero, which compresses well."""
    return counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _counted(planes: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _counts(source: DataFrame, size: int) -> np.ndarray:
    """How often shingles fall in each of 2^ORDER_BITS buckets, as 4 * log2 (one byte each)."""
    width = (1 << ORDER_BITS) // SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for lo, hi in chunks(batch, "text"):
                sets = _Sets(text_column(batch.slice(lo, hi - lo), "text"), size)
                table += np.bincount((sets.hash >> np.uint64(64 - ORDER_BITS)).astype(np.int64), minlength=len(table))
        if table.any():
            yield pa.RecordBatch.from_pydict(
                {"slice": pa.array(range(SLICES), pa.int32()), "n": [_planes(table[k * width : (k + 1) * width]) for k in range(SLICES)]}
            )

    def add(table: pa.Table) -> pa.Table:
        total = sum(_counted(b) for b in table.column("n").to_pylist())
        return pa.table({"slice": table.column("slice")[:1], "n": [np.floor(4 * np.log2(1 + total)).astype(np.uint8).tobytes()]})

    order = np.zeros(1 << ORDER_BITS, np.uint8)
    for r in source.mapInArrow(count, "slice int, n binary").groupBy("slice").applyInArrow(add, "slice int, n binary").collect():
        order[r["slice"] * width : (r["slice"] + 1) * width] = np.frombuffer(r["n"], np.uint8)
    return order


# What the posting groups hand on; kind 0: pair of groups (a, b); 1: member a of a list of
# three or more; 2: first member a of a part of a split list; 3: node a (set b) of row id.
_OUT = "kind tinyint, tok bigint, a bigint, b bigint, n int, nb int, early boolean, id bigint, " + ", ".join(f"{m} bigint" for m in _BITS)
_OUT_SCHEMA = pa.schema(
    [("kind", pa.int8()), ("tok", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int32()), ("nb", pa.int32()), ("early", pa.bool_()), ("id", pa.int64())]
    + [(m, pa.int64()) for m in _BITS]
)


def _out(kind: int, rows: int, **columns) -> pa.Table:
    given = {"kind": np.full(rows, kind, np.int8), **columns}
    return pa.table({f.name: pa.array(given[f.name], f.type) if f.name in given else pa.nulls(rows, f.type) for f in _OUT_SCHEMA}, schema=_OUT_SCHEMA)


def _six(values: np.ndarray) -> bytes:
    """Numbers of 48 bits, in six bytes each."""
    return (values & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() + (values >> np.uint64(32)).astype(np.uint16).tobytes()


def _six_back(blob: bytes, n: int, at: int) -> np.ndarray:
    low, high = np.frombuffer(blob, np.uint32, n, at), np.frombuffer(blob, np.uint16, n, at + 4 * n)
    return (high.astype(np.uint64) << np.uint64(32)) | low


def _postings(part: pa.RecordBatch, size: int, num: int, den: int, order: np.ndarray, groups: int) -> Iterator[tuple[int, int, bytes]]:
    """(group, kind, blob): nodes of the rows (kind 3) and postings of their prefixes (kind 0)."""
    sets = _Sets(text_column(part, "text"), size)
    ids = part.column("id")
    known = ids.is_valid().to_numpy(zero_copy_only=False)
    level = order[(sets.hash >> np.uint64(64 - ORDER_BITS)).astype(np.int64)]
    at = np.lexsort((sets.hash, level, sets.row))
    hashes, row, level = sets.hash[at], sets.row[at], level[at]
    n = sets.n
    place = np.arange(len(row)) - sets.bounds[:-1][row]
    probe = n - -(-num * n // den) + 1
    index = n - -(-2 * num * n // (num + den)) + 1
    head = place < probe[row]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.where(head, mix(hashes + np.uint64(1)), np.uint64(0)))])
    # 48 bits are enough for tokens and groups: a clash only makes one more candidate.
    gid = (mix(total[sets.bounds[1:]] - total[sets.bounds[:-1]] + n.astype(np.uint64)) >> np.uint64(16)).view(np.int64)
    flips = np.bincount(row * MAP_BITS + (hashes & np.uint64(MAP_BITS - 1)).astype(np.int64), minlength=len(n) * MAP_BITS) & 1
    bitmap = np.packbits(flips.astype(np.uint8).reshape(len(n), MAP_BITS), axis=1).view(np.int64) if len(n) else np.zeros((0, _WORDS), np.int64)
    plain = ids.fill_null(0).to_numpy(zero_copy_only=False)
    nodes = np.column_stack([gid, sets.sid, n, plain, known, bitmap]).astype(np.int64)
    yield int(mix(np.uint64([len(n) + int(sets.sid[:1].view(np.uint64)[0] >> np.uint64(8))]))[0] % np.uint64(groups)), 3, nodes.tobytes()
    # A group's postings leave a chunk once, however many copies it holds.
    once = np.zeros(len(n), bool)
    real = np.flatnonzero(known & (n > 0))
    once[real[np.unique(gid[real], return_index=True)[1]]] = True
    pick = np.flatnonzero(head & once[row])
    tok, owner = hashes[pick], gid[row[pick]]
    # A list that may be too long for one task is split by group: bucket counts bound it from above.
    parts = np.maximum(1, np.exp2((level[pick] + 1) / 4.0) / GROUP).astype(np.uint64)
    group = (mix(tok + mix(owner.view(np.uint64)) % parts) % np.uint64(groups)).astype(np.int64)
    by = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.diff(group[by], prepend=-1, append=-1))
    early = place[pick] < index[row[pick]]
    for lo, hi in zip(edges[:-1], edges[1:]):
        mine = by[lo:hi]
        yield int(group[mine[0]]), 0, b"".join(
            (
                np.array([len(mine)], np.int64).tobytes(),
                _six(tok[mine] >> np.uint64(16)),
                _six(owner[mine].view(np.uint64)),
                n[row[pick[mine]]].astype(np.int32).tobytes(),
                (early[mine] | (parts[mine] > 1).astype(np.uint8) << 1).astype(np.uint8).tobytes(),
            )
        )


def _lists(table: pa.Table, num: int, den: int) -> pa.Table:
    """Pair each posting list's groups with the first of similar size; keep longer lists for later."""
    nodes, blobs = [], []
    for kind, blob in zip(table.column("kind").to_pylist(), table.column("blob").to_pylist()):
        (nodes if kind else blobs).append(blob)
    out = []
    if nodes:
        rows = np.frombuffer(b"".join(nodes), np.int64).reshape(-1, 5 + _WORDS)
        known = rows[:, 4] == 1
        out.append(_out(3, len(rows), a=rows[:, 0], b=rows[:, 1], n=rows[:, 2].astype(np.int32), id=pa.array(rows[:, 3], mask=~known),
                        **{m: rows[:, 5 + k] for k, m in enumerate(_BITS)}))
    if blobs:
        columns = []
        for blob in blobs:
            (k,) = np.frombuffer(blob, np.int64, 1)
            columns.append(
                [_six_back(blob, k, 8), _six_back(blob, k, 8 + 6 * k).view(np.int64)]
                + [np.frombuffer(blob, t, k, o) for t, o in ((np.int32, 8 + 12 * k), (np.uint8, 8 + 16 * k))]
            )
        tok, gid, n, flags = (np.concatenate(c) for c in zip(*columns))
        at = np.lexsort((gid, n, tok))
        tok, gid, n, flags = tok[at], gid[at], n[at], flags[at]
        new = np.ones(len(tok), bool)
        new[1:] = (tok[1:] != tok[:-1]) | (gid[1:] != gid[:-1])
        tok, gid, n, flags = tok[new], gid[new], n[new], flags[new]
        begin = np.flatnonzero(np.diff(tok.view(np.int64), prepend=~tok[:1].view(np.int64)))
        length = np.diff(np.append(begin, len(tok)))
        member = np.repeat(length, length)
        start = np.repeat(begin, length)
        # The centre of each member: the first of its list, or of its block of similar sizes.
        centre = start.copy()
        while True:
            far = den * n[centre].astype(np.int64) < num * n.astype(np.int64)
            if not far.any():
                break
            block = np.where(far, np.arange(len(tok)), len(tok))
            opened = np.minimum.reduceat(block, begin)  # the first that is too large for its centre
            at_block = np.repeat(opened, length)
            centre = np.where(far & (at_block < len(tok)), at_block, centre)
        early = (flags & 1).astype(bool)
        pair = (centre != np.arange(len(tok))) & early[centre]
        i = np.flatnonzero(pair)
        out.append(_out(0, len(i), a=gid[centre[i]], b=gid[i], n=n[centre[i]], nb=n[i]))
        split = (flags & 2) > 0
        i = np.flatnonzero((member > 2) | split)
        out.append(_out(1, len(i), tok=tok[i].view(np.int64), a=gid[i], n=n[i], early=early[i]))
        i = np.flatnonzero(split & (start == np.arange(len(tok))))
        out.append(_out(2, len(i), tok=tok[i].view(np.int64), a=gid[i], n=n[i]))
    return pa.concat_tables(out)


def _close(num: int, den: int, left: str = "x", right: str = "y"):
    """Can two nodes be similar? By size, and by the bitmaps' distance, which no set difference is below."""
    a, b = F.col(f"{left}.n").cast("bigint"), F.col(f"{right}.n").cast("bigint")
    apart = sum((F.bit_count(F.col(f"{left}.{m}").bitwiseXOR(F.col(f"{right}.{m}"))) for m in _BITS), F.lit(0))
    return (F.least(a, b) * den >= F.greatest(a, b) * num) & (apart * (num + den) <= (a + b) * (den - num))


def _verify(pairs: DataFrame, source: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Of pairs (a, b, id_a, id_b) of nodes, those whose texts are similar enough."""
    pairs = materialize(pairs, "pairs")
    count = pairs.count()
    # The node with more pairs becomes the left one: few left texts meet many right ones.
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).groupBy("node").agg(F.count("*").alias("deg"))
    left = F.struct(F.col("p.deg"), F.col("a")) >= F.struct(F.col("q.deg"), F.col("b"))
    ends = materialize(tasks_for(ends, 2 * count), "ends")
    pairs = materialize(
        pairs.join(ends.alias("p"), F.col("a") == F.col("p.node")).join(ends.alias("q"), F.col("b") == F.col("q.node")).select(
            F.when(left, F.col("a")).otherwise(F.col("b")).alias("a"), F.when(left, F.col("b")).otherwise(F.col("a")).alias("b"),
            F.when(left, F.col("id_a")).otherwise(F.col("id_b")).alias("id_a"), F.when(left, F.col("id_b")).otherwise(F.col("id_a")).alias("id_b"),
        ),
        "pairs",
    )
    needed = (
        pairs.select(F.col("id_a").alias("id"), F.lit(True).alias("is_a"), F.lit(False).alias("is_b"))
        .union(pairs.select("id_b", F.lit(False), F.lit(True)))
        .groupBy("id").agg(F.max("is_a").alias("is_a"), F.max("is_b").alias("is_b"))
    )
    needed = materialize(tasks_for(needed, 2 * count), "needed")
    small = needed.count() <= BROADCAST_IDS
    texts = source.join(F.broadcast(needed) if small else needed, "id")

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, int] = {}  # sides that a set was already sent for
        for batch in batches:
            for lo, hi in chunks(batch, "text"):
                part = batch.slice(lo, hi - lo)
                sid = _Sets(text_column(part, "text"), size).sid
                sides = [a + 2 * b for a, b in zip(part.column("is_a").to_pylist(), part.column("is_b").to_pylist())]
                new = []
                for k, (s, side) in enumerate(zip(sid.tolist(), sides)):
                    before = seen.get(s, 0)
                    if side & ~before:
                        new.append(k)
                        seen[s] = before | side
                if len(seen) > SEEN:
                    seen.clear()
                picked = part.take(pa.array(new, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sid[new]), picked.column("text"), picked.column("is_a"), picked.column("is_b")], ["sid", "text", "is_a", "is_b"]
                )

    named = texts.select("text", "is_a", "is_b").mapInArrow(name, "sid bigint, text string, is_a boolean, is_b boolean")
    ends = pairs.select("a", "b")
    both = (
        named.where("is_b").select(F.col("sid").alias("b"), F.col("text").alias("text_b"))
        .join(F.broadcast(ends) if count <= BROADCAST_IDS else ends, "b")
        .join(named.where("is_a").select(F.col("sid").alias("a"), F.col("text").alias("text_a")), "a")
    )

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, "text_a", "text_b"):
                part = batch.slice(lo, hi - lo)
                x, y = (_Sets(text_column(part, c), size) for c in ("text_a", "text_b"))
                h, r = np.concatenate([x.hash, y.hash]), np.concatenate([x.row, y.row])
                order = np.lexsort((h, r))
                h, r = h[order], r[order]
                twice = np.flatnonzero((h[1:] == h[:-1]) & (r[1:] == r[:-1]))
                common = np.bincount(r[twice], minlength=part.num_rows)
                good = den * common >= num * (x.n + y.n - common)
                yield part.select(["a", "b"]).filter(pa.array(good))

    return tasks_for(both, count, TASK_PAIRS).mapInArrow(test, "a bigint, b bigint")


def similar_sets(
    df: DataFrame, size: int = 5, similarity: tuple[int, int] = (80, 100), *, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``id_col``, ``n_shingles`` and ``component_id``.

    A row's set holds its distinct shingles of ``size`` words (A-Z lower-cased;
    with fewer words, the whole sequence as one). Rows link when the Jaccard
    similarity is at least ``similarity`` (numerator, denominator);
    ``component_id`` is the smallest id that a row reaches by links.

    Null and empty texts have no shingles and link with nothing, nor do rows
    without an id (their component is null). Ids are integers; rows that share
    an id stay apart, equal rows share a component. Other columns are not read;
    an empty table gives an empty result. Shingles are told apart by 64 bits.

    No list of candidates is paired with itself at once: each list is first
    linked as stars, and only its members that are still in different
    components afterwards are paired, so copies never make all their pairs.
    """
    num, den = similarity
    spark = df.sparkSession
    source = df.select(whole_ids(df, id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    order: Broadcast = spark.sparkContext.broadcast(_counts(source, size))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, int(total / 6 * (den - num) / den / GROUP * 2))
    schema = pa.schema([("grp", pa.int64()), ("kind", pa.int8()), ("blob", pa.binary())])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in chunks(batch, "text", limit=DEAL_BYTES):
                rows = list(_postings(batch.slice(lo, hi - lo), size, num, den, order.value, groups))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    found = materialize(
        source.mapInArrow(deal, "grp bigint, kind tinyint, blob binary")
        .groupBy("grp")
        .applyInArrow(lambda table: _lists(table, num, den), _OUT),
        "postings",
    )
    rows = found.where("kind = 3").select("id", F.col("b").alias("sid"), "n")
    nodes = materialize(
        found.where("kind = 3 and id is not null and n > 0")
        .groupBy(F.col("b").alias("sid"))
        .agg(F.min("id").alias("id"), F.first("a").alias("gid"), F.first("n").alias("n"), *[F.first(m).alias(m) for m in _BITS]),
        "nodes",
    )
    leaders = nodes.groupBy("gid").agg(F.min("sid").alias("sid"), F.count("*").alias("members"))
    group_pairs = (
        found.where("kind = 0").select("a", "b")
        .unionByName(
            # Parts of a split list meet through their first members.
            found.where("kind = 2").join(found.where("kind = 2").groupBy("tok").agg(F.min_by("a", F.struct("n", "a")).alias("c")), "tok")
            .where("a <> c").select(F.col("c").alias("a"), F.col("a").alias("b"))
        )
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        .distinct()
    )
    group_pairs = materialize(group_pairs, "group-pairs")
    lead = leaders.select("gid", "sid")
    first = group_pairs.join(lead.toDF("a", "sa"), "a").join(lead.toDF("b", "sb"), "b").select("sa", "sb").unionByName(
        nodes.join(leaders.where("members > 1").select("gid", F.col("sid").alias("sa")), "gid")
        .where("sid <> sa").select("sa", F.col("sid").alias("sb"))
    )
    x, y = nodes.alias("x"), nodes.alias("y")
    close = (
        first.join(x, F.col("sa") == F.col("x.sid")).join(y, (F.col("sb") == F.col("y.sid")) & _close(num, den))
        .select(F.col("sa").alias("a"), F.col("sb").alias("b"), F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b"))
    )
    links = materialize(_verify(close, source, size, num, den), "links")
    roots = materialize(components(links), "roots")

    many = leaders.where("members > 1").select("gid")
    wide = group_pairs.join(many, group_pairs["a"] == many["gid"], "left_semi").union(
        group_pairs.join(many, group_pairs["b"] == many["gid"], "left_semi")
    ).union(many.select(F.col("gid").alias("a"), F.col("gid").alias("b"))).distinct()
    lists = found.where("kind = 1").select("tok", F.col("a").alias("gid"), "early")

    def placed(roots: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Nodes with their component so far, and the members of lists that hold several components."""
        out = nodes.join(roots, nodes["sid"] == roots["node"], "left").select(nodes["*"], F.coalesce("root", "sid").alias("root"))
        out = materialize(out, "placed")
        # Groups tell which lists are open; only those are expanded to members with their bitmaps.
        groups = out.groupBy("gid").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
        several = lists.join(groups, "gid").groupBy("tok").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).where("lo <> hi").select("tok")
        several = materialize(several, "several")  # stored, so that the members of a hot token can be split
        members = lists.join(several, "tok").join(out.select("gid", "sid", "id", "n", "root", *_BITS), "gid")
        return out, materialize(members, "open")

    ends = [F.col("x.sid").alias("a"), F.col("y.sid").alias("b"), F.col("x.id").alias("id_a"), F.col("y.id").alias("id_b")]

    def unordered(pairs: DataFrame) -> DataFrame:
        swap = F.col("a") > F.col("b")
        return materialize(
            pairs.select(
                F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"),
                F.when(swap, F.col("id_b")).otherwise(F.col("id_a")).alias("id_a"),
                F.when(swap, F.col("id_a")).otherwise(F.col("id_b")).alias("id_b"),
            ).distinct(),
            "rest",
        )

    def linked(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
        if pairs.isEmpty():
            return links, roots
        more = materialize(links.unionByName(_verify(pairs, source, size, num, den)), "links")
        return more, materialize(components(more), "roots")

    # Second stars: the centre is now the member that most open lists hold. An
    # original is in more of them than its copies, whose own words are rare.
    nodes_placed, left = placed(roots)
    often = left.groupBy("sid").agg(F.count("*").alias("lists"))
    chosen = left.select("tok", "sid").join(often, "sid").groupBy("tok").agg(F.max_by("sid", F.struct("lists", "sid")).alias("sid"))
    centres = chosen.join(nodes_placed.select("sid", "id", "n", "root", *_BITS), "sid")
    links, roots = linked(
        unordered(
            centres.alias("x").join(
                left.alias("y"),
                (F.col("x.tok") == F.col("y.tok")) & (F.col("x.root") != F.col("y.root")) & _close(num, den),
            ).select(*ends)
        )
    )

    # What stars could not tell: members of one list, or of paired groups, in different components.
    nodes_placed, left = placed(roots)
    within = left.alias("x").join(
        left.alias("y"),
        (F.col("x.tok") == F.col("y.tok")) & (F.col("x.root") != F.col("y.root")) & F.col("x.early")
        & ((F.col("x.n") < F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.sid") != F.col("y.sid"))))
        & _close(num, den),
    ).select(*ends)
    across = (
        wide.join(nodes_placed.alias("x"), F.col("a") == F.col("x.gid"))
        .join(
            nodes_placed.alias("y"),
            (F.col("b") == F.col("y.gid")) & (F.col("x.root") != F.col("y.root")) & (F.col("x.sid") != F.col("y.sid")) & _close(num, den),
        )
        .select(*ends)
    )
    links, roots = linked(unordered(within.unionByName(across)))
    least = (
        nodes.join(roots, nodes["sid"] == roots["node"]).groupBy("root").agg(F.min("id").alias("least"))
        .join(roots, "root").select(F.col("node").alias("sid"), "least")
    )
    named = nodes.select("sid", F.col("id").alias("own")).join(least, "sid", "left").select("sid", F.coalesce("least", "own").alias("least"))
    return rows.join(named, "sid", "left").select(
        F.col("id").alias(id_col),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("id").isNotNull(), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("id"))).alias("component_id"),
    )


def keep_one(df: DataFrame, size: int = 5, similarity: tuple[int, int] = (80, 100), *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each component, with all its columns.

    Rows are told apart by themselves, not by their id: of rows that share one,
    unlike texts each stand for their own component, and like ones keep one row.
    Rows without an id all stay; null and empty texts are like nothing.
    """
    shared = df.where(F.col(id_col).isNotNull()).groupBy(id_col).count().where("count > 1")
    if shared.isEmpty():
        return _smallest(df, size, similarity, id_col, text_col)
    # Some id names several rows: rows are linked by a number of their own, and ids only choose who stays.
    row = free_name(df.columns, "row")
    numbered = materialize(df.withColumn(row, F.monotonically_increasing_id()), "numbered")
    own = numbered.where(F.col(id_col).isNotNull())
    classes = similar_sets(own, size, similarity, id_col=row, text_col=text_col)
    first = (
        own.select(F.col(row).alias("number"), whole_ids(own, id_col).alias("id"))
        .join(classes.select(F.col(row).alias("number"), F.col("component_id").alias("class")), "number")
        .groupBy("class").agg(F.min(F.struct("id", "number")).alias("first"))
        .select(F.col("first.number").alias(row))
    )
    kept = numbered.join(materialize(first, "first"), row, "left_semi")
    return kept.unionByName(numbered.where(F.col(id_col).isNull())).drop(row)


def _smallest(df: DataFrame, size: int, similarity: tuple[int, int], id_col: str, text_col: str) -> DataFrame:
    """``keep_one`` where no id names two rows."""
    classes = similar_sets(df, size, similarity, id_col=id_col, text_col=text_col)
    gone = classes.where(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("gone"))
    gone = materialize(gone, "gone")
    few = gone.count() <= BROADCAST_IDS
    return df.join(F.broadcast(gone) if few else gone, whole_ids(df, id_col) == gone["gone"], "left_anti")

"""Exact top-k by inner product with M-trees.

Vectors of a common length make inner product and Euclidean distance one
order: each gets one more component that brings its norm to the largest one.
Vectors go to the nearest of a few pivots; each cell holds paged M-trees. A
query searches its own cell first, and then the cells that the triangle
inequality cannot rule out, best node first.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.session import materialize

PAGE, FANOUT = 64, 12  # entries of a leaf and of an inner node
CELLS = 256  # most pivots; they come from a sample of so many vectors
CELL_ROWS = 5000  # vectors a cell is meant to hold
TREE_ROWS = 20_000  # most vectors of one tree: a larger cell has several
QUERY_ROWS = 20_000  # queries that meet a tree at once


class Page:
    """A node: entries with their distance to the node's own centre; inner ones with covering radius and child."""

    __slots__ = ("points", "to_parent", "radii", "children", "rows")

    def __init__(self, points, to_parent, radii=None, children=None, rows=None) -> None:
        self.points, self.to_parent, self.radii, self.children, self.rows = points, to_parent, radii, children, rows


def _distance(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(1))


class MTree:
    """Bulk-loaded M-tree over ``vectors`` (integers as doubles); ``top`` is the squared norm all are raised to."""

    def __init__(self, vectors: np.ndarray, top: float) -> None:
        self.vectors, self.top = vectors, top
        self.most = float(np.abs(vectors).max(initial=0)) * max(1, vectors.shape[1])
        lift = np.sqrt(np.maximum(0, top - (vectors**2).sum(1)))
        self.points = np.concatenate([vectors, lift[:, None]], 1)
        self.slack = 1e-6 * (1 + np.sqrt(top))  # rounding must not rule out a tie
        self.computed = 0  # distances and scores worked out so far
        self.root, self.centre = None, None
        if len(vectors):
            self.centre = self.points[0]
            self.root = self._build(np.arange(len(vectors)), self.centre)

    def _build(self, rows: np.ndarray, centre: np.ndarray) -> Page:
        if len(rows) <= PAGE:
            return Page(self.points[rows], _distance(self.points[rows], centre), rows=rows)
        # Seeds far from each other; every point joins the nearest.
        seeds, near = [rows[0]], _distance(self.points[rows], self.points[rows[0]])
        owner = np.zeros(len(rows), int)
        for k in range(1, FANOUT):
            far = int(near.argmax())
            if near[far] == 0:
                break
            seeds.append(rows[far])
            d = _distance(self.points[rows], self.points[rows[far]])
            closer = d < near
            owner[closer], near[closer] = k, d[closer]
        if len(seeds) == 1:  # all the same point
            parts = np.array_split(rows, -(-len(rows) // PAGE))
            seeds = [p[0] for p in parts]
        else:
            parts = [rows[owner == k] for k in range(len(seeds))]
        points = self.points[seeds]
        radii = np.array([_distance(self.points[p], c).max() for p, c in zip(parts, points)])
        return Page(points, _distance(points, centre), radii, [self._build(p, c) for p, c in zip(parts, points)])

    def search(self, query: np.ndarray, k: int, least: int | None = None) -> list[tuple[int, int]]:
        """The k best (score, row), and all that tie with the last; none below ``least``."""
        point = np.append(query, 0.0)
        square = float((query**2).sum()) + self.top

        def reach(score) -> float:
            return np.inf if score is None else np.sqrt(max(0.0, square - 2 * score)) + self.slack

        exact = self.most * float(np.abs(query).max(initial=0)) < 2**52  # else integers of any size
        best: list[int] = []  # heap of the k best scores
        found: list[tuple[int, int]] = []
        limit = reach(least)
        self.computed += 1
        queue = [(0.0, 0, self.root, float(_distance(point[None], self.centre)[0]))] if self.root else []
        order = 0
        while queue:
            bound, _, page, to_centre = heapq.heappop(queue)
            if bound > limit:
                break
            radii = 0 if page.radii is None else page.radii
            open_ = np.flatnonzero(np.abs(to_centre - page.to_parent) - radii <= limit)
            if not len(open_):
                continue
            self.computed += len(open_)
            if page.rows is None:
                away = _distance(page.points[open_], point)
                lower = np.maximum(0, away - page.radii[open_])
                for i in np.flatnonzero(lower <= limit):
                    order += 1
                    heapq.heappush(queue, (float(lower[i]), order, page.children[open_[i]], float(away[i])))
                continue
            rows = page.rows[open_]
            if exact:
                scores = (self.vectors[rows] @ query).astype(np.int64)
            else:
                scores = np.array([sum(int(a) * int(b) for a, b in zip(v, query)) for v in self.vectors[rows].tolist()], object)
            for s, row in zip(scores.tolist(), rows.tolist()):
                if (least is not None and s < least) or (len(best) == k and s < best[0]):
                    continue
                found.append((s, row))
                heapq.heappush(best, s)
                if len(best) > k:
                    heapq.heappop(best)
            if len(best) == k:
                limit = reach(best[0] if least is None else max(best[0], least))
        return [x for x in found if len(best) < k or x[0] >= best[0]]


def _matrix(packed: list[bytes], width: int) -> np.ndarray:
    """Packed vectors as rows of doubles; shorter ones are filled with zeros."""
    out = np.zeros((len(packed), width))
    for r, p in enumerate(packed):
        v = np.frombuffer(p, "<i8")
        out[r, : len(v)] = v
    return out


def _packed(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(id, vec): distinct ids and vectors as packed 64-bit integers, floor(scale * x)."""
    source = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("x")).where(
        F.col("id").isNotNull() & F.col("x").isNotNull()
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, out = [], []
            for i, x in zip(batch.column("id").to_pylist(), batch.column("x")):
                v = x.values.to_numpy(zero_copy_only=False)  # null becomes not-a-number
                v = np.floor(scale * v)
                if np.isfinite(v).all():
                    if (np.abs(v) >= 2**62).any():
                        raise ValueError(f"a component of the vector of id {i} is too large for 64-bit integers")
                    ids.append(i)
                    out.append(v.astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["id", "vec"])

    return source.mapInArrow(pack, "id bigint, vec binary").distinct()


def top_inner_products(
    df: DataFrame, queries: Column, k: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 1024.0
) -> DataFrame:
    """(query_id, rank, id, score): for each row where ``queries`` holds, the ``k`` rows with the
    highest inner product of floor(scale * x), ties to the smaller id; its own id is no candidate.

    Vectors that are null or hold null or non-finite components take no part,
    nor do rows without an id; components that do not fit in 62 bits once
    scaled are refused with an error; an equal row counts once; a shorter vector counts
    as filled with zeros. With fewer candidates all are returned; an empty table
    gives an empty result. Rows with one vector are one point of the trees with
    the ``k`` + 1 smallest ids, which are all that a result can hold of them.
    The search is exact: pivots are a bounded sample, everything else is whole.
    """
    spark = df.sparkSession
    rows = materialize(_packed(df, id_col, vector_col, scale), "vectors")
    asked = materialize(
        _packed(df.where(queries), id_col, vector_col, scale).select(F.col("id").alias("query_id"), "vec"), "queries"
    )
    same = Window.partitionBy("vec").orderBy("id")
    points = rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= k + 1).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    points = materialize(points, "points")
    stats = points.agg(F.count("*").alias("n"), F.max(F.octet_length("vec")).alias("width")).first()
    width = (stats["width"] or 0) // 8
    cells = max(1, min(CELLS, stats["n"] // CELL_ROWS))
    seeds = [bytes(r["vec"]) for r in points.orderBy(F.xxhash64("vec"), "vec").select("vec").limit(cells).collect()]

    def norms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("vec").to_pylist(), width)
            yield pa.RecordBatch.from_arrays([pa.array([(m**2).sum(1).max(initial=0)])], ["square"])

    top = points.select("vec").mapInArrow(norms, "square double").agg(F.max("square")).first()[0] or 0.0
    pivots = _matrix(seeds, width)
    pivots = np.concatenate([pivots, np.sqrt(np.maximum(0, top - (pivots**2).sum(1)))[:, None]], 1)
    shared = spark.sparkContext.broadcast(pivots)  # CELLS vectors at most

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = _matrix(batch.column("vec").to_pylist(), width)
            m = np.concatenate([m, np.sqrt(np.maximum(0, top - (m**2).sum(1)))[:, None]], 1)
            d = np.stack([_distance(m, p) for p in shared.value], 1) if len(m) else np.zeros((0, 1))
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec"), batch.column("ids"), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(m)), cell])], ["vec", "ids", "cell", "away"]
            )

    if not seeds or asked.isEmpty():
        return spark.createDataFrame([], "query_id bigint, rank int, id bigint, score bigint")
    placed = materialize(points.mapInArrow(locate, "vec binary, ids array<bigint>, cell int, away double"), "placed")
    extent = {r["cell"]: (r["n"], r["r"]) for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("away").alias("r")).collect()}
    trees = {c: -(-n // TREE_ROWS) for c, (n, _) in extent.items()}
    per_cell = F.create_map(*[F.lit(int(x)) for pair in trees.items() for x in pair])
    leaves = placed.select("cell", F.pmod(F.xxhash64("vec"), F.element_at(per_cell, F.col("cell"))).cast("int").alias("tree"), "vec", "ids")
    blocks = -(-asked.count() // QUERY_ROWS)

    def route(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = np.array(sorted(extent))
            radii = np.array([extent[c][1] for c in names])
            for batch in batches:
                m = _matrix(batch.column("vec").to_pylist(), width)
                q = np.concatenate([m, np.zeros((len(m), 1))], 1)
                d = np.stack([_distance(q, shared.value[c]) for c in names], 1) if len(m) else np.zeros((0, len(names)))
                own = np.zeros(d.shape, bool)
                own[np.arange(len(m)), d.argmin(1)] = True
                if first:
                    go = own
                else:
                    least = batch.column("least").to_pylist()
                    square = (m**2).sum(1) + top
                    far = np.array([np.inf if s is None else np.sqrt(max(0.0, square[i] - 2 * s)) for i, s in enumerate(least)])
                    go = ~own & (d - radii <= (far + 1e-6 * (1 + np.sqrt(top)))[:, None])
                at, to = np.nonzero(go)
                picked = [(i, int(names[c]), t) for i, c in zip(at.tolist(), to.tolist()) for t in range(trees[int(names[c])])]
                index = pa.array([p[0] for p in picked], pa.int64())
                part = batch.take(index)
                yield pa.RecordBatch.from_arrays(
                    [part.column("query_id"), part.column("vec"), part.column("least"), pa.array([p[1] for p in picked], pa.int32()), pa.array([p[2] for p in picked], pa.int32())],
                    ["query_id", "vec", "least", "cell", "tree"],
                )

        return run

    def search(key, points: pa.Table, asked: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec": [], "id": [], "score": []}
        if asked.num_rows and points.num_rows:
            tree = MTree(_matrix(points.column("vec").to_pylist(), width), top)
            ids = points.column("ids").to_pylist()
            for q, packed, least in zip(asked.column("query_id").to_pylist(), asked.column("vec").to_pylist(), asked.column("least").to_pylist()):
                near = tree.search(_matrix([packed], width)[0], k + 1, least)
                mine = sorted((-s, i) for s, row in near for i in ids[row] if i != q)[:k]
                out["query_id"] += [q] * len(mine)
                out["vec"] += [packed] * len(mine)
                out["id"] += [i for _, i in mine]
                out["score"] += [-s for s, _ in mine]
        return pa.table(
            {"query_id": pa.array(out["query_id"], pa.int64()), "vec": pa.array(out["vec"], pa.binary()), "id": pa.array(out["id"], pa.int64()), "score": pa.array(out["score"], pa.int64())}
        )

    def answers(asked: DataFrame, first: bool) -> DataFrame:
        routed = asked.mapInArrow(route(first), "query_id bigint, vec binary, least bigint, cell int, tree int").withColumn(
            "block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int")
        )
        # A tree meets its queries in blocks of bounded size; each block has a copy of the tree.
        copies = leaves.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
        return (
            copies.groupBy("cell", "tree", "block")
            .cogroup(routed.groupBy("cell", "tree", "block"))
            .applyInArrow(search, "query_id bigint, vec binary, id bigint, score bigint")
        )

    best = Window.partitionBy("query_id", "vec").orderBy(F.desc("score"), "id")
    near = materialize(answers(asked.withColumn("least", F.lit(None).cast("bigint")), True), "near")
    bound = (
        near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") == k).select("query_id", "vec", F.col("score").alias("least"))
    )
    rest = answers(asked.join(bound, ["query_id", "vec"], "left"), False)
    return (
        near.unionByName(rest)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
    )

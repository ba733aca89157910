"""Nearest neighbours by largest inner product: stable projections, a kd-tree, a chi-square stopping test.

A vector x gets one more component, sqrt(M^2 - |x|^2) with M the largest norm, and a query gets zero there:
then the nearest by distance is the largest by inner product. Both are projected to AXES dimensions by a
matrix of normal variates, which is 2-stable: the squared projected distance over the squared distance is
chi-square with AXES degrees of freedom. A kd-tree over projections, fitted on at most SAMPLE rows, deals all
rows to leaves; a leaf is stored as blocks of about BLOCK rows.

Queries visit leaves in order of their box's projected distance D, in three rounds: the nearest leaf, the next few,
all the rest. With d the distance of the k-th best so far, a leaf is visited only while
chi2(D^2 / d^2) <= CONFIDENCE: beyond that, a neighbour at distance d or less would have been met already with
that probability. In a block the same test is applied to every projected neighbour: the FIRST nearest are
verified on the original vectors in double precision and shrink d, then the others up to where the test
stops. A neighbour is missed with probability 1 - CONFIDENCE at most.

Vectors that are null, empty, zero, or hold null or non-finite components take no part, as query or as
candidate; nor do rows with a null id. A table of different lengths is searched by length, however
many there are. Queries with fewer than k other
rows get all they have. Equal scores are ordered by the smaller id; rows that share an id are never each
other's neighbours and appear once. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import batches_of, release, stage
from .vectors import clean_vectors, matrix

AXES, SAMPLE, LEAVES, BLOCK, CHUNK, FIRST = 8, 16_384, 4096, 1024, 128, 64
CONFIDENCE = 0.95


def chi2(x: np.ndarray) -> np.ndarray:
    """Distribution function for AXES (even) degrees of freedom."""
    half = np.maximum(np.minimum(x, 1e3), 0) / 2
    return 1 - np.exp(-half) * sum(half**i / math.factorial(i) for i in range(AXES // 2))


def _stop_ratio() -> float:
    """The x with chi2(x) = CONFIDENCE."""
    low, high = 0.0, 1e3
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi2(np.array(middle)) < CONFIDENCE else (low, middle)
    return high


class Projection:
    def __init__(self, size: int, largest: float):
        rng = np.random.default_rng(12)
        self.matrix = rng.standard_normal((size + 1, AXES))
        self.largest = largest

    def rows(self, x: np.ndarray) -> np.ndarray:
        more = np.sqrt(np.maximum(0, self.largest**2 - np.einsum("ij,ij->i", x, x)))
        return x @ self.matrix[:-1] + more[:, None] * self.matrix[-1]

    def queries(self, q: np.ndarray) -> np.ndarray:
        return q @ self.matrix[:-1]


class KdTree:
    """Median splits on the widest axis; leaves have boxes."""

    def __init__(self, points: np.ndarray, leaf: int, most: int = 1 << 30):
        self.axis, self.value, self.child = [], [], []
        leaf = max(leaf, -(-len(points) // most), 1)
        low, high = np.full(points.shape[1], -np.inf), np.full(points.shape[1], np.inf)
        self.members, self.low, self.high = [], [], []
        self.root = self._build(points, np.arange(len(points)), low, high, leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _leaf(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> int:
        self.members.append(rows)
        self.low.append(low)
        self.high.append(high)
        return -len(self.members)

    def _build(self, points, rows, low, high, leaf) -> int:
        if len(rows) <= leaf:
            return self._leaf(rows, low, high)
        x = points[rows]
        axis = int(np.argmax(x.max(axis=0) - x.min(axis=0)))
        cut = float(np.median(x[:, axis]))
        left = x[:, axis] < cut
        if not left.any() or left.all():
            return self._leaf(rows, low, high)
        node = len(self.axis)
        self.axis.append(axis)
        self.value.append(cut)
        self.child.append([0, 0])
        upper, lower = high.copy(), low.copy()
        upper[axis] = lower[axis] = cut
        self.child[node] = [self._build(points, rows[left], low, upper, leaf), self._build(points, rows[~left], lower, high, leaf)]
        return node

    def place(self, points: np.ndarray) -> np.ndarray:
        """Leaf of each point."""
        if not self.axis:
            return np.zeros(len(points), np.int32)
        axis, value, child = np.array(self.axis), np.array(self.value), np.array(self.child)
        at = np.zeros(len(points), np.int64)
        while (inner := np.flatnonzero(at >= 0)).size:
            n = at[inner]
            right = points[inner, axis[n]] >= value[n]
            at[inner] = child[n, right.astype(int)]
        return (-at - 1).astype(np.int32)


def box_distances(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of each point to each box."""
    out = np.zeros((len(points), len(low)))
    for a in range(points.shape[1]):
        p = points[:, a : a + 1]
        out += np.maximum(np.maximum(low[None, :, a] - p, p - high[None, :, a]), 0) ** 2
    return out


def search_block(
    ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int, projection: Projection
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, score) of the k best of this block per query that reach its bound.

    bound: the k-th best score so far, -inf if there is none.
    """
    points, places = projection.rows(x), projection.queries(q)
    far = (points**2).sum(axis=1) + (places**2).sum(axis=1)[:, None] - 2 * places @ points.T
    base = projection.largest**2 + np.einsum("ij,ij->i", q, q)
    own = query_ids[:, None] == ids[None, :]
    # The nearest in projection first; if they fill the k, the k-th is a better bound.
    kth, first = bound.copy(), min(FIRST, len(ids))
    near = np.argpartition(far, first - 1, axis=1)[:, :first]
    scores = np.einsum("qnd,qd->qn", x[near], q)
    scores[np.take_along_axis(own, near, 1)] = -np.inf
    if first >= k:
        kth = np.maximum(kth, -np.partition(-scores, k - 1, axis=1)[:, k - 1])
    # The test: projected distance of each of the others, against the k-th distance known.
    reach = np.where(kth == -np.inf, np.inf, _stop_ratio() * np.maximum(base - 2 * kth, 0))
    verified = far <= reach[:, None]
    np.put_along_axis(verified, near, True, 1)
    verified &= ~own
    some = np.flatnonzero(verified.any(axis=0))
    scores = np.where(verified[:, some], q @ x[some].T, -np.inf)
    scores[scores < kth[:, None] - 1e-9 * (1 + np.abs(kth[:, None]))] = -np.inf
    if len(some) > 2 * k:
        least = -np.partition(-scores, k, axis=1)[:, k]
        scores[scores < least[:, None]] = -np.inf
    row, place = np.nonzero(scores > -np.inf)
    # Scores once more, each by itself, so that they do not depend on the block.
    found = some[place]
    return row, ids[found], np.einsum("ij,ij->i", q[row], x[found])


ITEMS = "array<struct<id:bigint,vector:array<double>>>"


def _unpack(items: pa.StructArray) -> tuple[np.ndarray, np.ndarray]:
    return items.field("id").to_numpy(), matrix(items.field("vector"))


def _search(projection: Projection, k: int):
    """Rows (items, queries array<struct<id, vector, kth>>) to found neighbours."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, x = _unpack(batch.column(0)[r].values)
                asked = batch.column(1)[r].values
                query_ids, q = _unpack(asked)
                row, found, score = search_block(ids, x, query_ids, q, asked.field("kth").to_numpy(), k, projection)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[row]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"]
                )

    return run


def nearest(
    table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every query row; see the module."""
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    vectors = stage(clean_vectors(table, id_col, vector_col).withColumns({"size": F.size("vector"), "norm": norm}))
    # Lengths of at least two blocks have a tree each; all others, one leaf each, are searched together.
    sizes = vectors.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    many = sorted(r["size"] for r in sizes.where(F.col("n") >= 2 * BLOCK).collect())
    parts = [_nearest(vectors.where(F.col("size") == n), n, is_query, k, id_col) for n in many]
    out = _nearest_in_leaf(vectors.where(~F.col("size").isin(many)), is_query, k, id_col)
    release(vectors)
    for p in parts:
        out = out.unionByName(p)
    return out


def _nearest_in_leaf(vectors: DataFrame, is_query: Column, k: int, id_col: str) -> DataFrame:
    """Lengths of fewer than two blocks: each is one leaf, so blocks and chunks of queries meet by length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, x = _unpack(batch.column(0)[r].values)
                query_ids, q = _unpack(batch.column(1)[r].values)
                projection = Projection(x.shape[1], batch.column(2)[r].as_py() * (1 + 1e-12))
                row, found, score = search_block(ids, x, query_ids, q, np.full(len(q), -np.inf), k, projection)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(query_ids[row]), pa.array(found), pa.array(score)], ["query_id", "vec_id", "score"])

    items = F.collect_list(F.struct("id", "vector"))
    blocks = vectors.groupBy("size", F.pmod(F.xxhash64("id", "vector"), F.lit(2)).alias("block")).agg(items.alias("items"))
    largest = vectors.groupBy("size").agg(F.max("norm").alias("largest"))
    asked = vectors.withColumn("_id", F.col("id")).select(F.col("_id").alias(id_col), "id", "vector", "size").where(is_query)
    chunks = asked.groupBy("size", F.pmod(F.xxhash64("id"), F.lit(2 * BLOCK // CHUNK)).alias("chunk")).agg(
        F.collect_list(F.struct("id", "vector")).alias("queries"))
    met = chunks.join(largest, "size").join(blocks, "size").select("items", "queries", "largest")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    with batches_of(vectors.sparkSession, 16):
        every = stage(met.mapInArrow(run, "query_id bigint, vec_id bigint, score double"))
    one_each = every.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = stage(one_each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
    release(every)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _nearest(vectors: DataFrame, size: int, is_query: Column, k: int, id_col: str) -> DataFrame:
    spark = vectors.sparkSession
    n, largest = vectors.agg(F.count(F.lit(1)), F.max("norm")).first()
    projection = Projection(size, largest * (1 + 1e-12))
    sample = vectors.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("vector").toPandas()["vector"]
    points = projection.rows(np.stack(sample.to_list()).astype(float))
    leaves = max(1, min(LEAVES, n // BLOCK, len(points) // 4))
    tree = KdTree(points, 1, leaves)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(tree.place(projection.rows(x))), pa.array(tree.place(projection.queries(x)))],
                ["id", "vector", "leaf", "query_leaf"],
            )

    placed = stage(vectors.select("id", "vector").mapInArrow(place, "id bigint, vector array<double>, leaf int, query_leaf int"))
    item = F.struct("id", "vector")
    counts = placed.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    # A leaf and block number hold about BLOCK rows, dealt by a hash, so a leaf of any size is split.
    dealt = placed.join(counts, "leaf").withColumn("block", F.pmod(F.xxhash64("id", "vector"), F.col("blocks")))
    blocks = stage(dealt.groupBy("leaf", "block").agg(F.collect_list(item).alias("items")))

    queries = placed.select(F.col("id").alias(id_col), "id", "vector", "query_leaf").where(is_query).drop(id_col)
    asked = queries.groupBy("query_leaf").agg(F.ceil(F.count(F.lit(1)) / CHUNK).alias("chunks"))
    queries = stage(queries.join(asked, "query_leaf").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))))
    ratio = _stop_ratio()

    def visit(start: int, stop: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Leaves start to stop in each query's order that the test does not rule out, with their queries."""
            for batch in batches:
                for r in range(batch.num_rows):
                    asked = batch.column(0)[r].values
                    _, q = _unpack(asked)
                    kth = asked.field("kth").to_numpy()
                    far = box_distances(projection.queries(q), tree.low, tree.high)
                    rank = np.argsort(np.argsort(far, axis=1, kind="stable"), axis=1)
                    base = projection.largest**2 + np.einsum("ij,ij->i", q, q)
                    reach = np.where(kth == -np.inf, np.inf, ratio * np.maximum(base - 2 * kth, 0))
                    goes = (far <= reach[:, None]) & (rank >= start) & (rank < stop)
                    for leaf in np.flatnonzero(goes.any(axis=0)).tolist():
                        some = asked.take(pa.array(np.flatnonzero(goes[:, leaf])))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([leaf], pa.int32()), pa.ListArray.from_arrays(pa.array([0, len(some)], pa.int32()), some)],
                            ["leaf", "queries"],
                        )

        return run

    n_leaves = len(tree.members)
    second = min(n_leaves, 2 + math.isqrt(n_leaves))
    asked_type = "array<struct<id:bigint,vector:array<double>,kth:double>>"
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best, bounds = None, queries.select("id", F.lit(float("-inf")).alias("kth"))
    for start, stop in ((0, 1), (1, second), (second, n_leaves)):
        if start >= stop:
            continue
        bounded = queries.join(bounds, "id", "left").withColumn("kth", F.coalesce("kth", F.lit(float("-inf"))))
        chunks = bounded.groupBy("query_leaf", "chunk").agg(F.collect_list(F.struct("id", "vector", "kth")).alias("queries"))
        with batches_of(spark, 16):
            visits = stage(chunks.select("queries").mapInArrow(visit(start, stop), f"leaf int, queries {asked_type}"))
            met = visits.join(blocks, "leaf").select("items", "queries").mapInArrow(
                _search(projection, k), "query_id bigint, vec_id bigint, score double")
            # An id that several rows share counts once, with its best score.
            every = met if best is None else met.union(best.select("query_id", "vec_id", "score"))
            one_each = every.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            top = stage(one_each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))
        for old in (visits, *([best] if best is not None else [])):
            release(old)
        best = top
        bounds = best.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("kth"))
    for old in (placed, blocks, queries):
        release(old)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_query(table: DataFrame) -> DataFrame:
    return nearest(table, F.col("vec_id") % 20 == 0)

"""Embedding near-duplicates: PCA-ordered tiles, compared on leading dimensions first.

The rotation to principal axes comes from the second moments of all vectors (no centring, so products
are kept). Unit vectors of one label are ordered by cells of their first CELL_AXES coordinates and cut into tiles
of at most TILE rows; range partitioning with the id as last key splits any label. Two unit vectors with
cosine t are at most sqrt(2 - 2t) apart, so only tiles with cells that touch and boxes that near meet.
A pair of tiles multiplies the leading dimensions, adds the product of the norms of what is left as a
bound, and goes on only with pairs whose cosine can still reach the threshold; what survives is decided on
the original vectors in double precision.

Equal vectors of one label form one class with a count, so copies are never expanded. A tile pair returns
counts of links per vector and a spanning tree of what it has linked, not the pairs.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows with a null label or id,
link with nothing: 0 links, component = own id, kept. Vectors of different length do not link. Rows that
share an id are one node: links of each hold for the id. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, hash_lanes, release, stage
from .components import components
from .vectors import clean_vectors, matrix

TILE, CELL_AXES = 512, 3
LEADING = (16, 32)


def principal_axes(vectors: DataFrame) -> np.ndarray:
    """Orthonormal axes, strongest first, of unit vectors (column `unit`), zero-padded to one length."""
    size = vectors.agg(F.max(F.size("unit"))).first()[0] or 1

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for rows in _same_length(batch.column(0)):
                x = np.zeros((len(rows), size))
                x[:, : rows.shape[1]] = rows
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], ["at", "value"])

    # Partial sums meet in size * size numbers, whatever the number of rows.
    cells = vectors.select("unit").mapInArrow(moments, "at bigint, value double").groupBy("at").agg(F.sum("value").alias("v"))
    total = np.zeros(size * size)
    for at, value in cells.collect():
        total[at] = value
    return np.linalg.eigh(total.reshape(size, size))[1][:, ::-1].copy()


def _same_length(column: pa.ListArray) -> Iterator[np.ndarray]:
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        yield matrix(column.filter(pa.array(sizes == size)))


def _rotate(axes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    return rows @ axes[: rows.shape[1]]


ITEM = "array<struct<id:bigint,copies:bigint,vector:array<double>>>"
TILES = f"label bigint, size int, tile bigint, cells array<string>, low array<double>, high array<double>, items {ITEM}"


def _tiles(classes: DataFrame, axes: np.ndarray, reach: float) -> DataFrame:
    """One row per tile of classes (label, size, id, copies, vector)."""
    lead = min(8, axes.shape[1])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, sizes = batch.column(4), batch.column(1).to_numpy(zero_copy_only=False)
            cells = np.zeros((batch.num_rows, CELL_AXES), np.int32)
            for size in np.unique(sizes):
                mask = sizes == size
                rows = matrix(vectors.filter(pa.array(mask)))
                unit = rows / np.linalg.norm(rows, axis=1)[:, None]
                at = np.floor(_rotate(axes, unit)[:, :CELL_AXES] / reach).astype(np.int32)
                cells[np.flatnonzero(mask)[:, None], np.arange(at.shape[1])] = at
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(np.ascontiguousarray(cells[:, i])) for i in range(CELL_AXES))],
                ["label", "size", "id", "copies", "vector", "c0", "c1", "c2"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in [*batches, None]:
            if batch is not None:
                held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            if held is None:
                return
            held = held.combine_chunks()
            label, size = (held.column(i).to_numpy() for i in (0, 1))
            change = np.flatnonzero((label[1:] != label[:-1]) | (size[1:] != size[:-1])) + 1
            at = 0
            for stop in [*change.tolist(), held.num_rows]:
                while at < stop:
                    n = min(TILE, stop - at)
                    if batch is not None and stop == held.num_rows and n < TILE:
                        break
                    yield tile(held.slice(at, n).combine_chunks().to_batches()[0])
                    at += n
                if at < stop:
                    break
            held = held.slice(at)

    def tile(rows: pa.RecordBatch) -> pa.RecordBatch:
        label, size, ids = rows.column(0), rows.column(1), rows.column(2)
        vectors = matrix(rows.column(4))
        unit = vectors / np.linalg.norm(vectors, axis=1)[:, None]
        x = _rotate(axes, unit)[:, :lead]
        cells = np.unique(np.stack([rows.column(5 + i).to_numpy() for i in range(CELL_AXES)], axis=1), axis=0)
        items = pa.StructArray.from_arrays([ids, rows.column(3), rows.column(4)], ["id", "copies", "vector"])
        many = lambda values, kind: pa.array([values], pa.list_(kind))
        return pa.RecordBatch.from_arrays([
            label.slice(0, 1), size.slice(0, 1), ids.slice(0, 1),
            many([",".join(map(str, c)) for c in cells.tolist()], pa.string()),
            many(x.min(axis=0), pa.float64()), many(x.max(axis=0), pa.float64()),
            pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), items),
        ], ["label", "size", "tile", "cells", "low", "high", "items"])

    columns = "label bigint, size int, id bigint, copies bigint, vector array<double>"
    placed = classes.select("label", "size", "id", "copies", "vector").mapInArrow(place, f"{columns}, c0 int, c1 int, c2 int")
    keys = ["label", "size", "c0", "c1", "c2", "id"]
    return placed.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(cut, TILES)


def _tile_pairs(tiles: DataFrame, reach: float) -> DataFrame:
    """(label, size, one, two) of tiles that may hold a pair within reach: touching cells and near boxes."""
    near = [f"{a},{b},{c}" for a in (-1, 0, 1) for b in (-1, 0, 1) for c in (-1, 0, 1)]
    about = tiles.select("label", "size", "tile", "low", "high", F.explode("cells").alias("cell"))
    parts = F.split("cell", ",")
    moved = F.explode(F.array(*(F.lit(s) for s in near))).alias("step")
    around = about.select("*", moved).withColumn("step", F.split("step", ",")).select(
        "label", "size", F.col("tile").alias("two"), F.col("low").alias("low_2"), F.col("high").alias("high_2"),
        F.concat_ws(",", *((parts[i].cast("int") + F.col("step")[i].cast("int")).cast("string") for i in range(3))).alias("cell"),
    )
    gap = lambda a, b: F.greatest(a - b, F.lit(0.0))
    apart = F.aggregate(
        F.zip_with(
            F.zip_with("low", "high_2", gap), F.zip_with("low_2", "high", gap), lambda a, b: F.pow(F.greatest(a, b), F.lit(2.0))
        ),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    met = about.join(around, ["label", "size", "cell"]).where(F.col("tile") <= F.col("two")).where(apart <= reach * reach)
    return met.select("label", "size", F.col("tile").alias("one"), "two").distinct()


def compare(a: np.ndarray, b: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of pairs (of a and b) with cosine >= threshold."""
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    x, y = _rotate(axes, a / norm_a[:, None]), _rotate(axes, b / norm_b[:, None])
    slack = 1e-9
    left_x = np.sqrt(np.maximum(0, 1 - np.cumsum(x * x, axis=1)))
    left_y = np.sqrt(np.maximum(0, 1 - np.cumsum(y * y, axis=1)))
    lead = min(LEADING[0], x.shape[1])
    so_far = x[:, :lead] @ y[:, :lead].T
    alive = so_far + left_x[:, lead - 1][:, None] * left_y[:, lead - 1] >= threshold - slack - 1e-7
    i, j = np.nonzero(np.triu(alive, 1) if same else alive)
    part = so_far[i, j]
    for stop in (*LEADING[1:], x.shape[1]):
        stop = min(stop, x.shape[1])
        if not len(i) or stop <= lead:
            continue
        keep = np.zeros(len(i), bool)
        for at in range(0, len(i), 100_000):
            s = slice(at, at + 100_000)
            part[s] += np.einsum("ij,ij->i", x[i[s], lead:stop], y[j[s], lead:stop])
            keep[s] = part[s] + left_x[i[s], stop - 1] * left_y[j[s], stop - 1] >= threshold - slack - 1e-7
        i, j, part, lead = i[keep], j[keep], part[keep], stop
    exact = np.concatenate([
        np.einsum("ij,ij->i", a[i[s : s + 100_000]], b[j[s : s + 100_000]]) for s in range(0, len(i), 100_000)
    ]) if len(i) else np.zeros(0)
    ok = exact / (norm_a[i] * norm_b[j]) >= threshold
    return i[ok], j[ok]


def _spanning(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest row each of n rows reaches over the links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        root = root[root]
        if (root == before).all():
            return root


def _link(axes: np.ndarray, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                one, two = batch.column(0)[r], batch.column(1)[r]
                a, b = batch.column(2)[r].values, batch.column(3)[r].values
                same = one.as_py() == two.as_py()
                i, j = compare(matrix(a.field("vector")), matrix(b.field("vector")), axes, threshold, same)
                if not len(i):
                    continue
                ids = np.concatenate([a.field("id").to_numpy(), b.field("id").to_numpy()])
                copies = np.concatenate([a.field("copies").to_numpy(), b.field("copies").to_numpy()])
                j = j if same else j + len(a)
                # Rows in id order, so that the smallest row is the smallest id.
                order = np.argsort(ids, kind="stable")
                place = np.empty(len(ids), np.int64)
                place[order] = np.arange(len(ids))
                root = ids[order[_spanning(len(ids), place[i], place[j])[place]]]
                links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
                hit = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[hit]), pa.array(links[hit].astype(np.int64)), pa.array(root[hit])], ["id", "links", "root"]
                )

    return run


def near_vectors(
    table: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row; see the module for rows that take no part."""
    spark = table.sparkSession
    reach = math.sqrt(2 - 2 * threshold) + 1e-6
    vectors = clean_vectors(table, id_col, vector_col, label_col).where(F.col(label_col).isNotNull())
    keyed = vectors.select(
        "id", F.col(label_col).cast("string").alias("label_text"), "vector",
        F.size("vector").alias("size"), *(h.alias(n) for h, n in zip(hash_lanes(F.col("vector")), ("first", "second"))),
    )
    key = ["label", "size", "first", "second"]
    keyed = stage(keyed.select("id", F.xxhash64("label_text").alias("label"), "vector", "size", "first", "second"))
    classes = stage(
        keyed.groupBy(*key).agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("vector").alias("vector"))
    )
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x))
    axes = principal_axes(classes.select(F.transform("vector", lambda x: x / norm).alias("unit")))
    tiles = stage(_tiles(classes.select("label", "size", F.col("rep").alias("id"), "copies", "vector"), axes, reach))
    pairs = stage(_tile_pairs(tiles, reach))
    one = tiles.select("label", "size", F.col("tile").alias("one"), F.col("items").alias("a"))
    two = tiles.select("label", "size", F.col("tile").alias("two"), F.col("items").alias("b"))
    met = pairs.join(one, ["label", "size", "one"]).join(two, ["label", "size", "two"]).select("one", "two", "a", "b")
    with batches_of(spark, 16):
        found = stage(met.mapInArrow(_link(axes, threshold), "id bigint, links bigint, root bigint"))
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    per_class = classes.select(*key, "rep", "copies").join(counts, F.col("rep") == counts["id"], "left").drop("id")
    per_class = stage(per_class.join(roots, F.col("rep") == roots["id"], "left").select(
        *key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("component", "rep").alias("root")
    ))
    linked = stage(keyed.select("id", *key).join(per_class, key).groupBy("id").agg(F.max("links").alias("links"), F.min("root").alias("root")))
    for old in (keyed, classes, tiles, pairs, found, roots, per_class):
        release(old)
    every = table.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"))
    out = every.join(linked, every["vec_id"] == linked["id"], "left")
    component = F.coalesce("root", "vec_id")
    return out.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def op9_query(table: DataFrame) -> DataFrame:
    return near_vectors(table)

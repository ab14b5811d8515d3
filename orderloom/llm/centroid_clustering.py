"""Clustering around centroids in exact integers, with zone maps along a Hilbert curve.

Vectors are put in Hilbert order and stored in blocks with the smallest and largest value of each component. Where a
block's box shows that another centroid is nearer to all of it, no vector of the block is compared with a centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import partitions_for, staged

DIMENSIONS = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SEED = 3
BLOCK = 256  # vectors
AXES, AXIS_BITS = 8, 7  # of the curve; together they fit a long
LARGEST = 1 << 27  # of a component, so that squared distances fit a long
BLOCKS = "n int, box binary, total binary, v binary"


def integers(vectors: DataFrame, id_column: str, vector_column: str, dimensions: int, scale: int) -> DataFrame:
    """``id`` and the components ``v`` of the vectors that are whole: so many components, none null or non-finite."""
    x = F.col(vector_column)
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))

    def scaled(c: Column) -> Column:
        y = F.floor(c.cast("double") * scale)
        return F.when(F.abs(c.cast("double") * scale) < LARGEST, y).otherwise(
            F.raise_error(F.concat(F.lit("too large for distances in 64 bits: "), c.cast("string"))).cast("long")
        )

    whole = vectors.where((F.size(x) == dimensions) & F.forall(x, finite))
    return whole.select(F.col(id_column).alias("id"), F.transform(x, scaled).cast("array<int>").alias("v"))


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def axes(points: DataFrame, dimensions: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """How many points there are, their mean, and their AXES directions of largest spread with that spread; from sums over all points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, squares, n = np.zeros(dimensions), np.zeros((dimensions, dimensions)), 0
        for b in batches:
            v = _matrix(b.column(0), dimensions).astype(np.float64)
            sums += v.sum(0)
            squares += v.T @ v
            n += len(v)
        cells = np.concatenate([[n], sums, squares.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], ["cell", "x"])

    rows = points.select("v").mapInArrow(run, "cell long, x double").groupBy("cell").agg(F.sum("x").alias("x")).collect()
    cells = np.zeros(1 + dimensions + dimensions**2)
    for r in rows:  # one per pair of components
        cells[r["cell"]] = r["x"]
    n = int(cells[0])
    mean = cells[1 : 1 + dimensions] / max(n, 1)
    spread, directions = np.linalg.eigh(cells[1 + dimensions :].reshape(dimensions, dimensions) / max(n, 1) - np.outer(mean, mean))
    top = np.argsort(-spread, kind="stable")[:AXES]
    return n, mean, directions[:, top], np.sqrt(np.maximum(spread[top], 1e-9))


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places of cells on a Hilbert curve. ``cells``: a row per point of coordinates below 2**bits; at most 63 bits in all.

    From the highest bit down, the coordinates are reflected and exchanged into the frame of the cell
    they fall in (Skilling, 2004); the Gray code of the result, read across the coordinates, is the place.
    """
    x = cells.astype(np.int64).T.copy()
    for bit in reversed(range(1, bits)):
        below = (1 << bit) - 1
        for axis in x:
            high = axis >> bit & 1 == 1
            swap = np.where(high, 0, (x[0] ^ axis) & below)
            x[0] ^= np.where(high, below, swap)
            axis ^= swap
    for k in range(1, len(x)):
        x[k] ^= x[k - 1]
    flip = np.zeros(x.shape[1], np.int64)
    for bit in range(1, bits):
        flip ^= np.where(x[-1] >> bit & 1 == 1, (1 << bit) - 1, 0)
    x ^= flip
    keys = np.zeros(x.shape[1], np.int64)
    for bit in reversed(range(bits)):
        for axis in x:
            keys = keys << 1 | axis >> bit & 1
    return keys


def blocks(points: DataFrame, dimensions: int = DIMENSIONS) -> tuple[int, DataFrame]:
    """The number of points, and the points in Hilbert order as blocks: ``ids``, their components ``v``, sum ``total`` and ``box``.

    The curve runs through the AXES directions in which the points spread most. Equal vectors are told apart by row number,
    so that a hot vector is dealt over as many ranges as it fills.
    """
    n, mean, directions, spread = axes(points, dimensions)
    top, side = 1 << AXIS_BITS, 1 << AXIS_BITS - 1

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            along = (_matrix(b.column(1), dimensions) - mean) @ directions / spread
            cells = np.clip(np.floor(along * (side / 2.5) + side), 0, top - 1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(hilbert_keys(cells, AXIS_BITS))], [*b.schema.names, "key"])

    rows = points.withColumn("row", F.monotonically_increasing_id())
    keyed = rows.mapInArrow(key, T.StructType([*rows.schema.fields, T.StructField("key", T.LongType())]))
    ordered = keyed.repartitionByRange(partitions_for(points), "key", "row").sortWithinPartitions("key", "row").select("id", "v")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []
        for b in batches:
            kept.append(b)
            if sum(x.num_rows for x in kept) >= 64 * BLOCK:
                whole = pa.Table.from_batches(kept).combine_chunks().to_batches()[0]
                end = whole.num_rows // BLOCK * BLOCK
                yield _blocks(whole.slice(0, end), dimensions)
                kept = [whole.slice(end)]
        if kept and (whole := pa.Table.from_batches(kept).combine_chunks()).num_rows:
            yield _blocks(whole.to_batches()[0], dimensions)

    schema = T.StructType([T.StructField("ids", T.ArrayType(points.schema["id"].dataType)), *T.StructType.fromDDL(BLOCKS).fields])
    return n, staged(ordered.mapInArrow(cut, schema), "blocks")


def _blocks(points: pa.RecordBatch, dimensions: int) -> pa.RecordBatch:
    ids, v = points.column(0), _matrix(points.column(1), dimensions).astype("<i4")
    starts = list(range(0, len(v), BLOCK))
    parts = [v[k : k + BLOCK] for k in starts]
    boxes = [np.concatenate([p.min(0), p.max(0)]).tobytes() for p in parts]
    totals = [p.sum(0, dtype="<i8").tobytes() for p in parts]
    offsets = pa.array([*starts, len(v)], pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.ListArray.from_arrays(offsets, ids), pa.array([len(p) for p in parts], pa.int32()), pa.array(boxes, pa.binary()),
         pa.array(totals, pa.binary()), pa.array([p.tobytes() for p in parts], pa.binary())],
        ["ids", "n", "box", "total", "v"],
    )


def candidates(box: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to some point in the box (smallest, then largest components).

    Every centroid is held against the one whose farthest point of the box is nearest.
    """
    low, high = box[: len(box) // 2].astype(np.int64), box[len(box) // 2 :].astype(np.int64)
    farthest = (np.maximum(np.abs(centroids - low), np.abs(centroids - high)) ** 2).sum(1)
    best = centroids[farthest.argmin()]
    # the most by which the squared distance to the best one exceeds that to each centroid, anywhere in the box
    apart = centroids - best
    most = np.maximum(2 * low * apart, 2 * high * apart).sum(1) + (best**2).sum() - (centroids**2).sum(1)
    return np.flatnonzero(most >= 0)


def nearest(v: np.ndarray, centroids: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and squared distance to the nearest centroid of ``among``, ascending; the smaller number at a tie."""
    v = v.astype(np.int64)
    distances = np.stack([((v - centroids[c]) ** 2).sum(1) for c in among])
    best = distances.argmin(0)
    return among[best], distances[best, np.arange(len(v))]


def _round(parts: DataFrame, centroids: np.ndarray) -> tuple[list[int], list[list[int]]]:
    """Points nearest to each centroid and their componentwise sums; summed in the tasks, then by Spark."""
    k, d = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, d + 1), np.int64)
        for b in batches:
            for n, box, total, v in zip(*(b.column(j).to_pylist() for j in range(4)), strict=True):
                among = candidates(np.frombuffer(box, "<i4"), centroids)
                if len(among) == 1:  # the whole block
                    sums[among[0], 0] += n
                    sums[among[0], 1:] += np.frombuffer(total, "<i8")
                    continue
                points = np.frombuffer(v, "<i4").reshape(n, d)
                chosen, _ = nearest(points, centroids, among)
                for c in among:
                    mine = chosen == c
                    sums[c, 0] += mine.sum()
                    sums[c, 1:] += points[mine].sum(0, dtype=np.int64)
        at = np.arange(sums.size)
        yield pa.RecordBatch.from_arrays([pa.array(at // (d + 1)), pa.array(at % (d + 1)), pa.array(sums.ravel())], ["c", "cell", "x"])

    summed = parts.select("n", "box", "total", "v").mapInArrow(run, "c long, cell long, x long").groupBy("c", "cell").agg(F.sum("x").alias("x"))
    cells = [[0] * (d + 1) for _ in range(k)]
    for r in summed.collect():  # one per centroid and component
        cells[r["c"]][r["cell"]] = r["x"]
    return [c[0] for c in cells], [c[1:] for c in cells]


def _assigned(parts: DataFrame, centroids: np.ndarray, id_type: T.DataType) -> DataFrame:
    d = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(*(b.column(j).to_pylist() for j in (1, 2, 3)), strict=True)
            lists, step = b.column(0), 256
            for at in range(0, b.num_rows, step):
                found, counts = [], []
                for n, box, v in islice(rows, step):
                    among = candidates(np.frombuffer(box, "<i4"), centroids)
                    found.append(nearest(np.frombuffer(v, "<i4").reshape(n, d), centroids, among))
                    counts += [len(among)] * n
                cluster, distance = (np.concatenate(x) for x in zip(*found, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [lists.slice(at, step).flatten(), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64()), pa.array(counts, pa.int32())],
                    ["id", "cluster", "distance", "compared"],
                )

    schema = T.StructType([T.StructField("id", id_type), *T.StructType.fromDDL("cluster int, distance long, compared int").fields])
    return parts.select("ids", "n", "box", "v").mapInArrow(run, schema)


def cluster(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dimensions: int = DIMENSIONS,
    scale: int = SCALE,
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    seed: int = SEED,
) -> DataFrame:
    """Per whole vector its id, ``cluster``, squared ``distance``, the sums ``cluster_inertia`` and ``inertia``, ``centroid_sha256``, and ``compared``.

    Component x counts as floor(``scale`` * x). The ``k`` vectors with the least sha256 of "seed:id" are the first centroids; in
    each round every vector goes to the nearest one and each centroid that has any moves to the floor of
    their mean. ``compared`` is the number of centroids the vector's block could not rule out. All sums are exact.

    Defined cases: vectors that are null, of another length, or with a null, NaN or infinite component are left out; ties go to the
    smaller cluster; a null id counts as an empty one among the first centroids, equal ids go by their components; repeated rows
    are rows of their own; fewer vectors than ``k`` give fewer clusters, none gives no rows; other columns are passed over.
    A component of 2**27 or more after scaling fails the job: its distances would not fit 64 bits.
    """
    points = integers(vectors, id_column, vector_column, dimensions, scale)
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = points.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    id_type = points.schema["id"].dataType
    out = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "compared"]
    if not first:
        empty = points.select(F.col("id").alias(id_column), *[F.lit(None).cast(t).alias(c) for c, t in zip(out, _TYPES, strict=True)])
        return empty.where(F.lit(False))
    centroids = np.array([r["v"] for r in first], np.int64)
    _, parts = blocks(points, dimensions)
    for _ in range(rounds):
        counts, sums = _round(parts, centroids)
        centroids = np.array([[s // n for s in row] if n else old for n, row, old in zip(counts, sums, centroids.tolist(), strict=True)], np.int64)
    assigned = _assigned(parts, centroids, id_type)
    inertia = {r["cluster"]: r["x"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("x")).collect()}  # one per centroid
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    per_cluster = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    return assigned.select(
        F.col("id").alias(id_column), "cluster", "distance",
        per_cluster([inertia.get(c, 0) for c in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"), per_cluster(digests).alias("centroid_sha256"), "compared",
    )


_TYPES = ("int", "long", "long", "long", "string", "int")

"""Lloyd's clustering of integer vectors over zone maps in the order of a space-filling curve.

Vectors are laid out once along a Hilbert curve and cut into blocks; every block carries the least and
greatest value of each component (its box) and the sum of its vectors. In each round the distance bounds
between box and centroids leave the block's candidate centroids; a block with one candidate adds its sum
as it is, the others compare their vectors with their candidates exactly. Bounds only skip work: results
are those of the plain algorithm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..settings import written
from . import vectors

#: vectors of a block
BLOCK = 256
#: directions of the curve and bits of each
AXES = 8
BITS = 6
#: The curve's directions are fitted on at most so many rows; they shape the layout, not the result.
SAMPLE = 4096
#: vectors of one partition of the layout
SPREAD = 1 << 16


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with ``bits`` bits in each column (bits * columns < 64).

    The usual bit-plane method: undo the reflections of each level from the top, then the Gray code; the
    position is read off plane by plane.
    """
    x = cells.astype(np.int64).copy()
    columns = x.shape[1]
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for c in range(columns):
            turned = (x[:, c] >> level) & 1 == 1
            swap = np.where(turned, 0, (x[:, 0] ^ x[:, c]) & low)
            x[:, 0] ^= np.where(turned, low, swap)
            x[:, c] ^= swap
    for c in range(1, columns):
        x[:, c] ^= x[:, c - 1]
    flips = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        flips ^= np.where((x[:, -1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= flips[:, None]
    key = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for c in range(columns):
            key = (key << 1) | ((x[:, c] >> level) & 1)
    return key


@dataclass
class Curve:
    """Directions (one column each) and the cut points that give each of them BITS even bits."""

    axes: np.ndarray
    cuts: np.ndarray

    def keys(self, x: np.ndarray) -> np.ndarray:
        along = x @ self.axes
        cells = np.stack([np.searchsorted(c, a, "right") for c, a in zip(self.cuts, along.T, strict=True)], 1)
        return hilbert(cells, BITS)


def curve(x: np.ndarray) -> Curve:
    """Principal directions of a sample, cut at its quantiles."""
    centred = x - x.mean(0)
    _, directions = np.linalg.eigh(centred.T @ centred)
    axes = directions[:, ::-1][:, :AXES]
    cuts = np.quantile(x @ axes, np.arange(1, 1 << BITS) / (1 << BITS), axis=0).T
    return Curve(axes, cuts)


LAID = "vec_id long, q binary, size int, lo binary, hi binary, total binary"


def laid_out(rows: DataFrame, width: int, along: Curve, parts: int) -> DataFrame:
    """``rows`` (vec_id, q) along the curve, cut into blocks. The first row of a block carries its size,
    box and sum; rows of a block follow each other in one file."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = along.keys(vectors.matrix(batch.column(1), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys)], ["vec_id", "q", "key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks(table: pa.Table) -> pa.RecordBatch:
            part = table.combine_chunks().to_batches()[0]
            x = vectors.matrix(part.column(1), width).astype(np.int64)
            n = len(x)
            first = np.arange(0, n, BLOCK)
            sizes = np.minimum(BLOCK, n - first)
            heads = np.full(n, -1)
            heads[first] = np.arange(len(first))

            def spread(values: np.ndarray, kind: str) -> pa.Array:
                cells = [None] * n
                for at, row in zip(first, values, strict=True):
                    cells[at] = row.astype(kind).tobytes()
                return pa.array(cells, pa.binary())

            size = pa.array([int(sizes[h]) if h >= 0 else None for h in heads], pa.int32())
            lo = np.minimum.reduceat(x, first)
            hi = np.maximum.reduceat(x, first)
            total = np.add.reduceat(x, first)
            return pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), size, spread(lo, "<i4"), spread(hi, "<i4"), spread(total, "<i8")],
                ["vec_id", "q", "size", "lo", "hi", "total"],
            )

        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            count += batch.num_rows
            whole = count // BLOCK * BLOCK
            if whole:
                table = pa.Table.from_batches(held)
                yield blocks(table.slice(0, whole))
                held = table.slice(whole).to_batches()
                count -= whole
        if count:
            yield blocks(pa.Table.from_batches(held))

    keys = rows.mapInArrow(keyed, "vec_id long, q binary, key long")
    # equal vectors share a key: the second column spreads them over partitions
    ordered = keys.withColumn("tie", F.xxhash64("vec_id", F.monotonically_increasing_id()))
    ordered = ordered.repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie")
    return written(ordered.select("vec_id", "q").mapInArrow(cut, LAID))


def candidates(lo: np.ndarray, hi: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Blocks x centroids: whether the centroid can be the nearest of any point of the box, smaller
    numbers first among equals. Integers throughout, so the bounds are exact."""
    c = centroids[None]
    near = (np.maximum(np.maximum(lo[:, None] - c, c - hi[:, None]), 0) ** 2).sum(2)
    far = (np.maximum(c - lo[:, None], hi[:, None] - c) ** 2).sum(2)
    open_ = near <= far.min(1)[:, None]
    square = (centroids**2).sum(1)
    for k in range(len(centroids)):
        for other in range(len(centroids)):
            if other == k:
                continue
            # most that the point's squared distance to ``other`` can exceed the one to k over the box
            step = centroids[k] - centroids[other]
            most = square[other] - square[k] + 2 * (np.where(step > 0, hi, lo) * step).sum(1)
            open_[:, k] &= (most > 0) | ((most == 0) & (k < other))
    return open_


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid and squared distance; doubles that hold integers exactly."""
    c = centroids.astype(np.float64)
    d = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
    k = d.argmin(1)
    return k, d[np.arange(len(x)), k]


def _blocks(batch: pa.RecordBatch) -> tuple[np.ndarray, list]:
    heads = np.flatnonzero(np.asarray(batch.column(2).is_valid()))
    return heads, [batch.column(c).take(pa.array(heads)) for c in (2, 3, 4, 5)]


def _assigned(batch: pa.RecordBatch, width: int, centroids: np.ndarray, sums: bool):
    """Cluster and squared distance of a batch's rows; with ``sums`` only what each cluster gains (count
    and sum of vectors), where whole blocks with one candidate are never looked into."""
    n, k = batch.num_rows, len(centroids)
    heads, (size, lo, hi, total) = _blocks(batch)
    x = vectors.matrix(batch.column(1), width)
    sizes = np.asarray(size, np.int64) if len(heads) else np.zeros(0, np.int64)
    # candidate set of every row: rows before the first head (of a block that a batch cut) have all
    ends = np.append(heads[1:], n)
    sets = np.ones((1, k), bool)
    which = np.zeros(n, np.int64)
    counts = np.zeros(k, np.int64)
    gains = np.zeros((k, width), np.int64)
    if len(heads):
        unpack = lambda a, kind: np.frombuffer(b"".join(a.to_pylist()), kind).reshape(-1, width).astype(np.int64)
        open_ = candidates(unpack(lo, "<i4"), unpack(hi, "<i4"), centroids)
        distinct, number = np.unique(open_, axis=0, return_inverse=True)
        sets = np.concatenate([sets, distinct])
        which[heads[0] :] = np.repeat(number.reshape(-1) + 1, ends - heads)
        if sums:
            alone = open_.argmax(1)
            added = unpack(total, "<i8")
            for b in np.flatnonzero((open_.sum(1) == 1) & (ends - heads == sizes)):
                counts[alone[b]] += sizes[b]
                gains[alone[b]] += added[b]
                which[heads[b] : ends[b]] = -1
    cluster = np.zeros(n, np.int64)
    distance = np.zeros(n)
    for number, listed in enumerate(sets):
        rows = np.flatnonzero(which == number)
        if not len(rows):
            continue
        chosen = np.flatnonzero(listed)
        own, d = nearest(x[rows], centroids[chosen])
        cluster[rows], distance[rows] = chosen[own], d
        if sums:
            for c in chosen:
                mine = rows[chosen[own] == c]
                counts[c] += len(mine)
                gains[c] += x[mine].sum(0).astype(np.int64)
    return (counts, gains) if sums else (cluster, distance)


def moved(laid: DataFrame, width: int, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: the floored means of their vectors; empty ones stay. One row per
    cluster and component reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        gains = np.zeros((len(centroids), width), np.int64)
        for batch in batches:
            if batch.num_rows:
                n, s = _assigned(batch, width, centroids, True)
                counts += n
                gains += s
        some = np.flatnonzero(counts)
        if len(some):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), pa.array(counts[some]), pa.array(gains[some].tolist(), pa.list_(pa.int64()))], ["k", "n", "s"]
            )

    parts = laid.mapInArrow(run, "k long, n long, s array<long>")
    total = parts.selectExpr("k", "n", "posexplode(s) AS (i, x)").groupBy("k", "i").agg(F.sum("n"), F.sum("x"))
    out = centroids.copy()
    for k, i, n, x in total.collect():
        out[k, i] = x // n
    return out


@dataclass
class Clusters:
    """Final centroids and, per vector, ``vec_id, cluster, distance``."""

    centroids: np.ndarray
    members: DataFrame


def cluster(rows: DataFrame, start: np.ndarray, rounds: int) -> Clusters:
    """Lloyd's rounds from the ``start`` centroids over ``rows`` (vec_id, q), then one more assignment.

    Rows that share an id are vectors of their own; NULL ids are kept. Rounds end early when no centroid
    moved, since later ones would repeat the same result.
    """
    spark = rows.sparkSession
    width = start.shape[1]
    if not len(start):
        return Clusters(start, spark.createDataFrame([], "vec_id long, cluster int, distance long"))
    rows = written(rows.select("vec_id", "q"))
    drawn = vectors.sample(rows, "vec_id", SAMPLE).toArrow()
    along = curve(vectors.matrix(drawn.column("q").combine_chunks(), width))
    laid = laid_out(rows, width, along, max(1, -(-rows.count() // SPREAD)))
    centroids = start.astype(np.int64)
    for _ in range(rounds):
        after = moved(laid, width, centroids)
        if (after == centroids).all():
            break
        centroids = after

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                k, d = _assigned(batch, width, centroids, False)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(k.astype(np.int32)), pa.array(d.astype(np.int64))], ["vec_id", "cluster", "distance"]
                )

    members = laid.select("vec_id", "q", "size", "lo", "hi", "total").mapInArrow(run, "vec_id long, cluster int, distance long")
    return Clusters(centroids, written(members))


def starts(rows: DataFrame, width: int, k: int, salt: str) -> np.ndarray:
    """The ``k`` vectors (all, if fewer) with the smallest sha256 of salt:vec_id, in that order; equal
    hashes by the vector's bytes, NULL ids last."""
    order = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "q").limit(k).toArrow()
    return vectors.matrix(first.column("q").combine_chunks(), width).astype(np.int64)


def report(found: Clusters) -> DataFrame:
    """Members with the distance sums of their cluster and of all, and the centroid's digest. The joined
    side has one row per centroid."""
    members = found.members
    spark = members.sparkSession
    digests = [
        (k, hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for k, c in enumerate(found.centroids)
    ]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    sums = members.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    small = sums.withColumn("inertia", F.sum("cluster_inertia").over(W.partitionBy(F.lit(0)))).join(named, "cluster")
    return members.join(F.broadcast(small), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

"""Hard-negative mining with an inverted multi-index and certified windows.

Every vector is cut in two halves, each quantised by a codebook of its own; a cell is a pair of codes. The
inner product of an anchor with any vector of a cell is at most the sum of two half bounds: anchor half
times codeword plus length of the anchor half times the radius around the codeword. The multi-sequence
heap visits cells by falling bound. A search stops when its windows are certified, that is when no cell
that is left can hold a row that would enter the answer; so results are exact whatever the codebooks.

The index is a table ordered by cell and read in shards; anchors come in blocks of fixed size that travel
to the shards. Each shard returns a bounded list per window, and lists are merged in Spark.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.skew import positions
from ..settings import written
from . import vectors

#: The codebooks are fitted on at most so many rows; every row is indexed.
SAMPLE = 8192
#: Codes of a half: so many that a cell holds about CELL rows, within these bounds.
CELL, MOST_CODES = 64, 256
STEPS = 8
#: rows that one task searches at a time, and anchors that travel to all tasks at a time
SHARD = 1 << 15
ANCHORS = 1 << 14
#: anchors that share a walk over the cells
GROUP = 64
#: rows scored before the first look at the stop rule; doubled from look to look
LOOK = 2048


@dataclass
class Codebooks:
    """Two codebooks (codes x half width); ``split`` is where a vector is cut."""

    first: np.ndarray
    second: np.ndarray

    @property
    def split(self) -> int:
        return self.first.shape[1]

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return _code(x[:, : self.split], self.first), _code(x[:, self.split :], self.second)


def _code(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return ((book * book).sum(1) - 2 * (x @ book.T)).argmin(1).astype(np.int32)


def _book(x: np.ndarray, codes: int) -> np.ndarray:
    """Lloyd's steps over a sample, from rows spread evenly over it."""
    if not len(x):
        return np.zeros((1, x.shape[1]))
    book = x[np.linspace(0, len(x) - 1, min(codes, len(x))).astype(int)].copy()
    for _ in range(STEPS):
        own = _code(x, book)
        for k in np.unique(own):
            book[k] = x[own == k].mean(0)
    return book


def codebooks(rows: DataFrame, width: int, count: int) -> Codebooks:
    drawn = vectors.sample(rows, "vec_id", SAMPLE).toArrow()
    x = vectors.matrix(drawn.column("q").combine_chunks(), width)
    codes = int(np.clip(round((count / CELL) ** 0.5), 2, MOST_CODES))
    half = (width + 1) // 2
    return Codebooks(_book(x[:, :half], codes), _book(x[:, half:], codes))


def index(rows: DataFrame, books: Codebooks, width: int, count: int) -> DataFrame:
    """``rows`` (row, vec_id, label, q) with their cell, ordered by cell. Range partitions are cut inside
    a cell where it is large, so equal vectors do not meet in one task."""

    def celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i, j = books.cells(vectors.matrix(batch.column(3), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(i), pa.array(j)], ["row", "vec_id", "label", "q", "i", "j"])

    cells = rows.mapInArrow(celled, "row long, vec_id long, label int, q binary, i int, j int")
    parts = max(1, -(-count // SHARD))
    return written(cells.repartitionByRange(parts, "i", "j", "row").sortWithinPartitions("i", "j", "row"))


class Shard:
    """Rows of some cells, with the radius of every code that occurs."""

    def __init__(self, batches: list[pa.RecordBatch], books: Codebooks, width: int):
        table = pa.Table.from_batches(batches).combine_chunks()
        get = lambda c, kind: np.asarray(table.column(c), kind)
        i, j = get("i", np.int64), get("j", np.int64)
        order = np.lexsort((j, i))
        x = vectors.matrix(table.column("q").combine_chunks(), width)[order]
        i, j = i[order], j[order]
        self.x = x
        self.row, self.vec_id, self.label = get("row", np.int64)[order], get("vec_id", np.int64)[order], get("label", np.int64)[order]
        self.firsts, fi = np.unique(i, return_inverse=True)
        self.seconds, fj = np.unique(j, return_inverse=True)
        split = books.split
        self.book1, self.book2 = books.first[self.firsts], books.second[self.seconds]
        self.r1 = np.zeros(len(self.firsts))
        self.r2 = np.zeros(len(self.seconds))
        np.maximum.at(self.r1, fi, np.sqrt(((x[:, :split] - self.book1[fi]) ** 2).sum(1)))
        np.maximum.at(self.r2, fj, np.sqrt(((x[:, split:] - self.book2[fj]) ** 2).sum(1)))
        key = fi * len(self.seconds) + fj
        at = np.flatnonzero(np.diff(key, prepend=-1))
        ends = np.append(at[1:], len(key))
        self.cells = {int(key[a]): (int(a), int(e)) for a, e in zip(at, ends, strict=True)}
        self.split = split

    def walk(self, anchors: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """Cells as (bound, start, end) by falling bound of any inner product with any of the anchors:
        the multi-sequence walk over both halves' sorted bounds."""

        def halves(part: np.ndarray, book: np.ndarray, radius: np.ndarray):
            length = np.sqrt((part * part).sum(1))
            bound = (part @ book.T + length[:, None] * radius).max(0)
            order = np.argsort(-bound)
            return order, bound[order]

        o1, b1 = halves(anchors[:, : self.split], self.book1, self.r1)
        o2, b2 = halves(anchors[:, self.split :], self.book2, self.r2)
        heap = [(-(b1[0] + b2[0]), 0, 0)]
        wide = len(o2)
        left = len(self.cells)
        while heap and left:
            bound, a, b = heapq.heappop(heap)
            cell = self.cells.get(int(o1[a]) * wide + int(o2[b]))
            if cell:
                left -= 1
                yield -bound, *cell
            if b + 1 < wide:
                heapq.heappush(heap, (-(b1[a] + b2[b + 1]), a, b + 1))
            if b == 0 and a + 1 < len(o1):
                heapq.heappush(heap, (-(b1[a + 1] + b2[0]), a + 1, 0))

    def search(self, anchors: np.ndarray, look: Callable[[np.ndarray, np.ndarray], float]) -> int:
        """Show ``look`` (rows, scores by anchor) the rows cell by cell; it returns the least score that
        still matters. Ends when no cell that is left can reach it; returns the rows scored."""
        held: list[np.ndarray] = []
        size, limit, seen = 0, LOOK, 0
        need = -np.inf

        def flush() -> float:
            rows = np.concatenate(held)
            held.clear()
            return look(rows, self.x[rows] @ anchors.T)

        for bound, start, end in self.walk(anchors):
            # scores are integers: half a unit covers the rounding of the bound
            if bound + 0.5 + 1e-9 * abs(bound) < need:
                if not held:
                    return seen
                need = flush()
                size = 0
                if bound + 0.5 + 1e-9 * abs(bound) < need:
                    return seen
            held.append(np.arange(start, end))
            size += end - start
            seen += end - start
            if size >= limit:
                need = flush()
                size, limit = 0, limit * 2
        if held:
            flush()
        return seen


class Best:
    """The first ``k`` rows by score, then id, then row number, of those shown so far."""

    def __init__(self, k: int):
        self.k = k
        self.score, self.id, self.row = (np.zeros(0, np.int64) for _ in range(3))
        self.need = -np.inf

    def add(self, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if len(score) > 4 * self.k:
            least = np.partition(score, len(score) - self.k)[-self.k]
            keep = score >= least
            score, ids, rows = score[keep], ids[keep], rows[keep]
        score = np.concatenate([self.score, score.astype(np.int64)])
        ids, rows = np.concatenate([self.id, ids]), np.concatenate([self.row, rows])
        order = np.lexsort((rows, ids, -score))[: self.k]
        self.score, self.id, self.row = score[order], ids[order], rows[order]
        if len(order) == self.k:
            self.need = float(self.score[-1])


@dataclass
class Anchors:
    """A block of anchors, in the order of their labels and cells, so that groups walk alike."""

    row: np.ndarray
    label: np.ndarray
    x: np.ndarray

    def groups(self) -> Iterator[np.ndarray]:
        for at in range(0, len(self.row), GROUP):
            yield np.arange(at, min(at + GROUP, len(self.row)))


def _best_equals(shard: Shard, anchors: Anchors, k: int) -> Iterator[tuple]:
    """The shard's first ``k`` other rows of each anchor's label."""
    for group in anchors.groups():
        best = {a: Best(k) for a in group}

        def look(rows: np.ndarray, scores: np.ndarray) -> float:
            labels, numbers = shard.label[rows], shard.row[rows]
            for col, a in enumerate(group):
                s = scores[:, col]
                hit = np.flatnonzero((s >= best[a].need) & (labels == anchors.label[a]) & (numbers != anchors.row[a]))
                if len(hit):
                    best[a].add(s[hit], shard.vec_id[rows[hit]], numbers[hit])
            return min(b.need for b in best.values())

        shard.search(anchors.x[group], look)
        for a, b in best.items():
            for s, i, r in zip(b.score, b.id, b.row, strict=True):
                yield anchors.row[a], 0, s, i, r


def _best_windows(shard: Shard, anchors: Anchors, windows: list[list[tuple[int, int, int]]], k: int) -> Iterator[tuple]:
    """The shard's first ``k`` rows of other labels within each window (number, low, high) of an anchor."""
    for group in anchors.groups():
        # equal windows of an anchor are searched once
        best = {a: {(lo, hi): Best(k) for _, lo, hi in windows[a]} for a in group}
        group = np.array([a for a in group if best[a]], np.int64)
        if not len(group):
            continue

        def look(rows: np.ndarray, scores: np.ndarray) -> float:
            labels = shard.label[rows]
            least = np.inf
            for col, a in enumerate(group):
                own = best[a]
                top = max(hi for _, hi in own)
                need = min(max(lo, b.need) for (lo, _), b in own.items())
                s = scores[:, col]
                hit = np.flatnonzero((s >= need) & (s <= top) & (labels != anchors.label[a]))
                if len(hit):
                    s, found = s[hit], rows[hit]
                    for (lo, hi), b in own.items():
                        inside = (s <= hi) & (s >= max(lo, b.need))
                        if inside.any():
                            b.add(s[inside], shard.vec_id[found[inside]], shard.row[found[inside]])
                    need = min(max(lo, b.need) for (lo, _), b in own.items())
                least = min(least, need)
            return least

        shard.search(anchors.x[group], look)
        for a in group:
            for number, lo, hi in windows[a]:
                b = best[a][lo, hi]
                for s, i, r in zip(b.score, b.id, b.row, strict=True):
                    yield anchors.row[a], number, s, i, r


FOUND = "anchor long, number int, score long, vec_id long, row long"


def _over_shards(indexed: DataFrame, books: Codebooks, width: int, each: Callable[[Shard], Iterator[tuple]]) -> DataFrame:
    names = ["anchor", "number", "score", "vec_id", "row"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            for found in each(Shard(held, books, width)):
                rows.append(found)
                if len(rows) == 1 << 16:
                    yield packed(rows)
                    rows = []
            if rows:
                yield packed(rows)

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)

        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            for at in range(0, batch.num_rows, SHARD):
                part = batch.slice(at, SHARD)
                if size + part.num_rows > SHARD:
                    yield from done(held)
                    held, size = [], 0
                held.append(part)
                size += part.num_rows
        if held:
            yield from done(held)

    return indexed.mapInArrow(run, FOUND)


def _first(found: DataFrame, k: int) -> DataFrame:
    """The shards' lists merged: the first ``k`` by score, id and row number, with their rank."""
    order = W.partitionBy("anchor", "number").orderBy(F.desc("score"), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mined(
    rows: DataFrame,
    is_anchor,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Hard negatives of every anchor and positive.

    ``rows`` has ``vec_id, label, q``; rows with a NULL id or label take no part, vectors shorter than the
    longest count as filled with zeros, and rows that repeat, also under one id, are rows of their own. An
    anchor's positives are its best rows of the same label (itself excepted), its negatives for a
    positive the best rows of other labels whose score is between ``low`` and ``high`` percent of the
    positive's. Result: anchor_id, positive_id, rank, negative_id, positive_score, negative_score,
    positive_rank; positives without a negative have no row. An empty table gives no rows.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, positive_rank int"
    rows = rows.where("vec_id IS NOT NULL AND label IS NOT NULL").select("vec_id", F.col("label").cast("int").alias("label"), "q")
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()).select("row", "vec_id", "label", "q"))
    count, widest = rows.agg(F.count(F.lit(1)), F.max(F.octet_length("q"))).first()
    if not count:
        return spark.createDataFrame([], schema)
    width = max(2, widest // 4)
    books = codebooks(rows, width, count)
    indexed = index(rows, books, width, count)
    numbered = written(positions(indexed.where(is_anchor), [], ["label", "i", "j", "row"]))
    blocks = -(-numbered.count() // ANCHORS)
    out = None
    for block in range(blocks):
        part = numbered.where((F.col("position") > block * ANCHORS) & (F.col("position") <= (block + 1) * ANCHORS))
        got = part.orderBy("position").select("row", "vec_id", "label", "q").toArrow()
        anchors = Anchors(
            np.asarray(got.column("row"), np.int64),
            np.asarray(got.column("label"), np.int64),
            vectors.matrix(got.column("q").combine_chunks(), width),
        )
        equals = written(_first(_over_shards(indexed, books, width, lambda s: _best_equals(s, anchors, positives)), positives))
        place = {int(r): n for n, r in enumerate(anchors.row)}
        windows: list[list[tuple[int, int, int]]] = [[] for _ in place]
        # at most ``positives`` rows for each anchor of the block
        for anchor, rank, score in equals.select("anchor", "rank", "score").collect():
            least, most = -(-low * score // 100), high * score // 100
            if least <= most:
                windows[place[anchor]].append((rank, least, most))
        found = _over_shards(indexed, books, width, lambda s: _best_windows(s, anchors, windows, negatives))
        chosen = _first(found, negatives).select(
            "anchor", F.col("number").alias("positive_rank"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")
        )
        named = equals.select(
            "anchor", F.col("rank").alias("positive_rank"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")
        ).join(part.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        one = written(chosen.join(named, ["anchor", "positive_rank"]).select(*[n.split()[0] for n in schema.split(", ")]))
        out = one if out is None else out.unionAll(one)
    return spark.createDataFrame([], schema) if out is None else out

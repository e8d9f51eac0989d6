"""Exact removal of long repeated byte strings, decided on suffix arrays.

A byte goes when a string of LENGTH bytes that covers it also starts earlier (smaller doc_id, or further
left in the same document); strings never cross documents and are judged on the input.

Every window of LENGTH bytes chooses one of its places by content (least gram hash), so equal windows
choose equal places: two occurrences of a window are found under the same gram. Per gram:

1. Occurrences whose whole surroundings (all windows that can have chosen the place) are equal are the same
   passage; all but the earliest go at once. This takes most copies, by hash, in one shuffle.
2. The surroundings of the remaining, different occurrences are cut to what any other of the same gram
   shares; what is left is put together in blocks, the suffix array of each block is built by linear
   grouping, and runs with common prefixes of LENGTH or more are the equal windows.

Grams in a large share of all rows are cut into slices for step 1. Grams with more different surroundings
than one block takes are resolved window by window in a distributed aggregation instead.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..operators.skew import HOT_LOOK, hot_keys, positions
from ..settings import written
from . import words as W
from .anchors import GRAM, PART, chosen, prefix_sums
from .suffixes import common_prefixes, suffix_array

LENGTH = 100
#: Different surroundings of one gram that a task takes together (each at most 2 * LENGTH bytes).
GROUP = 20_000
#: Symbols of one suffix array, about; whole groups only.
BLOCK = 50_000
#: Documents with something to look up or remove are picked out by a broadcast up to this many rows and
#: list entries together, by a shuffle beyond.
BROADCAST = 4_000_000

#: Rows of one gram from which on its occurrences are laid out in slices.
HOT_FLOOR = 20_000

#: Bytes of the pieces from which hot grams are estimated.
PIECE = 1 << 16

#: place = 24 bits for the number of the document among those of its id, then 39 bits of position.
_POSITION = (1 << 39) - 1


def _ties(texts: DataFrame) -> DataFrame:
    """``texts`` with ``tie``: the number of the text among the different texts of its id, by hash. It is 0
    throughout when no id repeats, which a count of the ids alone shows."""
    if texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return texts.withColumn("tie", F.lit(0).cast("long"))
    key = ["_none", "_id", "_h1", "_h2"]
    keyed = (
        texts.withColumn("_none", F.col("doc_id").isNull())
        .withColumn("_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
        .withColumn("_h1", F.xxhash64("text"))
        .withColumn("_h2", F.xxhash64(F.lit("tie"), "text"))
    )
    # one id, such as NULL, may hold many of the rows: positions are found without giving a task the group
    numbers = positions(keyed.select(*key).distinct(), key[:2], key[2:])
    number = F.when(F.col("position") <= 1 << 24, F.col("position") - 1).otherwise(
        F.raise_error(F.lit("more than 2^24 different texts under one id")).cast("long")
    )
    return keyed.join(numbers.select(*key, number.alias("tie")), key).drop(*key)


def _pieces(texts: DataFrame, look: int) -> DataFrame:
    """One in ``look`` of the PIECE-byte pieces of all texts, as texts of their own (``doc_id, text, tie``).
    Windows over a border are not seen, so this serves estimates alone."""
    at = F.explode(F.sequence(F.lit(0), F.expr(f"cast((octet_length(text) - 1) div {PIECE} as int)")))
    cut = texts.where(F.octet_length("text") > 0).select("doc_id", "text", "tie", at.alias("_piece"))
    cut = cut.where(F.pmod(F.xxhash64("doc_id", "tie", "_piece"), F.lit(look)) == 0)
    return cut.select(
        "doc_id",
        F.substring(F.col("text").cast("binary"), F.col("_piece") * PIECE + 1, F.lit(PIECE)).alias("text"),
        F.col("_piece").cast("long").alias("tie"),
    )


def _parts(at: np.ndarray, length: int) -> Iterator[tuple[int, int, int, int]]:
    """Row ranges of about PART bytes, and pieces of longer rows that overlap by length - 1 bytes: first
    row, end row, first byte, end byte."""
    for low, high in W.blocks(at, PART):
        a, b = int(at[low]), int(at[high])
        if b - a <= PART:
            yield low, high, a, b
            continue
        step = PART - length + 1
        for start in range(a, b, step):
            yield low, high, start, min(b, start + PART)
            if start + PART >= b:
                break


def _occurrences(length: int):
    left = length - GRAM

    def look(batches):
        for batch in batches:
            data, at = W.buffers(batch.column(1))
            tie = batch.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
            h, row_, place, around = [], [], [], []
            for low, high, a, b in _parts(at, length):
                whole = b - a == at[high] - at[low]
                edges = at[low : high + 1] - a if whole else np.array([0, b - a])
                total, down = prefix_sums(data[a:b])
                p, grams = chosen(total, down, edges, length)
                row = np.searchsorted(edges, p, "right") - 1
                if whole:
                    s, e = np.maximum(p - left, edges[row]), np.minimum(p + length, edges[row + 1])
                    c = _hash(total, down, s, e)
                else:
                    # surroundings may reach over the piece's edge, into the rest of the row
                    s = np.maximum(p + a - left, at[low])
                    e = np.minimum(p + a + length, at[high])
                    c = _far(data, s, e)
                    s, e = s - a, e - a
                h.append(grams)
                row_.append(row + low)
                place.append(p + a - at[row + low])
                around.append(W.mix(c + (p - s).astype(np.uint64) * np.uint64(65599) + (e - p).astype(np.uint64)))
            if not h:
                continue
            row = np.concatenate(row_)
            out = [np.concatenate(h).view(np.int64), tie[row] << np.int64(39) | np.concatenate(place), np.concatenate(around).view(np.int64)]
            yield pa.record_batch([pa.array(out[0]), batch.column(0).take(pa.array(row)), pa.array(out[1]), pa.array(out[2])], names=["h", "doc_id", "place", "around"])

    return look


def _hash(total: np.ndarray, down: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    return W.mix((total[e] - total[s]) * down[s])


def _far(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Like ``_hash``, one stretch at a time from the bytes."""
    out = np.zeros(len(s), np.uint64)
    for k, (a, b) in enumerate(zip(s.tolist(), e.tolist(), strict=True)):
        total, down = prefix_sums(data[a:b])
        out[k] = _hash(total, down, np.array([0]), np.array([b - a]))[0]
    return out


def _cut(members: list[tuple[bytes, bytes]], length: int) -> list[tuple[int, int]]:
    """How far to the left and right each member shares with any other of its gram."""
    out = []
    for side in (0, 1):
        strings = [m[side][::-1] if side == 0 else m[side] for m in members]
        order = sorted(range(len(strings)), key=strings.__getitem__)
        best = [0] * len(strings)
        for a, b in zip(order[:-1], order[1:], strict=True):
            x, y = strings[a], strings[b]
            n = min(len(x), len(y))
            if x[:n] == y[:n]:
                k = n
            else:
                low, high = 0, n
                while high - low > 1:
                    mid = (low + high) // 2
                    low, high = (mid, high) if x[:mid] == y[:mid] else (low, mid)
                k = low
            best[a], best[b] = max(best[a], k), max(best[b], k)
        out.append(best)
    return list(zip(*out, strict=True))


class _Solver:
    """Collects the cut surroundings of grams and resolves them block by block."""

    def __init__(self, length: int):
        self.length = length
        self.symbols: list[int] = []
        self.owner: list[tuple] = []  # first symbol, key, place of the first byte in its document
        self.removed: list[tuple] = []  # document, start, end

    def add(self, rows: list[dict]) -> None:
        """The different surroundings of one gram."""
        members = [(r["bytes"][: r["before"]], r["bytes"][r["before"] :]) for r in rows]
        by_text: dict[tuple[int, bytes], tuple] = {}
        for r, m, (left, right) in zip(rows, members, _cut(members, self.length), strict=True):
            if left + right < self.length:
                continue
            text = m[0][len(m[0]) - left :] + m[1][:right]
            key = r["order"]
            position = (r["place"] & _POSITION) - left
            known = by_text.get((left, text))
            if known is None:
                by_text[left, text] = (key, r, position)
            else:
                # the same stretch, all of it in windows: only the earliest stays
                later = max(known, (key, r, position), key=lambda x: x[0])
                by_text[left, text] = min(known, (key, r, position), key=lambda x: x[0])
                self.removed.append((later[1]["doc_id"], later[1]["place"], later[2], later[2] + len(text)))
        if len(by_text) > 1:
            for (_, text), (key, r, position) in by_text.items():
                self.owner.append((len(self.symbols), key, r, position))
                self.symbols.extend(b + 2 for b in text)
                self.symbols.append(1)

    def _repeats(self, array: np.ndarray, equal: np.ndarray) -> None:
        """All windows of each run of equal ones go but the earliest; ``equal``: a suffix and the one before
        it in ``array`` have a window in common."""
        inside = equal.copy()
        inside[:-1] |= equal[1:]
        at = array[inside]
        if not len(at):
            return
        run = np.cumsum(~equal)[inside]
        owner = np.searchsorted(np.array([o[0] for o in self.owner]), at, "right") - 1
        # documents in their order; surroundings of neighbouring grams overlap, so a window may be here twice
        documents = {k: i for i, k in enumerate(sorted({o[1][0] for o in self.owner}))}
        document = np.array([documents[o[1][0]] for o in self.owner])[owner]
        offset = np.array([o[3] - o[0] for o in self.owner])
        position = at + offset[owner]
        wide = np.int64(1) << np.int64(40)
        rank = document * wide + position
        first = np.concatenate(([0], np.flatnonzero(np.diff(run)) + 1))
        least = np.minimum.reduceat(rank, first)
        gone = rank != np.repeat(least, np.diff(np.append(first, len(rank))))
        rank, owner = rank[gone], owner[gone]
        if not len(rank):
            return
        rank, which = np.unique(rank, return_index=True)
        owner = owner[which]
        breaks = np.flatnonzero(np.diff(rank) > self.length)
        heads, tails = np.append(0, breaks + 1), np.append(breaks, len(rank) - 1)
        for k, low, high in zip(owner[heads].tolist(), (rank[heads] % wide).tolist(), (rank[tails] % wide).tolist(), strict=True):
            r = self.owner[k][2]
            self.removed.append((r["doc_id"], r["place"], low, high + self.length))

    def full(self) -> bool:
        return len(self.symbols) >= BLOCK

    def solve(self) -> list[tuple]:
        """Removed stretches of everything added so far: doc_id, place (for its tie), start, end."""
        length = self.length
        if self.owner:
            # separators differ, so no window is equal across them; they stay below all bytes
            symbols, many = self.symbols, len(self.owner)
            symbols = [x + many if x != 1 else 0 for x in symbols]
            ends = [o[0] - 1 for o in self.owner[1:]] + [len(symbols) - 1]
            for k, e in enumerate(ends):
                symbols[e] = k + 1
            symbols.append(0)
            array = suffix_array(symbols)
            shared = common_prefixes(symbols, array)
            self._repeats(np.array(array), np.array(shared) >= length)
        out = self.removed
        self.symbols, self.owner, self.removed = [], [], []
        return out


SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
REMOVED = "doc_id {kind}, tie long, first long, end long"


def _solved(length: int, id_type: pa.DataType):
    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        doc, place, first, end = zip(*rows, strict=True)
        return pa.record_batch(
            [pa.array(doc, id_type), pa.array([p >> 39 for p in place], pa.int64()), pa.array(first, pa.int64()), pa.array(end, pa.int64())],
            names=["doc_id", "tie", "first", "end"],
        )

    def solve(batches):
        solver = _Solver(length)
        group: list[dict] = []

        def close():
            if len(group) > 1:
                solver.add(group)
            group.clear()

        for batch in batches:
            for r in batch.to_pylist():
                if group and r["h"] != group[0]["h"]:
                    close()
                    if solver.full():
                        rows = solver.solve()
                        if rows:
                            yield batch_of(rows)
                # documents in order, NULL ids first; then the one of two with the same id, then the place
                d = r["doc_id"]
                r["order"] = ((d is not None, d if d is not None else 0, r["place"] >> 39), r["place"] & _POSITION)
                group.append(r)
        close()
        rows = solver.solve()
        if rows:
            yield batch_of(rows)

    return solve


def _picked(docs: DataFrame, lists: DataFrame, size: int) -> DataFrame:
    """Documents joined to their row of ``lists`` (id_, tie_, ...), by broadcast while it is small."""
    side = F.broadcast(lists) if size <= BROADCAST else lists
    return docs.join(side, F.col("doc_id").eqNullSafe(F.col("id_")) & (F.col("tie") == F.col("tie_")), "left")


def removals(
    docs: DataFrame, length: int = LENGTH, group: int = GROUP, floor: int = HOT_FLOOR, look: int = HOT_LOOK
) -> DataFrame:
    """Stretches of bytes to remove, per document: id_, tie_ and sorted ``stretches`` (first, end) that
    neither touch nor overlap; ends may lie beyond the text. ``floor`` and ``look`` say from which
    (estimated) number of rows on a gram is cut into slices, see ``skew.hot_keys``."""
    if length < GRAM + 1:
        raise ValueError(f"length must be above {GRAM}")
    left = length - GRAM
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_type = to_arrow_type(docs.schema["doc_id"].dataType)
    texts = _ties(docs.select("doc_id", "text"))
    found = texts.where(F.octet_length("text") >= length).mapInArrow(_occurrences(length), f"h long, doc_id {kind}, place long, around long")
    # hot grams are looked for in pieces of the texts, drawn before the costly step
    drawn = _pieces(texts, look).mapInArrow(_occurrences(length), f"h long, doc_id {kind}, place long, around long")
    hot = hot_keys(drawn, ["h"], ["doc_id", "place"], max(1, floor // look), 1, keep=True)
    found = found.withColumn("cut", F.lit(0).cast("long")) if hot is None else (
        found.join(F.broadcast(hot), "h", "left")  # at most 10,000 rows
        .withColumn("cut", F.coalesce(F.pmod(F.xxhash64("doc_id", "place"), F.col("_slices")) + 1, F.lit(0)))
        .drop("_slices")
    )
    # a row that the table has twice is one occurrence
    place = ["doc_id", "place"]
    here = Window.partitionBy("h", "cut")
    same = Window.partitionBy("h", "cut", "around").orderBy(*place)
    repeated = found.withColumn("k", F.count(F.lit(1)).over(here)).where("k > 1 or cut > 0").drop("k")
    repeated = written(repeated.withColumn("turn", F.rank().over(same)).withColumn("nth", F.row_number().over(same)))
    copies = repeated.where("turn > 1").select(*place)
    firsts = repeated.where("nth = 1").select("h", "around", *place, "cut")
    kinds = firsts.drop("cut")
    if hot is not None:
        # what is first in its slice is looked at once more, over all slices of its gram
        again = Window.partitionBy("h", "around").orderBy(*place)
        sliced = written(firsts.where("cut > 0").drop("cut").withColumn("turn", F.rank().over(again)))
        copies = copies.unionAll(sliced.where("turn > 1").select(*place))
        kinds = firsts.where("cut = 0").drop("cut").unionAll(sliced.where("turn = 1").drop("turn"))
    spot = F.col("place").bitwiseAND(F.lit(_POSITION))
    tie = F.shiftright("place", 39)
    gone = copies.select("doc_id", tie.alias("tie"), F.greatest(spot - left, F.lit(0)).alias("first"), (spot + length).alias("end"))

    sizes = kinds.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    several = kinds.join(sizes, "h").select("h", *place, "m")
    wanted = several.groupBy(F.col("doc_id").alias("id_"), F.shiftright("place", 39).alias("tie_")).agg(
        F.collect_list(F.struct("h", "m", F.col("place").bitwiseAND(F.lit(_POSITION)).alias("at"))).alias("places")
    )
    # at most a row and a list entry for each place
    size, most = (n or 0 for n in sizes.agg(2 * F.sum("m"), F.max("m")).first())

    def surroundings(batches):
        for batch in batches:
            data, at = W.buffers(batch.column(1))
            out = []
            for row, places in enumerate(batch.column(3).to_pylist()):
                a, b = int(at[row]), int(at[row + 1])
                for p in places:
                    s, e = max(a, a + p["at"] - left), min(b, a + p["at"] + length)
                    out.append((p["h"], row, p["at"], a + p["at"] - s, data[s:e].tobytes(), p["m"]))
            if out:
                h, row, spot_, before, raw, m = zip(*out, strict=True)
                ties = batch.column(2).take(pa.array(row)).to_numpy().astype(np.int64) << np.int64(39) | np.array(spot_, np.int64)
                yield pa.record_batch(
                    [pa.array(h, pa.int64()), batch.column(0).take(pa.array(row)), pa.array(ties), pa.array(before, pa.int32()), pa.array(raw, pa.binary()), pa.array(m, pa.int64())],
                    names=["h", "doc_id", "place", "before", "bytes", "m"],
                )

    shown = _picked(texts, wanted, size).where("places is not null").select("doc_id", "text", "tie", "places")
    shown = shown.mapInArrow(surroundings, f"h long, doc_id {kind}, place long, before int, bytes binary, m long").dropDuplicates(["h", "doc_id", "place"])
    wide = most > group
    if wide:
        shown = written(shown)
    small = shown.where(f"m <= {group}").repartition("h").sortWithinPartitions("h", *place)
    gone = gone.unionAll(small.mapInArrow(_solved(length, id_type), REMOVED.format(kind=kind)))
    if wide:
        gone = gone.unionAll(_by_window(shown.where(f"m > {group}"), length))
    bounds = gone.groupBy("doc_id", "tie").agg(F.sort_array(F.collect_list(F.struct("first", "end"))).alias("all"))

    def merge(batches):
        for batch in batches:
            lists = batch.column(2)
            flat = lists.flatten()
            n = np.asarray(lists.value_lengths())
            first, end = (np.asarray(flat.field(k)) for k in (0, 1))
            row = np.repeat(np.arange(len(n)), n)
            # running maximum of the ends within each list: lists are told apart by their high bits
            lead = row.astype(np.int64) << np.int64(41)
            reach = np.maximum.accumulate(lead + end)
            new = np.ones(len(first), bool)
            new[1:] = lead[1:] + first[1:] > reach[:-1]
            heads = np.flatnonzero(new)
            tails = np.append(heads[1:] - 1, len(first) - 1) if len(heads) else heads
            merged = pa.StructArray.from_arrays([pa.array(first[heads]), pa.array(reach[tails] - lead[tails])], ["first", "end"])
            edges = np.concatenate(([0], np.cumsum(np.bincount(row[heads], minlength=len(n))))).astype(np.int32)
            yield pa.record_batch([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(edges), merged)], names=["id_", "tie_", "stretches"])

    return bounds.mapInArrow(merge, f"id_ {kind}, tie_ long, stretches array<struct<first:long,end:long>>")


def _by_window(shown: DataFrame, length: int) -> DataFrame:
    """Removed windows of grams with very many different surroundings, window by window."""
    at = F.sequence(F.lit(1), F.length("bytes") - length + 1)
    windows = shown.where(F.length("bytes") >= length).select(
        "h", "doc_id", "place", "before", F.explode(at).alias("i"), "bytes"
    )
    windows = windows.select(
        "h",
        "doc_id",
        F.shiftright("place", 39).alias("tie"),
        (F.col("place").bitwiseAND(F.lit(_POSITION)) - F.col("before") + F.col("i") - 1).alias("first"),
        F.md5(F.substring("bytes", F.col("i"), F.lit(length))).alias("window"),
    )
    windows = written(windows)
    key = F.struct("doc_id", "tie", "first")
    least = windows.groupBy("window").agg(F.min(key).alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return windows.join(least, "window").where(key != F.col("least")).select("doc_id", "tie", "first", (F.col("first") + length).alias("end"))


def _merged(stretches: list[dict] | None, n: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in stretches or ():
        first, end = s["first"], min(s["end"], n)
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        elif first < end:
            out.append([first, end])
    return [(a, b) for a, b in out]


def deduplicated(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: n_bytes, n_removed, n_spans, the ``kept`` bytes and the removed ``spans`` of bytes.

    NULL texts are empty. Rows that share an id but not the text are separate documents, in the order of
    a hash of their texts; rows that share both are one document for the comparison, and each is returned.
    """
    lists = written(removals(docs, length))
    size = lists.agg(F.sum(F.size("stretches") + 1)).first()[0] or 0
    kind = docs.schema["doc_id"].dataType.simpleString()

    def keep(batches):
        for batch in batches:
            data, at = W.buffers(batch.column(1))
            sizes, gone, many, kept, spans = [], [], [], [], []
            for row, stretches in enumerate(batch.column(2).to_pylist()):
                text = data[at[row] : at[row + 1]].tobytes()
                out = _merged(stretches, len(text))
                pieces, done = [], 0
                for a, b in out:
                    pieces.append(text[done:a])
                    done = b
                pieces.append(text[done:])
                kept.append(b"".join(pieces))
                sizes.append(len(text))
                gone.append(len(text) - len(kept[-1]))
                many.append(len(out))
                spans.append([{"first": a, "end": b} for a, b in out])
            yield pa.record_batch(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(gone, pa.int64()), pa.array(many, pa.int64()), pa.array(kept, pa.binary()), pa.array([hashlib.sha256(k).hexdigest() for k in kept]), pa.array(spans, SPANS)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", "spans"],
            )

    rows = _picked(_ties(docs.select("doc_id", "text")), lists, size).select("doc_id", "text", "stretches")
    return rows.mapInArrow(
        keep, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string, spans array<struct<first:long,end:long>>"
    )

"""Items of JSON documents that are too large for one task, read in byte ranges.

Spark's text reader cuts a file at its split size; with ``}`` as the record separator every record ends
right behind a brace, so no escape sequence and no key in front of its value is ever cut. What a range does
to the nesting is an ``Outline``: how many open containers it closes, which ones it leaves open, how many
elements it adds, and whether it ends inside a string. Outlines compose, and each range has one for either
start (inside a string or not), so a first pass over all ranges in parallel and a scan over one small row
per range give every range its exact start. The second pass emits the elements of the item list with their
positions; only an element that lies in several ranges is put together by a shuffle.

A document counts as whole when its brackets and strings are balanced; a truncated one gives no items, as
with small pages. Inside a balanced document an element that is no valid JSON gives NULL fields.

An envelope (``content[0].text``) is the same work twice: the ranges of the inner document are the
unescaped ranges of that string.
"""

from __future__ import annotations

import json
import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..settings import written

#: Levels of nesting whose containers are told apart; list keys lie one or two objects deep.
LEVELS = 4
#: Beginning and end of a document that show whether it is an envelope.
EDGE = 1 << 16
#: Range starts (about 300 bytes each) go to all tasks by broadcast up to this number: 128 TB of ranges of 128 MB.
BROADCAST_RANGES = 1_000_000

_MARK = np.zeros(256, np.int8)
for _byte, _kind in zip(b"{[}],", (1, 1, -1, -1, 2), strict=True):
    _MARK[_byte] = _kind


@dataclass(frozen=True)
class Container:
    """An open container: its bracket, the key it stands under (None in a list), commas seen so far, and
    where it was opened (range, byte in the range)."""

    bracket: str
    key: str | None
    commas: int
    at: tuple[int, int]


@dataclass
class Outline:
    """What a stretch of text does to the nesting, for one start state."""

    inside: bool
    #: containers of the start that it closes, and per level (from the innermost) the commas it adds
    closed: int = 0
    commas: list[int] = field(default_factory=lambda: [0])
    #: number of containers left open, and the outermost LEVELS of them
    opened: int = 0
    open: list[Container] = field(default_factory=list)
    #: wanted lists: (level relative to the start, key, key of the object around or None if it began
    #: earlier) -> where the last one opened
    lists: dict[tuple[int, str, str | None], tuple[int, int]] = field(default_factory=dict)

    @property
    def rise(self) -> int:
        return self.opened - self.closed

    def then(self, after: Outline) -> Outline:
        """This stretch followed by ``after``."""
        out = replace(self, inside=after.inside, commas=list(self.commas), open=list(self.open), lists=dict(self.lists))
        for (level, key, around), at in after.lists.items():
            if around is None:
                outer = self.opened - (1 - level) - 1
                around = (self.open[outer].key or "") if 0 <= outer < len(self.open) else None
            out.lists[level + self.rise, key, around] = at
        gain = after.commas
        if after.closed < self.opened:
            left = self.opened - after.closed
            out.open = self.open[:left]
            if left <= len(out.open):
                top = out.open[-1]
                out.open[-1] = replace(top, commas=top.commas + gain[after.closed])
            out.opened = left + after.opened
            if left < LEVELS and len(out.open) == left:
                out.open = (out.open + after.open)[:LEVELS]
        else:
            out.commas[-1] += gain[self.opened]
            out.commas += gain[self.opened + 1 :]
            out.closed = self.closed + after.closed - self.opened
            out.opened, out.open = after.opened, list(after.open)
        return out


@dataclass
class Marks:
    """Brackets and commas of a piece of text: positions, kinds, and the number of quotes before each."""

    data: np.ndarray
    spots: np.ndarray
    before: np.ndarray
    quotes: np.ndarray

    def outside(self, inside: bool) -> np.ndarray:
        return self.spots[(self.before + inside) % 2 == 0]


def marks(text: bytes) -> Marks:
    data = np.frombuffer(text, np.uint8)
    quotes = np.flatnonzero(data == 34)
    slashes = np.flatnonzero(data == 92)
    if len(slashes) and len(quotes):
        # a quote is escaped behind an odd run of backslashes
        begins = np.maximum.accumulate(np.where(np.diff(slashes, prepend=-2) != 1, np.arange(len(slashes)), 0))
        near = np.searchsorted(slashes, quotes) - 1
        run = np.where((near >= 0) & (slashes[near] == quotes - 1), quotes - slashes[begins[near]], 0)
        quotes = quotes[run % 2 == 0]
    spots = np.flatnonzero(_MARK[data])
    return Marks(data, spots, np.searchsorted(quotes, spots), quotes)


def key_before(text: bytes, spot: int) -> str | None:
    """The key whose value begins at ``spot``; None in a list, at the top, or if its text is cut."""
    head = text[max(0, spot - 512) : spot].rstrip(b" \t\r\n")
    if not head.endswith(b":"):
        return None
    found = re.search(rb'"((?:[^"\\]|\\.)*)"$', head[:-1].rstrip(b" \t\r\n"))
    return found[1].decode("utf-8", "replace") if found else None


def outline(text: bytes, found: Marks, inside: bool, at: tuple[int, int], wanted: re.Pattern | None) -> Outline:
    """The outline of ``text``, which begins ``at`` (range, byte in the range)."""
    spots = found.outside(inside)
    out = Outline(bool((len(found.quotes) + inside) % 2))
    if not len(spots):
        return out
    kinds = _MARK[found.data[spots]]
    depth = np.cumsum(np.where(kinds == 2, 0, kinds))
    lowest = np.minimum(np.minimum.accumulate(depth), 0)
    out.closed = int(-lowest[-1])
    base = (kinds == 2) & (depth == lowest)
    out.commas = np.bincount(-depth[base], minlength=out.closed + 1).tolist()
    out.opened = int(depth[-1]) + out.closed
    rest = np.minimum.accumulate(depth[::-1])[::-1]
    stay = np.flatnonzero((kinds == 1) & (rest >= depth))[:LEVELS]
    for i in stay:
        later = kinds[i + 1 :] == 2
        spot = int(spots[i])
        out.open.append(
            Container(chr(text[spot]), key_before(text, spot), int((depth[i + 1 :][later] == depth[i]).sum()), (at[0], at[1] + spot))
        )
    for match in wanted.finditer(text) if wanted else ():
        i = int(np.searchsorted(spots, match.end() - 1))
        if i == len(spots) or spots[i] != match.end() - 1 or depth[i] > LEVELS:
            continue
        begin = int(np.searchsorted(found.quotes, match.start()))
        if begin == len(found.quotes) or found.quotes[begin] != match.start():
            continue  # the quote in front is escaped: the end of a longer key
        around = np.flatnonzero((kinds[:i] == 1) & (depth[:i] == depth[i] - 1))
        # the object around it began here only if its level was not left since
        own = around[-1] if len(around) and depth[around[-1] : i].min() >= depth[i] - 1 else None
        key = (key_before(text, int(spots[own])) or "") if own is not None else None
        out.lists[int(depth[i]), match[1].decode(), key] = (at[0], at[1] + match.end() - 1)
    return out


def wanted_lists(keys: tuple[str, ...]) -> re.Pattern:
    names = sorted({k.split(".")[-1] for k in keys})
    return re.compile(b'"(' + b"|".join(re.escape(n.encode()) for n in names) + rb')"\s*:\s*\[')


# ---- first pass: one row per range -----------------------------------------------------------------------

RANGE = "path string, block long, size long, bytes long, quotes long, outlines binary, head binary, tail binary"


def _bytes(values: pa.Array) -> bytes:
    """The texts of a string column without gaps, one after the other."""
    values = values.cast(pa.large_string())
    _, offsets, data = values.buffers()
    at = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    return data.slice(int(at[0]), int(at[-1] - at[0])).to_pybytes() if data is not None else b""


def by_range(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple[pa.RecordBatch, bytes | None]]]]:
    """Batches of (path, block, value, ...) cut where the range changes: ((path, block), row, text)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        paths, blocks = batch.column(0).to_pylist(), np.asarray(batch.column(1), np.int64)
        change = np.flatnonzero([True] + [paths[i] != paths[i - 1] or blocks[i] != blocks[i - 1] for i in range(1, len(paths))])
        for low, high in zip(change, np.append(change[1:], len(paths)), strict=True):
            part = batch.slice(low, high - low)
            values = part.column(2)
            text = None if values.null_count else _bytes(values)
            yield (paths[low], int(blocks[low])), part, text


def outlines(rows: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """One row per range of ``rows`` (path, block, value, size), in the order of the file within a range."""
    wanted = wanted_lists(keys)
    names = [f.split()[0] for f in RANGE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def row() -> pa.RecordBatch:
            (path, block), size, done, quotes, both, head, tail = current, *state
            cells = [path, block, size, done, quotes, pickle.dumps(both), bytes(head), bytes(tail)]
            types = [pa.string(), *[pa.int64()] * 4, *[pa.binary()] * 3]
            return pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cells, types, strict=True)], names)

        for where, part, text in by_range(batches):
            if where != current:
                if current is not None:
                    yield row()
                current = where
                state = [part.column(3)[0].as_py(), 0, 0, [Outline(False), Outline(True)], b"", b""]
            if text is None or state[3] is None:
                state[3] = None  # a piece that could not be unescaped
                continue
            found = marks(text)
            at = (where[1], state[1])
            # a start outside and a start inside a string see each other's complement of the text
            one = {inside: outline(text, found, inside, at, wanted) for inside in (False, True)}
            state[3] = [o.then(one[o.inside]) for o in state[3]]
            state[1] += len(text)
            state[2] += len(found.quotes)
            state[4] = state[4] if len(state[4]) >= EDGE else (state[4] + text[:EDGE])[:EDGE]
            state[5] = (state[5] + text[-EDGE:])[-EDGE:]
        if current is not None:
            yield row()

    return rows.mapInArrow(run, RANGE)


# ---- scan: the start of every range, the list that counts ------------------------------------------------

_SCALAR = rb'"[^"]*"\s*:\s*(?:"(?:[^"\\]|\\.)*"|[^,"{}\[\]]+)\s*,\s*'
_ENVELOPE = re.compile(rb'^\s*\{\s*(?:' + _SCALAR + rb')*?"content"\s*:\s*\[\s*\{\s*((?:' + _SCALAR + rb')*?)"text"\s*:\s*"')
_TYPED = re.compile(rb'"type"\s*:\s*"text"')

START = "path string, block long, inside boolean, depth long, level long, opener_block long, opener_at long, position long, text_from long"


def list_that_counts(whole: Outline, keys: tuple[str, ...], root: Container | None) -> tuple[int, tuple[int, int]] | None:
    """Level and opening of the first present list among ``keys`` (the last one under that key), or of a
    document that is a list itself."""
    if root is not None and root.bracket == "[":
        return 1, root.at
    for key in keys:
        outer, _, inner = key.rpartition(".")
        for (level, name, around), at in whole.lists.items():
            if name == inner and (level, around) == ((3, outer) if outer else (2, "")):
                return level, at
    return None


def starts_of(ranges: pd.DataFrame, keys: tuple[str, ...]) -> Iterator[tuple]:
    """Start rows of the ranges of one file, in order; none if the document is not whole."""
    ranges = ranges.sort_values("block")
    both = [pickle.loads(o) for o in ranges["outlines"]]
    if any(o is None for o in both):
        return
    head, tail = bytes(ranges["head"].iloc[0]), bytes(ranges["tail"].iloc[-1])
    if len(ranges) > 1 and len(tail) < EDGE:
        tail = (bytes(ranges["tail"].iloc[-2]) + tail)[-EDGE:]
    envelope = _ENVELOPE.match(head)
    if envelope and (_TYPED.search(envelope[1]) or _TYPED.search(tail)):
        # what is inside the string is a document of its own
        quotes = len(marks(head[: envelope.end()]).quotes)
        for block, here in zip(ranges["block"], ranges["quotes"], strict=True):
            first = block == ranges["block"].iloc[0]
            yield block, True, 0, 0, 0, 0, 0, envelope.end() if first else 0
            quotes -= here
            if quotes < 0:
                break
        return
    state = Outline(False)
    before, root = [], None
    for o in both:
        before.append(state)
        state = state.then(o[state.inside])
        root = root or (state.open[0] if state.open else None)
    # the reader takes the last brace off, or there was none: then one was added that closes nothing
    size = ranges["size"].iloc[0]
    added = 0 if size is None or pd.isna(size) else int(ranges["bytes"].sum()) - int(size)
    # with a byte order mark or bytes that are no UTF-8, sizes differ and both are possible
    if state.inside or state.opened or state.closed not in ((added,) if added in (0, 1) else (0, 1)):
        return
    first = re.match(rb"(?:\xef\xbb\xbf)?\s*([\[{])", head)
    last = (tail[:-1] if state.closed else tail).rstrip()
    if first is None or not last.endswith((b"}", b"]")):
        return  # text around the document
    if root is None:  # opened and closed in one range
        root = Container(first[1].decode(), None, 0, (int(ranges["block"].iloc[0]), first.end() - 1))
    chosen = list_that_counts(state, keys, root)
    if chosen is None:
        return
    level, at = chosen
    for block, start in zip(ranges["block"], before, strict=True):
        listed = len(start.open) >= level and start.opened >= level and start.open[level - 1].at == at
        position = start.open[level - 1].commas if listed else -1
        yield block, start.inside, start.opened, level, at[0], at[1], position, -1


def starts(ranges: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    names = [f.split()[0] for f in START.split(", ")]

    def run(group: pd.DataFrame) -> pd.DataFrame:
        path = group["path"].iloc[0]
        return pd.DataFrame([(path, *row) for row in starts_of(group, keys)], columns=names)

    # the rows of a file: its bytes divided by the size of a range
    return ranges.groupBy("path").applyInPandas(run, START)


# ---- second pass ------------------------------------------------------------------------------------------


def with_start(rows: DataFrame, begun: DataFrame, count: int) -> DataFrame:
    """``rows`` with the start of their range, in the order of the file within a range."""
    if count <= BROADCAST_RANGES:
        return rows.join(F.broadcast(begun), ["path", "block"])
    joined = rows.withColumn("_at", F.monotonically_increasing_id()).join(begun, ["path", "block"])
    return joined.sortWithinPartitions("path", "block", "_at").drop("_at")


def elements(rows: DataFrame) -> DataFrame:
    """The elements of the list that counts: ``path, position, block, whole, text``. The first element of
    a range that begins inside the list, and the last of one that ends inside, are pieces."""
    names = ["path", "position", "block", "whole", "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        held: list[bytes] = []

        def packed(found: list[tuple]) -> pa.RecordBatch:
            types = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types, strict=True)], names)

        def leave() -> Iterator[pa.RecordBatch]:
            if current is not None and active:
                yield packed([(*current[:1], position, current[1], False, b"".join(held).decode("utf-8", "replace"))])

        for where, part, text in by_range(batches):
            if where != current:
                yield from leave()
                current = where
                cell = {n: part.column(n)[0].as_py() for n in ("inside", "depth", "level", "opener_block", "opener_at", "position")}
                inside, depth, level, position = cell["inside"], cell["depth"], cell["level"], cell["position"]
                opener = cell["opener_at"] if cell["opener_block"] == where[1] else -1
                active = piece = position >= 0
                passed, held = 0, []
            found = marks(text)
            spots = found.outside(inside)
            kinds = _MARK[found.data[spots]]
            level_at = depth + np.cumsum(np.where(kinds == 2, 0, kinds))
            begin = 0
            if not active and passed <= opener < passed + len(text):
                active, piece, position, begin = True, False, 0, opener - passed + 1
            if active:
                there = np.flatnonzero(spots >= begin)
                after = there[level_at[there] < level]
                stop = int(spots[after[0]]) if len(after) else len(text)
                cuts = spots[there][(kinds[there] == 2) & (level_at[there] == level) & (spots[there] < stop)]
                ends = [*cuts.tolist(), stop] if len(after) else cuts.tolist()
                out = []
                for end in ends:
                    held.append(text[begin:end])
                    out.append((where[0], position, where[1], not piece, b"".join(held).decode("utf-8", "replace")))
                    held, piece, begin = [], False, end + 1
                    position += 1
                if len(after):
                    active = False
                else:
                    held.append(text[begin:])
                if out:
                    yield packed(out)
            if len(level_at):
                depth = int(level_at[-1])
            inside = bool((len(found.quotes) + inside) % 2)
            passed += len(text)
        yield from leave()

    return rows.mapInArrow(run, "path string, position long, block long, whole boolean, text string")


def unescaped(rows: DataFrame) -> DataFrame:
    """The inner document of envelopes: ``path, block, value, size`` with the same ranges. A piece that is
    no valid string content is NULL, which makes its document unreadable."""
    names = ["path", "block", "value", "size"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, open_, skip = None, False, 0
        for where, part, text in by_range(batches):
            if where != current:
                current, open_, skip = where, True, part.column("text_from")[0].as_py()
            if not open_:
                continue
            if skip >= len(text):
                skip -= len(text)
                continue
            text, skip = text[skip:], 0
            quotes = marks(text).quotes
            if len(quotes):
                text, open_ = text[: int(quotes[0])], False
            try:
                value = json.loads(b'"' + text + b'"', strict=False)
                value = value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
            except ValueError:
                value = None
            yield pa.RecordBatch.from_arrays(
                [pa.array([where[0]]), pa.array([where[1]]), pa.array([value], pa.string()), pa.array([None], pa.int64())], names
            )

    return rows.mapInArrow(run, "path string, block long, value string, size long")


def listed(rows: DataFrame, keys: tuple[str, ...], nested: bool = False) -> DataFrame:
    """``path, position, text`` of every element of the item lists of ``rows`` (path, block, value, size)."""
    begun = written(starts(outlines(rows, keys), keys))
    plain, inner = begun.agg(F.count_if(F.col("text_from") < 0), F.count_if(F.col("text_from") >= 0)).first()
    found = elements(with_start(rows, begun.where("text_from < 0"), plain))
    cut = found.where("NOT whole").groupBy("path", "position").agg(F.sort_array(F.collect_list(F.struct("block", "text"))).alias("_p"))
    cut = cut.select("path", "position", F.array_join(F.col("_p.text"), "").alias("text"))
    out = found.where("whole").select("path", "position", "text").unionAll(cut)
    # an empty list is one element without text
    out = out.where(F.length(F.regexp_replace("text", r"^\s+", "")) > 0)
    if inner and not nested:
        out = out.unionAll(listed(unescaped(with_start(rows, begun.where("text_from >= 0"), inner)), keys, True))
    return out


def large_rows(spark: SparkSession, path: str, large: int) -> DataFrame:
    """Records of the files above ``large`` bytes; Spark splits the files, in any file system it reads."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.where(F.col("_metadata.file_size") > large).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.concat("value", F.lit("}")).alias("value"),
        F.col("_metadata.file_size").alias("size"),
    )

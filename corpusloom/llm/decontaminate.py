"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

A document leaks an item when some stretch of its words is within edit distance k = floor(L / 5) of the
item's L words (insertions, deletions, replacements of words; letter case and punctuation ignored).

The CGK embedding reads a word sequence with a pointer that moves on, at each of about 2 L output steps,
by a random bit of (step, word); it turns edit distance into Hamming distance. Each hash table uses its
own embedding and compares a few sampled output positions; for each item length the number of tables is
raised until simulated items with k random edits are found with the target recall. Windows of the items'
lengths are looked up, and every (window, item) match is verified by an alignment of the item against the
surrounding words. For lengths that would need more than MOST_TABLES, every (window, item) that passes the
count filter is verified.

Before a window is embedded it must pass a lossless count filter: an item within k edits shares at least
L - q + 1 - (q + 1) k of its word q-grams with an item-sized window. The items are taken in blocks of a
fixed size, so the index that tasks hold is bounded however large the benchmark is.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..settings import written
from . import words as W

#: Items with fewer words than this have no edits and are matched exactly; long ones are cut into pieces of
#: LONGEST words at most, and a leak of a piece is a leak of its item.
SHORTEST = 5
LONGEST = 256
BLOCK = 20_000
SAMPLES = 3
MOST_TABLES = 64
RECALL = 0.98
#: From the first length of so many words that needs too many tables, longer ones are not tried.
FAR = 64

_GAPS = np.ones(256, bool)
_GAPS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_PAD = np.uint64(0x1234567890ABCDEF)


def sequences(texts: pa.Array) -> list[np.ndarray]:
    """Word hashes of each text."""
    data, at = W.buffers(pc.utf8_lower(texts.cast(pa.large_string())))
    starts, _, h = W.spans(data, at, gaps=_GAPS)
    first = np.searchsorted(starts, at)
    return [h[first[k] : first[k + 1]] for k in range(len(at) - 1)]


def _grams(h: np.ndarray, q: int) -> np.ndarray:
    return W.windows(h, q) + np.uint64(q)


def allowed(length: int) -> int:
    return length // 5


def need(length: int, q: int) -> int:
    """q-grams that an item-sized window shares at least."""
    return length - q + 1 - (q + 1) * allowed(length)


def gram_size(length: int) -> int:
    return 3 if need(length, 3) >= 2 else 2


def embedded(windows: np.ndarray, seed: int, wanted: np.ndarray) -> np.ndarray:
    """Key of each row of word hashes: its CGK output at the ``wanted`` steps, put together."""
    n, length = windows.shape
    at = np.zeros(n, np.int64)
    rows = np.arange(n)
    wanted_set = set(wanted.tolist())
    key = np.zeros(n, np.uint64)
    wide = np.concatenate([windows, np.full((n, 1), _PAD)], axis=1)
    for step in range(int(wanted.max()) + 1):
        out = wide[rows, at]
        if step in wanted_set:
            key = W.mix(key * np.uint64(0x9E3779B97F4A7C15) + out)
        salt = np.uint64(((seed * 1_000_003 + step) * 2 + 1) * 0xD1342543DE82EF95 & W.MASK)
        bit = ((out ^ salt) * np.uint64(0xBF58476D1CE4E5B9) * salt) >> np.uint64(63)
        at = np.minimum(at + bit.astype(np.int64), length)
    return key


def sampled(length: int, table: int) -> np.ndarray:
    """Output steps that a table compares: random ones among those that most pointers reach."""
    rng = np.random.default_rng([length, table])
    return np.sort(rng.choice(max(SAMPLES, int(1.6 * length)), SAMPLES, replace=False))


def _edited(item: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    words = item.tolist()
    for _ in range(k):
        at, kind = int(rng.integers(len(words))), int(rng.integers(3))
        new = int(rng.integers(1 << 62))
        if kind == 0:
            words[at] = new
        elif kind == 1:
            words.insert(at, new)
        elif len(words) > 1:
            del words[at]
    words = (words + [int(_PAD)] * len(item))[: len(item)]
    return np.array(words, np.uint64)


def tables_for(items: list[np.ndarray], trials: int = 200) -> int:
    """Tables needed for the target recall on simulated copies, with the most edits, of items of one
    length; 0 when MOST_TABLES are not enough."""
    length = len(items[0])
    rng = np.random.default_rng([9, length])
    pairs = [items[int(rng.integers(len(items)))] for _ in range(trials)]
    edits = [_edited(p, allowed(length), rng) for p in pairs]
    both = np.stack([*pairs, *edits])
    found = np.zeros(trials, bool)
    for table in range(MOST_TABLES):
        left = np.flatnonzero(~found)
        a, b = np.split(embedded(both[np.concatenate([left, left + trials])], table, sampled(length, table)), 2)
        found[left] = a == b
        if found.mean() >= RECALL:
            return table + 1
    return 0


@dataclass
class Index:
    """LSH tables and q-gram lists of one block of items."""

    names: list
    items: list[np.ndarray]
    tables: dict[int, int]  # by item length; 0: verified without tables
    lookup: dict = field(default_factory=dict)  # (length, table) -> sorted keys, item numbers
    grams: dict = field(default_factory=dict)  # q -> bitmap, sorted grams, offsets, item numbers
    short: dict = field(default_factory=dict)  # length below SHORTEST -> sorted hashes, item numbers

    @classmethod
    def of(cls, names: list, items: list[np.ndarray]) -> Index:
        index = cls(names, items, {})
        by_length = defaultdict(list)
        for i, item in enumerate(items):
            by_length[len(item)].append(i)
        far = False
        for length, members in sorted(by_length.items()):
            rows = np.stack([items[i] for i in members])
            if length < SHORTEST:
                hashes = W.windows(rows.reshape(-1), length)[::length]
                order = np.argsort(hashes, kind="stable")
                index.short[length] = hashes[order], np.array(members)[order]
                continue
            # recall falls with length, and what goes without tables is complete
            index.tables[length] = 0 if far else tables_for(list(rows))
            far = far or length >= FAR and not index.tables[length]
            for table in range(index.tables[length]):
                keys = embedded(rows, table, sampled(length, table))
                order = np.argsort(keys, kind="stable")
                index.lookup[length, table] = keys[order], np.array(members)[order]
        for q in (2, 3):
            own = [(np.unique(_grams(x, q)), i) for i, x in enumerate(items) if len(x) >= SHORTEST and gram_size(len(x)) == q]
            if own:
                gram = np.concatenate([g for g, _ in own])
                item = np.concatenate([np.full(len(g), i) for g, i in own])
                order = np.lexsort((item, gram))
                gram, item = gram[order], item[order]
                values, first = np.unique(gram, return_index=True)
                bits = 1 << max(16, int(len(values)).bit_length() + 4)
                bitmap = np.zeros(bits, bool)
                bitmap[(values & np.uint64(bits - 1)).astype(np.int64)] = True
                index.grams[q] = bitmap, values, np.append(first, len(gram)), item
        return index

    def search(self, h: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, start word, end word, distance) of every leak in rows of words."""
        lengths = np.array([len(x) for x in self.items])
        row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        windows = defaultdict(list)
        candidates = set()
        direct = np.array([not self.tables.get(n) for n in lengths.tolist()])
        for q, (bitmap, values, offsets, item) in self.grams.items():
            if len(h) < q:
                continue
            grams = _grams(h, q)
            hit = np.flatnonzero(bitmap[(grams & np.uint64(len(bitmap) - 1)).astype(np.int64)])
            hit = hit[row_of[hit] == row_of[hit + q - 1]]
            at = np.minimum(np.searchsorted(values, grams[hit]), len(values) - 1)
            good = values[at] == grams[hit]
            hit, at = hit[good], at[good]
            count = offsets[at + 1] - offsets[at]
            pos = np.repeat(hit, count)
            which = item[np.repeat(offsets[at] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())]
            order = np.lexsort((pos, which))
            pos, which = pos[order], which[order]
            size = lengths[which]
            # how many of the item's grams start within one window from here on, in this row
            wide = np.int64(len(h) + LONGEST + 1)
            place = which * wide + pos
            end = np.minimum(pos + size - q, first[row_of[pos] + 1] - 1) if len(pos) else pos
            many = np.searchsorted(place, which * wide + end, "right") - np.arange(len(pos))
            enough = many >= np.maximum([need(n, q) for n in size], 1) if len(pos) else np.zeros(0, bool)
            pos, which, size = pos[enough], which[enough], size[enough]
            # the alignment's surroundings hold every window that this gram is the first of
            plain = direct[which]
            candidates.update(zip(row_of[pos[plain]].tolist(), which[plain].tolist(), pos[plain].tolist(), strict=True))
            pos, size = pos[~plain], size[~plain]
            for p, n in set(zip(pos.tolist(), size.tolist(), strict=True)):
                windows[n].append(p)
        for n, starts in windows.items():
            q = gram_size(n)
            spread = np.unique((np.array(starts)[:, None] - np.arange(n - q + 1)[None, :]).reshape(-1))
            spread = spread[spread >= 0]
            # a window begins in the row of the shared gram that it was built for
            starts = np.array(sorted(starts))
            after = starts[np.minimum(np.searchsorted(starts, spread), len(starts) - 1)]
            spread = spread[row_of[spread] == row_of[after]]
            cells = spread[:, None] + np.arange(n)[None, :]
            inside = cells < first[row_of[spread] + 1][:, None]
            rows = np.where(inside, h[np.minimum(cells, len(h) - 1)], _PAD)
            for table in range(self.tables[n]):
                keys, members = self.lookup[n, table]
                mine = embedded(rows, table, sampled(n, table))
                low, high = np.searchsorted(keys, mine), np.searchsorted(keys, mine, "right")
                for w in np.flatnonzero(high > low):
                    for m in members[low[w] : high[w]]:
                        candidates.add((int(row_of[spread[w]]), int(m), int(spread[w])))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, (hashes, members) in self.short.items():
            mine = W.windows(h, n)
            low, high = np.searchsorted(hashes, mine), np.searchsorted(hashes, mine, "right")
            for p in np.flatnonzero(high > low).tolist():
                row = int(row_of[p])
                if row == row_of[p + n - 1]:
                    start = p - int(first[row])
                    for m in members[low[p] : high[p]].tolist():
                        best.setdefault((row, m), (start, start + n, 0))
        done: dict[tuple[int, int], int] = {}
        for row, m, start in sorted(candidates):
            n = len(self.items[m])
            k = allowed(n)
            if done.get((row, m), -1) > start:
                continue  # the stretch verified last covers this window's whole neighbourhood
            low, high = max(int(first[row]), start - n), min(int(first[row + 1]), start + 2 * n + k)
            done[row, m] = start + n - k
            distance, a, b = aligned(self.items[m], h[low:high])
            if distance <= k and (row, m) not in best:
                best[row, m] = (low - int(first[row]) + a, low - int(first[row]) + b, distance)
            elif distance <= k and distance < best[row, m][2]:
                best[row, m] = (low - int(first[row]) + a, low - int(first[row]) + b, distance)
        return [(row, m, a, b, d) for (row, m), (a, b, d) in sorted(best.items())]


def aligned(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least edit distance of ``item`` to any stretch of ``text``, with that stretch's start and end."""
    n = len(text)
    cost = np.zeros(n + 1, np.int64)
    origin = np.arange(n + 1)
    for i, word in enumerate(item):
        step = cost[:-1] + (text != word)
        new, source = cost + 1, origin.copy()  # the item's word has no partner
        better = step < new[1:]
        new[1:] = np.where(better, step, new[1:])
        source[1:] = np.where(better, origin[:-1], source[1:])
        # words of the text without partner: running minimum of cost minus position
        shifted = new - np.arange(n + 1)
        run = np.minimum.accumulate(shifted)
        last = np.maximum.accumulate(np.where(shifted == run, np.arange(n + 1), 0))
        cost = run + np.arange(n + 1)
        origin = source[last]
    end = int(np.argmin(cost))
    return int(cost[end]), int(origin[end]), end


def _blocks(benchmark: DataFrame):
    """Blocks of at most about BLOCK items: names, and word sequences of their pieces."""
    items = written(
        benchmark.where("text is not null").select("item_id", "text").withColumn("h", F.xxhash64("item_id", "text"))
    )
    count = items.count()
    parts = -(-count // BLOCK)
    for part in range(parts):
        rows = items.where(F.pmod("h", F.lit(parts)) == part).orderBy("item_id", "h").collect()
        names, sequences_ = [], []
        for row, words in zip(rows, sequences(pa.array([r.text for r in rows], pa.large_string())), strict=True):
            pieces = max(1, -(-len(words) // LONGEST))
            for piece in np.array_split(words, pieces):
                if len(piece):
                    names.append(row.item_id)
                    sequences_.append(piece)
        if names:
            yield names, sequences_


def _found(index: Index, texts: pa.Array):
    """Leaks in each text, block by block of rows."""
    data, at = W.buffers(pc.utf8_lower(texts.cast(pa.large_string())))
    for low, high in W.blocks(at):
        base = at[low]
        edges = at[low : high + 1] - base
        starts, _, h = W.spans(data[base : at[high]], edges, gaps=_GAPS)
        for row, m, a, b, d in index.search(h, np.searchsorted(starts, edges)):
            yield low + row, m, a, b, d


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Every (document, item) with a leak: doc_id, item_id, first and end word of the closest stretch,
    distance. Words are counted as this operator splits them. NULL and empty texts and items match
    nothing; an item that leaks by several pieces gives a row for each.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    item_type = benchmark.schema["item_id"].dataType
    schema = f"doc_id {id_type}, item_id {item_type.simpleString()}, first_word long, end_word long, distance int"
    out = None
    for names, items in _blocks(benchmark.where("item_id is not null")):
        shared = docs.sparkSession.sparkContext.broadcast(Index.of(names, items))

        def look(batches, shared=shared):
            for batch in batches:
                rows = list(_found(shared.value, batch.column(1)))
                if rows:
                    row, m, a, b, d = (list(x) for x in zip(*rows, strict=True))
                    yield pa.record_batch(
                        [batch.column(0).take(pa.array(row)), pa.array([shared.value.names[i] for i in m]), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(d, pa.int32())],
                        names=["doc_id", "item_id", "first_word", "end_word", "distance"],
                    )

        part = docs.select("doc_id", "text").mapInArrow(look, schema)
        out = part if out is None else out.unionAll(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no item leaks, with their columns unchanged. Items need no id here."""
    at_text = docs.columns.index("text")
    for names, items in _blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(Index.of(names, items))

        def keep(batches, shared=shared):
            for batch in batches:
                stay = np.ones(batch.num_rows, bool)
                for row, *_ in _found(shared.value, batch.column(at_text)):
                    stay[row] = False
                yield batch.filter(pa.array(stay))

        docs = docs.mapInArrow(keep, docs.schema)
    return docs

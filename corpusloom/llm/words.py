"""Vectorised word hashing over Arrow string columns, for use inside tasks.

Texts stay UTF-8 bytes. Work goes segment by segment (about a megabyte, cut at white space), so memory
is bounded by the segment and eight bytes per word, however long a text is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
KEPT = np.arange(256, dtype=np.uint64) + np.uint64(1)
LOWER = KEPT.copy()
LOWER[65:91] = KEPT[97:123]

_powers: dict[str, np.ndarray] = {}


def _geometric(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        step = np.uint64(pow(base, done, 1 << 64))
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
    return out


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64, for i < n."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SEGMENT + 4096)
        _powers["up"] = _geometric(BASE, size)
        _powers["down"] = _geometric(pow(BASE, -1, 1 << 64), size)
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (the splitmix rounds)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and its row offsets; NULL counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary() if pa.types.is_binary(texts.type) else pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def blocks(at: np.ndarray, limit: int = SEGMENT) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; a longer row is a range of its own."""
    low = 0
    n = len(at) - 1
    while low < n:
        high = int(np.searchsorted(at, at[low] + limit, "right")) - 1
        high = min(n, max(low + 1, high))
        yield low, high
        low = high


def _segments(data: np.ndarray, at: np.ndarray, gaps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SEGMENT bytes that cut no word of any row."""
    low, n = 0, len(data)
    while low < n:
        high = min(n, low + SEGMENT)
        if high < n:
            row = int(np.searchsorted(at, high, "right")) - 1
            edge = int(at[row])
            if edge > low:
                high = edge
            else:
                end = int(at[row + 1])
                back = np.flatnonzero(gaps[data[low:high]])
                if len(back):
                    high = low + int(back[-1]) + 1
                else:  # one word longer than a segment
                    while high < end:
                        more = np.flatnonzero(gaps[data[high : min(end, high + SEGMENT)]])
                        if len(more):
                            high += int(more[0]) + 1
                            break
                        high = min(end, high + SEGMENT)
        yield low, high
        low = high


def spans(
    data: np.ndarray,
    at: np.ndarray,
    lower: bool = True,
    gaps: np.ndarray = SPACE,
    prefixes: tuple[int, ...] = (),
):
    """Start, end and hash of every word of all rows (``data`` cut at ``at``), in order, then one more
    hash array for each length in ``prefixes``: of the word's first so many bytes.

    Words are maximal runs of bytes outside ``gaps`` (space and \\x09-\\x0D), within a row. With
    ``lower`` A-Z count as a-z.
    """
    letters = LOWER if lower else KEPT
    first = np.zeros(len(data) + 1, bool)
    first[at] = True
    starts, ends = [], []
    hashes: list[list[np.ndarray]] = [[] for _ in range(1 + len(prefixes))]
    for low, high in _segments(data, at, gaps):
        part = data[low:high]
        gap = gaps[part]
        cut = first[low : high + 1].copy()
        cut[0] = cut[-1] = True
        word = ~gap
        before = np.concatenate(([True], gap[:-1]))
        after = np.concatenate((gap[1:], [True]))
        s = np.flatnonzero(word & (before | cut[:-1]))
        e = np.flatnonzero(word & (after | cut[1:])) + 1
        up, down = powers(len(part))
        total = np.empty(len(part) + 1, np.uint64)
        total[0] = 0
        np.cumsum(letters[part] * up[: len(part)], out=total[1:])
        for out, size in zip(hashes, (None, *prefixes), strict=True):
            end = e if size is None else np.minimum(e, s + size)
            out.append(mix((total[end] - total[s]) * down[s] + (end - s).astype(np.uint64)))
        starts.append(s + low)
        ends.append(e + low)
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, *[np.zeros(0, np.uint64) for _ in hashes]
    return np.concatenate(starts), np.concatenate(ends), *[np.concatenate(h) for h in hashes]


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[k : k + n]
    return mix(out)

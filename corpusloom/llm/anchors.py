"""Content-chosen positions of byte strings: equal windows choose equal places, wherever they are."""

from __future__ import annotations

import numpy as np

from . import words as W

#: Bytes of the string whose hash decides.
GRAM = 40
_PLACE = np.uint64((1 << 21) - 1)
#: Bytes hashed at a time; places must fit the bits of _PLACE.
PART = 1 << 20


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Polynomial sums of a part, so that any stretch [a, b) hashes to (t[b] - t[a]) * down[a]."""
    up, down = W.powers(len(data) + 1)
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum(W.KEPT[data] * up[: len(data)], out=total[1:])
    return total, down


def chosen(total: np.ndarray, down: np.ndarray, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places chosen by the windows of ``window`` bytes inside the rows that ``at`` cuts a part into, and
    the hashes of the grams there. A window chooses its gram of least hash, the leftmost if several."""
    n = len(total) - 1
    wide = window - GRAM + 1
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = W.mix((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1])
    key = (grams & ~_PLACE) | np.arange(len(grams), dtype=np.uint64)
    # running minimum of ``wide`` grams: minima from both ends of blocks of that length
    pad = -len(key) % wide
    blocks = np.concatenate((key, np.full(pad, np.uint64(W.MASK)))).reshape(-1, wide)
    onward = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(back[: n - window + 1], onward[wide - 1 : n - window + wide])
    # windows that cross a row's end choose nothing
    whole = np.ones(len(least), bool)
    for edge in at[1:-1]:
        whole[max(0, edge - window + 1) : edge] = False
    mark = np.zeros(len(grams), bool)
    mark[(least[whole] & _PLACE).astype(np.int64)] = True
    places = np.flatnonzero(mark)
    return places, grams[places]

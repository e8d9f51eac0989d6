"""Suffix arrays by linear grouping.

Suffixes are first put into groups of equal Lyndon prefix, without any recursive renaming: groups start
as the suffixes of equal first symbol and are processed in descending order. Each suffix of a group
points to its previous smaller one (the nearest suffix to the left in a lower group); what a group's
suffixes point to moves to a new, next higher group, those pointed to more often further up. With the
groups in Lyndon order, one ascending sweep over the array emits the order inside every group by following
the same pointers. Nothing is sorted by comparison: suffixes start in buckets by symbol, and a group's members
are taken in any order, as a walk to the left gives all members it meets the same pointer.
"""

from __future__ import annotations

from collections.abc import Sequence


#: Pointer of a suffix whose group has not been processed.
OPEN = -2


def _often_first(pointed: dict[int, int], most: int) -> list[list[int]]:
    """What is pointed to, by how often, most often first; no more than ``most`` pointers in all."""
    by: dict[int, list[int]] = {}
    for p, times in pointed.items():
        by.setdefault(times, []).append(p)
    if len(by) < 2:
        return list(by.values())
    return [by[times] for times in range(min(most, max(by)), 0, -1) if times in by]


def grouped(s: Sequence[int]) -> tuple[list[int], list[int]]:
    """Start of the Lyndon group of every suffix, and its previous-smaller pointer (-1: none). Symbols are
    numbers from 0, not far above the length of ``s``."""
    n = len(s)
    buckets: list[list[int]] = [[] for _ in range(max(s, default=-1) + 1)]
    for i, symbol in enumerate(s):
        buckets[symbol].append(i)
    order: list[int] = []
    place = [0] * n
    group = [0] * n
    size = [0] * n
    for bucket in buckets:
        if bucket:
            start = len(order)
            size[start] = len(bucket)
            for k, i in enumerate(bucket, start):
                place[i] = k
                group[i] = start
            order.extend(bucket)
    previous = [OPEN] * n
    end = n
    while end:
        start = group[order[end - 1]]
        pointed: dict[int, int] = {}
        for i in order[start:end]:
            if previous[i] != OPEN:
                continue
            met = [i]
            p = i - 1
            while p >= 0 and group[p] >= start:
                q = previous[p]
                if q == OPEN:  # of this group, and not reached yet
                    met.append(p)
                    q = p - 1
                p = q
            for m in met:
                previous[m] = p
            if p >= 0:
                pointed[p] = pointed.get(p, 0) + len(met)
        if len(pointed) == 1:
            rounds = [list(pointed)]
        else:
            rounds = _often_first(pointed, end - start)
        for targets in rounds:
            moved: dict[int, int] = {}
            for p in targets:
                g = group[p]
                last = g + size[g] - 1
                q = order[last]
                at = place[p]
                order[at], order[last] = q, p
                place[q], place[p] = at, last
                size[g] -= 1
                moved[g] = moved.get(g, 0) + 1
            for p in targets:
                g = group[p]
                group[p] = g + size[g]
            for g, k in moved.items():
                size[g + size[g]] = k
        end = start
    return group, previous


def suffix_array(s: Sequence[int]) -> list[int]:
    """Suffixes of ``s`` in ascending order. The last symbol must be smaller than all others."""
    n = len(s)
    if n == 0:
        return []
    group, previous = grouped(s)
    out = [-1] * n
    free = list(range(n))
    placed = [False] * n
    out[0] = n - 1
    placed[n - 1] = True
    free[0] = 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            placed[j] = True
            j = previous[j]
    return out


def common_prefixes(s: Sequence[int], array: list[int]) -> list[int]:
    """Length of the common prefix of each suffix with the one before it in ``array``."""
    n = len(s)
    rank = [0] * n
    for k, i in enumerate(array):
        rank[i] = k
    out = [0] * n
    h = 0
    for i in range(n):
        if rank[i]:
            j = array[rank[i] - 1]
            limit = n - max(i, j)
            while h < limit and s[i + h] == s[j + h]:
                h += 1
            out[rank[i]] = h
            if h:
                h -= 1
        else:
            h = 0
    return out

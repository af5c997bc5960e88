"""Suffix sorting by linear grouping: Lyndon-prefix groups in descending order, then each group's order emitted, without renaming.

First phase: suffixes start out grouped by their first character. Groups are taken from the highest down. Each member looks back for
the previous smaller suffix: the nearest one before it in a lower group, found by following the pointers of those passed over. Suffixes pointed
at by members of the group are extended by it: those with more pointers first, they leave their group for a new one right above
it. At the end suffixes share a group if and only if they share their longest Lyndon prefix, and groups are in order. Second phase: the order
is emitted from the smallest suffix up; every suffix emitted settles the place, in its group, of the one before it and of those along that
one's pointers. Both phases take linear time.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np


def _first_groups(text: Sequence[int]) -> tuple[list[int], list[int], list[int], list[int]]:
    """Positions by character, where each stands, the first place of its group, and the end of each group by first place."""
    values = np.append(np.asarray(text, np.int64), -1)  # the empty suffix is lowest
    order = np.argsort(values, kind="stable")
    opens = np.flatnonzero(np.diff(values[order], prepend=-2))
    sizes = np.diff(np.append(opens, len(order)))
    place, group, end = np.empty_like(order), np.empty_like(order), np.zeros(len(order) + 1, np.int64)
    place[order] = np.arange(len(order))
    group[order] = np.repeat(opens, sizes)
    end[opens] = opens + sizes
    return order.tolist(), place.tolist(), group.tolist(), end.tolist()


def suffix_array(text: Sequence[int]) -> list[int]:
    """Starts of the suffixes of a sequence of non-negative integers, in ascending order."""
    order, place, group, end = _first_groups(text)
    n = len(order)
    smaller = [-1] * n  # the previous smaller suffix of each
    high = n
    while high:
        low = group[order[high - 1]]
        pointers: dict[int, int] = {}
        for i in sorted(order[low:high]) if high - low > 1 else (order[low],):
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                pointers[j] = pointers.get(j, 0) + 1
        high = low
        if not pointers:
            continue
        if len(pointers) == 1:
            ranks = (pointers,)
        else:
            by_count: dict[int, list[int]] = {}
            for j, count in pointers.items():
                by_count.setdefault(count, []).append(j)
            ranks = [by_count[c] for c in sorted(by_count, reverse=True)]
        for extended in ranks:
            before: dict[int, int] = {}
            for j in extended:
                g = group[j]
                last = end[g]
                if g not in before:
                    before[g] = last
                last -= 1
                other = order[last]
                if other != j:
                    at = place[j]
                    order[at], place[other] = other, at
                    order[last], place[j] = j, last
                end[g] = last
            for j, first in [(j, end[group[j]]) for j in extended]:
                group[j] = first
            for g, last in before.items():
                end[end[g]] = last

    out, free, settled = [-1] * n, list(range(n)), bytearray(n)
    out[0], settled[n - 1] = n - 1, 1
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not settled[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            settled[j] = 1
            j = smaller[j]
    return out[1:]


def repeated_starts(pieces: Sequence[bytes], length: int) -> list[np.ndarray]:
    """For each piece, whether each of its ``length``-byte strings (by start) also starts elsewhere in the pieces.

    The pieces are sorted as one text with a separator below all bytes; equal strings stand next to each other in the order.
    """
    out = [np.zeros(max(0, len(p) - length + 1), bool) for p in pieces]
    if not any(len(o) for o in out):
        return out
    buffer = b"".join(p + b"\0" for p in pieces)
    text = np.frombuffer(buffer, np.uint8).astype(np.int64) + 1
    begins = np.cumsum([0] + [len(p) + 1 for p in pieces])[:-1]
    text[begins[1:] - 1] = 0
    text[-1] = 0
    whole = np.zeros(len(text), bool)
    for b, o in zip(begins, out, strict=True):
        whole[b : b + len(o)] = True
    order = np.asarray(suffix_array(text))
    order = order[whole[order]]
    views = np.lib.stride_tricks.sliding_window_view(np.frombuffer(buffer, np.uint8), length)
    same = np.empty(max(0, len(order) - 1), bool)
    for at in range(0, len(same), 8192):
        a, b = order[at : at + 8192], order[at + 1 : at + 8193]
        same[at : at + 8192] = (views[a[: len(b)]] == views[b]).all(axis=1)
    marked = np.zeros(len(text), bool)
    marked[order[:-1][same]] = True
    marked[order[1:][same]] = True
    return [marked[b : b + len(o)] for b, o in zip(begins, out, strict=True)]

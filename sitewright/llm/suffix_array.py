"""Two-stage suffix sorting in numpy, to a bounded depth.

A position is of type B if its suffix is smaller than the next one, else of type A.  Type B positions are sorted directly; one scan over
the buckets of the first byte, in order, then places every type A position behind its successor.
"""
from __future__ import annotations

import numpy as np

from sitewright.llm.textblocks import mix, powers


class Hashes:
    """Rolling hashes of a buffer: equal strings have equal values, unequal ones differ but for one in 2**64."""

    def __init__(self, data: np.ndarray):
        self.up, self.down = powers(len(data) + 1)
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[:-1], out=self.total[1:])

    def of(self, at: np.ndarray, length) -> np.ndarray:
        return mix((self.total[at + length] - self.total[at]) * self.down[at])

    def common(self, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
        """Length of the common prefix of the strings at a and b, ``depth`` at most."""
        known, step = np.zeros(len(a), np.int64), 1 << (depth - 1).bit_length()
        while step:
            longer = known + step
            ok = np.flatnonzero(longer <= depth)
            same = ok[self.of(a[ok], longer[ok]) == self.of(b[ok], longer[ok])]
            known[same] = longer[same]
            step >>= 1
        return known


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Type B positions; the last one is not."""
    n = len(data)
    step = np.sign(np.diff(data.astype(np.int16), append=-1))
    there = np.where(step != 0, np.arange(n), n)
    return step[np.minimum(np.minimum.accumulate(there[::-1])[::-1], n - 1)] > 0


def sort_directly(words: np.ndarray, hashes: Hashes, at: np.ndarray, depth: int) -> np.ndarray:
    """Positions ``at`` in the order of their next ``depth`` bytes.

    Groups of equal prefix are split by their next eight bytes; what all members of a group share beyond that is skipped, and a group
    whose members are equal to full depth is left as it is."""
    order = at.copy()
    full = hashes.of(order, depth)
    slot = np.arange(len(order))
    group = np.zeros(len(order), np.int64)
    offset = np.zeros(len(order), np.int64)
    while len(slot):
        pos = order[slot]
        key = words[pos + offset]
        by = np.lexsort((key, group))
        key, group, offset = key[by], group[by], offset[by]
        order[slot], full[slot] = pos[by], full[slot][by]
        cut = np.concatenate([[True], (group[1:] != group[:-1]) | (key[1:] != key[:-1])])
        group = np.cumsum(cut) - 1
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(slot)))
        f = full[slot]
        mixed = np.logical_or.reduceat(f != f[start][group], start) & (size > 1)
        go = mixed[group] & (offset + 8 < depth)
        if not go.any():
            break
        lead = order[slot][start][group][go]
        slot, group = slot[go], group[go]
        shared = hashes.common(order[slot], lead, depth)
        begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
        group = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(group))))
        offset = np.minimum.reduceat(shared, begin)[group]
    return order


def sort_positions(data: np.ndarray, wanted: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` positions in the order of their next ``depth`` bytes, and the common prefix (to ``depth``) of each with the one before.

    Every wanted position must have ``depth`` bytes before the end of ``data``."""
    n = len(data)
    text = np.concatenate([data, np.zeros(depth + 8, np.uint8)])
    b = smaller_than_next(text)
    b[n:] = False
    b[n] = True  # the padding is one position that is sorted directly
    inside = np.zeros(n + 1, bool)
    inside[wanted] = True
    # a type A position needs its successors up to the next one that is sorted directly
    next_b = np.minimum.accumulate(np.where(b[:n + 1], np.arange(n + 1), n)[::-1])[::-1]
    ends = np.zeros(n + 2, np.int64)
    np.add.at(ends, wanted, 1)
    np.add.at(ends, next_b[wanted] + 1, -1)
    member = np.cumsum(ends)[:n + 1] > 0
    words = np.zeros(len(text) - 7, np.uint64)
    for k in range(8):
        words |= text[k:len(text) - 7 + k].astype(np.uint64) << np.uint64(56 - 8 * k)
    hashes = Hashes(text)
    direct = sort_directly(words, hashes, np.flatnonzero(member & b[:n + 1]), depth)
    first = text[direct]
    cut = np.searchsorted(first, np.arange(257))
    induced_type = member & ~b[:n + 1]
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    out = []
    for c in range(256):
        scanned = []
        now = np.concatenate(waiting[c]) if waiting[c] else direct[:0]
        while len(now):
            scanned.append(now)
            before = now[now > 0] - 1
            before = before[induced_type[before]]
            now = before[text[before] == c]
        back = direct[cut[c]:cut[c + 1]]
        scanned.append(back)
        here = np.concatenate(scanned)
        if not len(here):
            continue
        out.append(here)
        before = here[here > 0] - 1
        before = before[induced_type[before]]
        before = before[text[before] > c]
        if len(before):
            head = text[before]
            by = np.argsort(head, kind="stable")
            for d, part in zip(*_split(head[by], before[by])):
                waiting[d].append(part)
    order = np.concatenate(out) if out else np.zeros(0, np.int64)
    order = order[inside[order]]
    lcp = np.zeros(len(order), np.int64)
    if len(order) > 1:
        lcp[1:] = hashes.common(order[1:], order[:-1], depth)
    return order, lcp


def _split(keys: np.ndarray, values: np.ndarray):
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[cut].tolist(), np.split(values, cut[1:])

"""Numpy views of many texts at once: byte buffers, words, 64-bit word hashes and word n-grams.

Words are maximal runs of bytes other than the space and 0x09-0x0D.  Texts are joined with a space between them, so a word never
crosses two texts.  All arithmetic is on unsigned 64-bit integers that wrap.
"""
from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa

MULT = 0x9E3779B97F4A7C15
BASE = 0x100000001B3
_POWERS: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of a 64-bit value (a finaliser of the splitmix kind)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse for i < n, grown when needed."""
    if len(_POWERS.get("up", ())) < n:
        size = 1 << max(16, int(n).bit_length())
        inverse = pow(BASE, -1, 1 << 64)
        for name, base in (("up", BASE), ("down", inverse)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def fold_table() -> np.ndarray:
    """Lower-cases A-Z, leaves other bytes."""
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def space_table(letters: bool = False) -> np.ndarray:
    """Bytes between words: white space or, with ``letters``, every ASCII byte that is no letter or digit."""
    t = np.zeros(256, bool)
    t[[9, 10, 11, 12, 13, 32]] = True
    if letters:
        t[:128] = True
        t[48:58] = t[65:91] = t[97:123] = False
    return t


class Block:
    """Some texts as one buffer: ``data`` bytes, word ``starts`` and ``ends``, ``first`` word index of every text (one more at the end)."""

    def __init__(self, texts: list[bytes], fold: bool = True, letters: bool = False):
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        self.offsets = np.concatenate([[0], np.cumsum(sizes)])
        data = np.frombuffer(b" ".join(texts) + b" ", np.uint8) if texts else np.zeros(0, np.uint8)
        self.data = fold_table()[data] if fold else data
        blank = space_table(letters)[self.data]
        edge = np.diff(np.concatenate([[True], blank]).astype(np.int8))
        self.starts = np.flatnonzero(edge == -1)
        self.ends = np.flatnonzero(edge == 1)
        self.first = np.searchsorted(self.starts, self.offsets)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def word_hashes(self) -> np.ndarray:
        up, down = powers(len(self.data) + 1)
        total = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position; the last n - 1 positions are left out."""
    m = max(0, len(words) - n + 1)
    h = np.zeros(m, np.uint64)
    for k in range(n):
        h = (h ^ words[k:k + m]) * np.uint64(MULT)
        h ^= h >> np.uint64(29)
    return mix(h)


def blocks(batches, size: int = 1 << 20):
    """Regroup the (ids, texts) of Arrow record batches to about ``size`` bytes of text; a null text is empty.

    The first column is the id, the second the text; yields (list of ids, list of bytes)."""
    ids, texts, held = [], [], 0
    for b in batches:
        for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            t = (t or "").encode() if not isinstance(t, bytes) else t
            ids.append(i)
            texts.append(t)
            held += len(t)
            if held >= size:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


def releasing(run):
    """The task function ``run``, which at its end gives memory it holds no longer back to the system: a worker lives on and takes other
    tasks, next to the executor's own memory."""
    @functools.wraps(run)
    def task(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return task

"""License texts found in documents: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies them.

Words are runs of letters and digits, A-Z lower-cased.  A template of S shingles is looked for in windows of about S shingles, placed
every eighth of that.  A copy that keeps 80 % of the shingles within the template's length has a Jaccard similarity of more than 0.5
to one of the windows, so BANDS bands of ROWS values miss it with a probability under (1 - 0.5**ROWS)**BANDS = 0.001.  Windows without
any template shingle have similarity 0 and get no signature.
"""
from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sitewright.llm.textblocks import Block, MULT, blocks, mix, ngram_hashes

SHINGLE = 5
ROWS, BANDS = 2, 24
#: The templates are sent to every task; more text than this is refused.
MAX_TEMPLATE_BYTES = 16 << 20
TABLE_BITS = 22
#: Shingle hashes that are signed at a time.
MAX_VALUES = 1 << 20


def window_size(s: int) -> int:
    """Window for templates of s shingles: exact up to 8, then the next of eight sizes per doubling."""
    if s <= 8:
        return s
    step = 1 << (s.bit_length() - 4)
    return -(-s // step) * step


def signatures(windows: np.ndarray) -> np.ndarray:
    """Band keys of every row of shingle hashes."""
    mins = np.stack([mix(windows ^ np.uint64((k + 1) * MULT & (1 << 64) - 1)).min(1) for k in range(ROWS * BANDS)], 1)
    keys = np.zeros((len(windows), BANDS), np.uint64)
    for r in range(ROWS):
        keys = mix(keys * np.uint64(MULT) + mins[:, r::ROWS])
    return mix(keys + np.arange(BANDS, dtype=np.uint64))


@dataclass
class Group:
    """Templates with one shingle length and one window size."""

    n: int
    window: int
    names: list[str]
    shingles: list[np.ndarray]
    keys: np.ndarray  # sorted band keys
    owner: np.ndarray  # template index of each key
    known: np.ndarray  # all shingles, sorted

    @cached_property
    def marked(self) -> np.ndarray:
        """Bit table of all shingles, made where it is used: it is far larger than what it is made of."""
        table = np.zeros(1 << TABLE_BITS, bool)
        table[self.known >> np.uint64(64 - TABLE_BITS)] = True
        return table


def index(templates: list[tuple[str, str]]) -> list[Group]:
    """Groups of the templates that have a word; texts of fewer than SHINGLE words are one shingle."""
    if sum(len(t.encode()) for _, t in templates) > MAX_TEMPLATE_BYTES:
        raise ValueError("too much template text to send to every task")
    by: dict[tuple[int, int], list] = {}
    for name, text in templates:
        words = Block([text.encode()], letters=True).word_hashes()
        n = min(SHINGLE, len(words))
        if n:
            s = np.unique(ngram_hashes(words, n))
            by.setdefault((n, window_size(len(s))), []).append((name, s))
    out = []
    for (n, window), rows in sorted(by.items()):
        keys = np.concatenate([signatures(s[None, :])[0] for _, s in rows])
        owner = np.repeat(np.arange(len(rows)), BANDS)
        order = np.argsort(keys, kind="stable")
        out.append(Group(n, window, [x for x, _ in rows], [s for _, s in rows], keys[order], owner[order], np.unique(np.concatenate([s for _, s in rows]))))
    return out


def window_starts(first: np.ndarray, count: np.ndarray, size: int, stride: int, near: np.ndarray) -> np.ndarray:
    """Starts of the windows that hold one of the shingle positions ``near``; windows are placed from each text's start and at its end."""
    text = np.searchsorted(first, near, side="right") - 1
    base, last = first[text], np.maximum(count[text] - size, 0)
    k = (near - base) // stride
    out = []
    for back in range(-(-size // stride) + 1):
        start = np.minimum(np.maximum(k - back, 0) * stride, last)
        out.append(base + start)
    out.append(base + last)
    s = np.concatenate(out)
    n = np.tile(near, len(out))
    return np.unique(s[(s <= n) & (n < s + size)])


def matches(texts: list[bytes], groups: list[Group], threshold: float, retrieve: bool = True) -> list[tuple[int, str, int, int, float]]:
    """(text index, template, first word, last word, containment) of every place; ``retrieve=False`` verifies all windows instead."""
    b = Block(texts, letters=True)
    words, counts = b.word_hashes(), b.counts()
    found = []
    grams: dict[int, np.ndarray] = {}
    for g in groups:
        if g.n not in grams:
            grams[g.n] = ngram_hashes(words, g.n)
        h = grams[g.n]
        some = np.flatnonzero(counts >= g.n)
        first, count = b.first[:-1][some], counts[some] - g.n + 1
        if not len(some):
            continue
        near = np.flatnonzero(g.marked[h >> np.uint64(64 - TABLE_BITS)])
        at = np.searchsorted(first, near, side="right") - 1
        near, at = (x[np.isin(h[near], g.known)] for x in (near, at))
        near = near[(at >= 0) & (near < (first + count)[np.maximum(at, 0)])]
        if not len(near):
            continue
        stride = max(1, g.window // 8)
        starts = window_starts(first, count, g.window, stride, near)
        text = np.searchsorted(first, starts, side="right") - 1
        end = (first + count)[text]
        hits = []
        some_rows = max(1, MAX_VALUES // g.window)
        for lo in range(0, len(starts), some_rows):
            s, e = starts[lo:lo + some_rows], end[lo:lo + some_rows]
            if retrieve:
                rows = h[np.minimum(s[:, None] + np.arange(g.window), e[:, None] - 1)]
                keys = signatures(rows)
                left, right = np.searchsorted(g.keys, keys, "left"), np.searchsorted(g.keys, keys, "right")
                w, band = np.nonzero(right > left)
                pairs = {(int(s[i]), int(g.owner[j])) for i, c in zip(w, band) for j in range(left[i, c], right[i, c])}
            else:
                pairs = {(int(x), j) for x in s for j in range(len(g.names))}
            hits += sorted(pairs)
        place: dict[tuple[int, int], list] = {}
        for s, j in hits:
            t = int(np.searchsorted(first, s, side="right") - 1)
            lo, hi = max(s - stride, int(first[t])), min(s + g.window + stride, int(first[t] + count[t]))
            known = np.isin(h[lo:hi], g.shingles[j])
            c = len(np.unique(h[lo:hi][known])) / len(g.shingles[j])
            if c >= threshold:
                inside = np.flatnonzero(known)
                place.setdefault((t, j), []).append((lo + int(inside[0]), lo + int(inside[-1]) + g.n - 1, c))
        for (t, j), rows in place.items():
            merged = []
            for lo, hi, c in sorted(rows):
                if merged and lo <= merged[-1][1]:
                    merged[-1] = [merged[-1][0], max(merged[-1][1], hi), max(merged[-1][2], c)]
                else:
                    merged.append([lo, hi, c])
            base = int(b.first[some[t]])
            found += [(int(some[t]), g.names[j], lo - base, hi - base, c) for lo, hi, c in merged]
    return found


def scan(docs: DataFrame, templates: list[tuple[str, str]], *, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, template, first_word, last_word, containment), one row per place where a document holds a template.

    ``containment`` is the share of the template's shingles inside the window and one stride around it; places of one template that
    overlap are one.  A null or empty text and one without the words holds nothing; a repeated row gives its places again; templates
    without a word are never found; an empty table or no templates give an empty result.
    """
    groups = docs.sparkSession.sparkContext.broadcast(index(templates))
    inner = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        for ids, texts in blocks(batches):
            rows = matches(texts, groups.value, threshold) if groups.value else []
            yield pa.RecordBatch.from_arrays([
                pa.array([ids[r[0]] for r in rows], schema_id), pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.int64()),
                pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.float64())],
                ["doc_id", "template", "first_word", "last_word", "containment"])

    kind = inner.schema["doc_id"].dataType
    schema_id = pa.int64() if isinstance(kind, T.LongType) else pa.int32() if isinstance(kind, T.IntegerType) else pa.string()
    return inner.mapInArrow(run, T.StructType([T.StructField("doc_id", kind), T.StructField("template", T.StringType()), T.StructField(
        "first_word", T.LongType()), T.StructField("last_word", T.LongType()), T.StructField("containment", T.DoubleType())]))

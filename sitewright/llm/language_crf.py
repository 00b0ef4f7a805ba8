"""Language identification by a linear-chain conditional random field over the words of a text.

A word's features are its byte trigrams and four-grams with the blank before and after it (so its affixes), its bytes, and its entry in a
lexicon of frequent training words.  Labels are languages; transition weights are learned, so a text may switch between languages.
Marginals come from forward-backward over the whole text; the text's language is the one with the largest sum of marginals.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sitewright.llm.labels import fold
from sitewright.llm.textblocks import Block, MULT, blocks, space_table

BITS = 18
LEXICON_BITS = 16
#: Bounds of the fit: labelled documents that are read, and lexicon entries.
MAX_LABELLED = 1600
MAX_LEXICON = 20000
CHUNK = 200
#: Log-odds by which a training word keeps to its document's language when words are labelled anew.
ANCHOR = 2.0
#: Words of one document that count in full when its language is learned.
DOCUMENT_WORDS = 2000
UNKNOWN = "und"


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


class Words:
    """Hashed features of the words of some texts."""

    def __init__(self, texts: list[bytes]):
        b = Block(texts)
        self.first, self.counts = b.first, b.counts()
        self.hashes = b.word_hashes()
        blank = space_table()[b.data]
        d = np.where(blank, 32, b.data).astype(np.uint32)
        # capital Latin-1 letters are two bytes, the second 32 below that of the small letter
        after = np.concatenate([[False], b.data[:-1] == 0xC3])
        d[after & (d >= 0x80) & (d <= 0x9E) & (d != 0x97)] += 32
        p = np.concatenate([[32], d, [32, 32]]).astype(np.uint32)
        n = len(d)
        inner = ~blank
        three = (p[:n] << 16 | p[1:n + 1] << 8 | p[2:n + 2])
        four_ok = inner & (p[2:n + 2] != 32)
        mask = np.uint32((1 << BITS) - 1)
        scale = np.uint32(MULT & 0xFFFFFFFF | 1)
        h3 = (three * scale) >> np.uint32(32 - BITS)
        h4 = ((three << 8 | p[3:n + 3]) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS)
        none = np.uint32(0)  # bucket 0 stays at weight zero
        self.grams = [np.where(inner, h3 & mask, none), np.where(four_ok, h4 & mask, none), np.where(inner, d, none)]
        self.starts = b.starts


@dataclass
class Model:
    labels: list[str]
    grams: np.ndarray  # (buckets, labels)
    lexicon: np.ndarray  # hash by slot, 0 for none
    lexicon_weights: np.ndarray
    start: np.ndarray
    move: np.ndarray

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Row of the lexicon weights; the last one, all zero, for words outside it."""
        s = (hashes >> np.uint64(64 - LEXICON_BITS)).astype(np.int64)
        return np.where(self.lexicon[s] == hashes, s, len(self.lexicon))

    def emissions(self, w: Words) -> np.ndarray:
        if not len(w.starts):
            return np.zeros((0, len(self.labels)), np.float32)
        per_byte = self.grams[w.grams[0]]
        for g in w.grams[1:]:
            per_byte += self.grams[g]
        return np.add.reduceat(per_byte, w.starts, axis=0) + self.lexicon_weights[self.slots(w.hashes)]


def marginals(emissions: np.ndarray, first: np.ndarray, counts: np.ndarray, start: np.ndarray, move: np.ndarray, pairs: bool = False,
              mass: np.ndarray | None = None):
    """Posterior of every word's label, and the summed posterior of neighbouring pairs (times the ``mass`` of the first word); sequences
    run side by side, the longest first."""
    n, k = emissions.shape
    e = np.exp(emissions - emissions.max(1, keepdims=True)) if n else emissions
    order = np.argsort(-counts, kind="stable")
    at, length = first[order], counts[order]
    steps = int(length[0]) if len(length) else 0
    active = np.searchsorted(-length, -np.arange(1, steps + 1), side="right")
    t, pi = np.exp(move).astype(e.dtype), np.exp(start).astype(e.dtype)
    alpha, beta = np.empty_like(e), np.ones_like(e)
    for i in range(steps):
        idx = at[:active[i]] + i
        a = (a[:active[i]] @ t if i else pi) * e[idx]
        a = a / a.sum(1, keepdims=True)
        alpha[idx] = a
    for i in range(steps - 2, -1, -1):
        idx = at[:active[i + 1]] + i
        b = (beta[idx + 1] * e[idx + 1]) @ t.T
        beta[idx] = b / b.sum(1, keepdims=True)
    post = alpha * beta
    post /= np.maximum(post.sum(1, keepdims=True), 1e-30)
    if not pairs:
        return post, None
    inner = np.ones(n, bool)
    inner[(first + counts - 1)[counts > 0]] = False
    i = np.flatnonzero(inner)
    both = alpha[i][:, :, None] * t[None] * (e[i + 1] * beta[i + 1])[:, None, :]
    both /= np.maximum(both.sum((1, 2), keepdims=True), 1e-30)
    return post, (both if mass is None else both * mass[i, None, None]).sum(0)


def fit(texts: list[bytes], y: list[int], labels: list[str], *, epochs: int = 3, rate: float = 0.1, batch: int = 128 << 10, ridge: float = 1e-4,
        seed: int = 1) -> Model:
    """Likelihood ascent with per-weight rates.  Words first carry their document's label; for the last epoch they carry the label that
    the model itself finds, which teaches emissions and transitions about documents in several languages.  The weights are the mean over
    the steps of the last epoch, so no late batch outweighs the others."""
    k = len(labels)
    w = Words(texts)
    names, seen = np.unique(w.hashes, return_counts=True)
    top = names[np.argsort(-seen, kind="stable")][:MAX_LEXICON]
    lexicon = np.zeros(1 << LEXICON_BITS, np.uint64)
    lexicon[(top[::-1] >> np.uint64(64 - LEXICON_BITS)).astype(np.int64)] = top[::-1]
    m = Model(labels, np.zeros((1 << BITS, k), np.float32), lexicon, np.zeros((len(lexicon) + 1, k), np.float32), np.zeros(k), np.zeros((k, k)))
    squares = [np.full(x.shape, 1e-3) for x in (m.grams, m.lexicon_weights, m.start, m.move)]

    def ascend(x, s, g, step=rate):
        s += g * g
        x += step * g / np.sqrt(s)

    # every language has the same mass, and no document more than that of DOCUMENT_WORDS words of its language
    share = np.minimum(w.counts, DOCUMENT_WORDS) / np.maximum(w.counts, 1)
    of_language = np.bincount(y, share * w.counts, minlength=k)
    share = share * (w.counts.sum() / max(1, np.count_nonzero(of_language)) / np.maximum(of_language, 1))[np.array(y, np.int64)]
    order = np.random.default_rng(seed).permutation(len(texts))
    groups, held = [[]], 0
    for i in order:
        groups[-1].append(i)
        held += len(texts[i])
        if held >= batch:
            groups.append([])
            held = 0
    parts = [(Words([texts[i] for i in g]), np.array([y[i] for i in g]), share[g]) for g in groups if g]
    last = epochs - 1 if epochs > 1 else epochs
    sums, steps = None, 0
    for epoch in range(epochs):
        for part, truth, shares in parts:
            own, mass = np.repeat(truth, part.counts), np.repeat(shares, part.counts)
            if not len(own):
                continue
            e = m.emissions(part)
            # sequences are cut into chunks for training only
            first = np.concatenate([np.arange(a, a + c, CHUNK) for a, c in zip(part.first, part.counts)]).astype(np.int64)
            counts = np.diff(np.concatenate([first, [len(own)]]))
            if epoch == last:
                anchored = e.copy()
                anchored[np.arange(len(own)), own] += ANCHOR
                own = marginals(anchored, part.first[:-1], part.counts, m.start, m.move)[0].argmax(1)
            post, both = marginals(e, first, counts, m.start, m.move, pairs=True, mass=mass)
            g = -post.astype(float)
            g[np.arange(len(own)), own] += 1
            g *= mass[:, None]
            size = len(own)
            spread = np.zeros((len(part.grams[0]), k))
            lengths = np.diff(np.concatenate([part.starts, [len(spread)]]))
            spread[part.starts[0]:] = np.repeat(g, lengths, axis=0)
            total = np.stack([sum(np.bincount(x, spread[:, c], minlength=1 << BITS) for x in part.grams) for c in range(k)], 1)
            total[0] = 0
            ascend(m.grams, squares[0], total / size - ridge * m.grams)
            slot = m.slots(part.hashes)
            lex = np.stack([np.bincount(slot, g[:, c], minlength=len(lexicon) + 1) for c in range(k)], 1)
            lex[-1] = 0
            ascend(m.lexicon_weights, squares[1], lex / size - ridge * m.lexicon_weights)
            inner = np.ones(size, bool)
            inner[first + counts - 1] = False
            i = np.flatnonzero(inner)
            seen_pairs = np.bincount(own[i] * k + own[i + 1], mass[i], minlength=k * k).reshape(k, k)
            ascend(m.move, squares[3], (seen_pairs - both) / size - ridge * m.move, 5 * rate)
            ascend(m.start, squares[2], g[first].sum(0) / size - ridge * m.start)
            if epoch == epochs - 1:
                now = (m.grams, m.lexicon_weights, m.start, m.move)
                sums = [a + b for a, b in zip(sums, now)] if sums else [x.copy() for x in now]
                steps += 1
    if steps:
        m.grams, m.lexicon_weights, m.start, m.move = (x / steps for x in sums)
    return m


def learn(docs: DataFrame, train, *, id_col: str, text_col: str, lang_col: str, limit: int) -> Model | None:
    """The model of a bounded sample: the ids with the smallest hashes, as many for each language, fitted in one task."""
    known = docs.filter(train & F.col(id_col).isNotNull() & F.col(lang_col).isNotNull()).select(
        F.col(id_col).alias("_id"), F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.lit(3), F.col(id_col)).alias("order"))
    labels = sorted(r["lang"] for r in known.select("lang").distinct().collect())
    if not labels:
        return None
    each = max(1, limit // len(labels))
    ids = known.withColumn("_n", F.row_number().over(Window.partitionBy("lang").orderBy("order", "_id"))).filter(F.col("_n") <= each)
    ids = ids.select("_id", "lang", "order").limit(max(limit, len(labels)))
    sample = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("_text")).join(
        F.broadcast(ids), F.col("_doc") == F.col("_id"))

    def run(batches):
        texts, y = [], []
        for lang, some in blocks(batches):
            y += [labels.index(x) for x in lang]
            texts += some
        if texts:
            m = fit(texts, y, labels)
            raw = [np.ascontiguousarray(x).tobytes() for x in (m.grams, m.lexicon, m.lexicon_weights, m.start, m.move)]
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in raw], list("gawsm"))

    got = sample.orderBy("order", "_id").select("lang", "_text").coalesce(1).mapInArrow(
        run, "g binary, a binary, w binary, s binary, m binary").collect()
    if not got:
        return None
    k, r = len(labels), got[0]
    return Model(labels, np.frombuffer(r["g"], np.float32).reshape(-1, k), np.frombuffer(r["a"], np.uint64),
                 np.frombuffer(r["w"], np.float32).reshape(-1, k), np.frombuffer(r["s"]), np.frombuffer(r["m"]).reshape(k, k))


def predict(texts: list[bytes], m: Model) -> tuple[np.ndarray, np.ndarray]:
    """(label index, mean marginal) per text; a text without words gets label 0 and 0."""
    w = Words(texts)
    post, _ = marginals(m.emissions(w), w.first[:-1], w.counts, m.start, m.move)
    total = np.zeros((len(texts), len(m.labels)))
    some = np.flatnonzero(w.counts > 0)
    if len(some):
        total[some] = np.add.reduceat(post, w.first[:-1][some], axis=0)
    best = total.argmax(1)
    return best, total[np.arange(len(texts)), best] / np.maximum(w.counts, 1)


def identify(docs: DataFrame, *, folds: int = 3, held_out_fold: int = 1, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             limit: int = MAX_LABELLED, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every document with ``lang_pred`` and ``score`` (0 to 1).

    Learns from the languages of documents outside the held-out fold, at most ``limit`` of them.  A text that is null or has no letter is
    ``und`` with score 0, and so is every text if there is no language to learn from.  Every whole text is read; repeated rows are rated
    row by row; an empty table gives an empty result.
    """
    model = learn(docs, fold(id_col, folds) != held_out_fold, id_col=id_col, text_col=text_col, lang_col=lang_col, limit=limit)
    shared = docs.sparkSession.sparkContext.broadcast(model) if model else None
    inner = docs.select(F.struct(*keep).alias("_k"), F.col(text_col).alias("_t"))

    def rate(batches):
        for b in batches:
            texts = b.column(1).to_pylist()
            lang, score, part, held = [], [], [], 0
            for i, t in enumerate(texts):
                part.append((t or "").encode())
                held += len(part[-1])
                if held >= 2 << 20 or i == len(texts) - 1:
                    if shared:
                        best, share = predict(part, shared.value)
                        lang += [shared.value.labels[x] for x in best]
                        score += np.clip(share, 0, 1).tolist()
                    else:
                        lang, score = lang + [UNKNOWN] * len(part), score + [0.0] * len(part)
                    part, held = [], 0
            known = [has_letter(t) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([x if ok else UNKNOWN for x, ok in zip(lang, known)], pa.string()),
                                              pa.array([float(x) if ok else 0.0 for x, ok in zip(score, known)], pa.float64())],
                                             ["_k", "lang_pred", "score"])

    schema = T.StructType([inner.schema.fields[0], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return inner.mapInArrow(rate, schema).select("_k.*", "lang_pred", "score")

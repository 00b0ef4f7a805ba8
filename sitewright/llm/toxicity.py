"""Toxicity by FTRL-proximal logistic regression over hashed words, word pairs and pairs with one word skipped.

Per-coordinate rates let rare insults learn fast, and the L1 term leaves the weights of everything else at zero, so the model that is
sent to the tasks has a few thousand entries, and never more than MAX_WEIGHTS.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sitewright.llm.labels import fold, labelled_sample
from sitewright.llm.textblocks import Block, MULT, blocks, mix

BITS = 22
#: Bounds: labelled documents that are read, and weights that are kept (one per bucket at most).
MAX_LABELLED = 12000
MAX_WEIGHTS = 1 << BITS
KINDS = (1, 2, 3)


def buckets(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """(text index, bucket) of every word, word pair and pair around one word."""
    h, owner = b.word_hashes(), b.text_of_word()
    texts, at = [owner], [mix(h + np.uint64(1))]
    for kind, gap in ((2, 1), (3, 2)):
        same = owner[gap:] == owner[:-gap] if len(owner) > gap else np.zeros(0, bool)
        pair = mix((h[:-gap][same] * np.uint64(MULT)) ^ (h[gap:][same] + np.uint64(kind))) if len(owner) > gap else h[:0]
        texts.append(owner[:len(same)][same])
        at.append(pair)
    return np.concatenate(texts), (np.concatenate(at) >> np.uint64(64 - BITS)).astype(np.int64)


def ftrl(examples: list[np.ndarray], y: np.ndarray, *, alpha: float = 2.0, beta: float = 1.0, l1: float = 3.0, l2: float = 1.0,
         epochs: int = 2) -> tuple[np.ndarray, float]:
    """Weights by bucket, and the intercept, after passes over the examples in the given order; features count once per example."""
    z, n = np.zeros(1 << BITS), np.zeros(1 << BITS)
    bias = bias_n = 0.0
    for _ in range(epochs):
        for x, t in zip(examples, y):
            zx, nx = z[x], n[x]
            root = np.sqrt(nx)
            w = np.where(np.abs(zx) <= l1, 0.0, -(zx - np.sign(zx) * l1) / ((beta + root) / alpha + l2))
            p = 1 / (1 + np.exp(-min(max(bias + w.sum(), -30.0), 30.0)))
            g = p - t
            z[x] = zx + g - (np.sqrt(nx + g * g) - root) / alpha * w
            n[x] = nx + g * g
            bias_n += g * g
            bias -= alpha / (beta + bias_n ** 0.5) * g
    w = np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))
    return w, bias


def learn(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Non-zero buckets, their weights and the intercept; the bounded sample is fitted in one task, classes interleaved by seeded hash."""

    def run(batches):
        texts, y = [], []
        for labels, some in blocks(batches):
            y += labels
            b = Block(some, letters=True)
            owner, at = buckets(b)
            order = np.argsort(owner, kind="stable")
            cut = np.searchsorted(owner[order], np.arange(len(some) + 1))
            texts += [np.unique(at[order[cut[i]:cut[i + 1]]]) for i in range(len(some))]
        if len(set(y)) == 2:
            w, bias = ftrl(texts, np.array(y, float))
            k = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array([k.astype("<i4").tobytes()]), pa.array([w[k].astype("<f4").tobytes()]),
                                              pa.array([float(bias)])], ["k", "w", "bias"])

    one = sample.orderBy("order").select("label", "text").coalesce(1)
    got = one.mapInArrow(run, "k binary, w binary, bias double").collect()
    if not got:
        return None
    return np.frombuffer(got[0]["k"], "<i4"), np.frombuffer(got[0]["w"], "<f4"), got[0]["bias"]


def score(docs: DataFrame, labels: DataFrame, *, folds: int = 4, held_out_fold: int = 2, threshold: float = 0.3, id_col: str = "doc_id",
          text_col: str = "text", label: str = "toxic", limit: int = MAX_LABELLED, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every document with ``score`` (0 to 1) and ``predicted`` (1 if the score is ``threshold`` or more).

    Learns from labels whose id is outside the held-out fold, at most ``limit`` documents, half of each class; the intercept is then
    moved to the share of label 1 among all training labels.  Every whole text is scored, a null one as an empty one, repeated rows row
    by row.  Without labels of both classes every document gets the share of label 1, or 0 without any.  An empty table gives none.
    """
    sample, counts = labelled_sample(docs, labels, label, fold(id_col, folds) != held_out_fold, limit, id_col=id_col, text_col=text_col)
    total = sum(counts.values())
    share = counts.get(1, 0) / total if total else 0.0
    model = learn(sample) if counts.get(0) and counts.get(1) else None
    if model:
        drawn = [min(counts[v], limit // 2) for v in (0, 1)]
        shift = np.log(counts[1] / counts[0]) - np.log(drawn[1] / drawn[0])
        model = docs.sparkSession.sparkContext.broadcast((*model[:2], model[2] + shift))
    inner = docs.select(F.struct(*keep).alias("_k"), F.col(text_col).alias("_t"))

    def rate(batches):
        weight = None
        for b in batches:
            texts = [(t or "").encode() for t in b.column(1).to_pylist()]
            if model and weight is None:
                k, w, bias = model.value
                weight = np.zeros(1 << BITS, np.float32)
                weight[k] = w
            out, start, held = [], 0, 0
            for i, t in enumerate(texts):
                held += len(t)
                if held >= 1 << 20 or i == len(texts) - 1:
                    part = texts[start:i + 1]
                    if model:
                        owner, at = buckets(Block(part, letters=True))
                        w = weight[at]
                        hit = np.flatnonzero(w)
                        seen = np.unique(owner[hit] << BITS | at[hit])
                        m = bias + np.bincount(seen >> BITS, weight[seen & (1 << BITS) - 1], minlength=len(part))
                        out.append(1 / (1 + np.exp(-np.clip(m, -30, 30))))
                    else:
                        out.append(np.full(len(part), share))
                    start, held = i + 1, 0
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(out) if out else np.zeros(0), pa.float64())], ["_k", "score"])

    out = inner.mapInArrow(rate, T.StructType([inner.schema.fields[0], T.StructField("score", T.DoubleType())]))
    return out.select("_k.*", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))

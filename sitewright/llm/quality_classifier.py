"""Document quality by Bradley-Terry ranking: scores learned from preference pairs, cut at a quantile of the scores."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from sitewright.llm.labels import fold, labelled_sample, training_labels
from sitewright.llm.textblocks import Block, blocks, ngram_hashes, releasing
from sitewright.session import checkpoint

#: Bounds of the fit: labelled documents read, and preference pairs drawn from them.
MAX_LABELLED = 8000
MAX_PAIRS = 20000
BINS = 10
#: Scores that are cut in the driver; more are narrowed down by histograms of as many bins first.
MAX_VALUES = 4096


def _share_again(values: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Per owner: how many values equal an earlier one of the same owner."""
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    again = (v[1:] == v[:-1]) & (o[1:] == o[:-1])
    return np.bincount(o[1:][again], minlength=n).astype(float)


def features(texts: list[bytes]) -> np.ndarray:
    """One row of surface measures per text."""
    b = Block(texts, fold=False)
    n = len(texts)
    size = np.maximum(np.diff(b.offsets) - 1, 1).astype(float)
    words = b.counts().astype(float)
    some = np.maximum(words, 1)

    def per_text(flag):
        total = np.concatenate([[0], np.cumsum(flag)])
        return (total[b.offsets[1:]] - total[b.offsets[:-1]]).astype(float)

    table = np.zeros(256, np.uint8)
    for k, chars in enumerate((b"#*$%&|<>", b"!?", b"|", b"0123456789", b".,;:", b"\n", b"@/=_-~^+\\[]{}()"), 1):
        for c in chars:
            table[c] = k if table[c] == 0 or k != 3 else table[c]
    kind = table[b.data]
    upper = (b.data >= 65) & (b.data <= 90)
    lower = (b.data >= 97) & (b.data <= 122)
    out = [np.log1p(words)] + [per_text(kind == k) / size for k in (1, 2, 4, 5, 6, 7)]
    out += [per_text(b.data == 124) / some, per_text(upper) / np.maximum(per_text(upper | lower), 1), per_text(b.data >= 128) / size]
    length = b.ends - b.starts
    owner = b.text_of_word()
    out += [np.bincount(owner, length, minlength=n) / some, np.bincount(owner, length >= 16, minlength=n) / some]
    last = b.data[b.ends - 1] if len(b.ends) else b.data[:0]
    out += [np.bincount(owner, table[last] == 2, minlength=n) / some, np.bincount(owner, table[last] == 1, minlength=n) / some]
    h = b.word_hashes()
    next_same = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
    out += [np.bincount(owner[1:][next_same], minlength=n) / some, _share_again(h, owner, n) / some]
    grams = ngram_hashes(h, 5)
    inside = owner[4:] == owner[:len(grams)]
    out += [_share_again(grams[inside], owner[:len(grams)][inside], n) / some]
    return np.column_stack(out)


@dataclass
class Model:
    edges: list[np.ndarray]
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def design(self, x: np.ndarray) -> np.ndarray:
        """Standardised measures and one column per quantile bin of each."""
        cols = [(x - self.center) / self.scale]
        for j, e in enumerate(self.edges):
            cols.append((np.searchsorted(e, x[:, j], side="right")[:, None] == np.arange(1, len(e) + 1)).astype(float))
        return np.clip(np.hstack(cols), -8, 8)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.design(x) @ self.weights - self.threshold


def fit(x: np.ndarray, y: np.ndarray, share_bad: float, *, pairs: int = MAX_PAIRS, ridge: float = 1e-3, seed: int = 1) -> Model:
    """Weights w that make w.f(better) exceed w.f(worse) over seeded preference pairs; the threshold is the ``share_bad`` quantile of
    the scores, the classes weighted as they occur."""
    spread = x.std(0)
    m = Model([np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])], x.mean(0),
              np.where(spread > 0, spread, 1), np.zeros(0), 0.0)
    f = m.design(x)
    rng = np.random.default_rng(seed)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    d = f[rng.choice(good, pairs)] - f[rng.choice(bad, pairs)]
    w = np.zeros(f.shape[1])
    for _ in range(12):
        p = 1 / (1 + np.exp(np.clip(d @ w, -30, 30)))
        gradient = d.T @ p / pairs - ridge * w
        hessian = (d * (p * (1 - p))[:, None]).T @ d / pairs + ridge * np.eye(len(w))
        w = w + np.linalg.solve(hessian, gradient)
    m.weights = w
    s = m.margin(x)
    mass = np.where(y == 1, (1 - share_bad) / len(good), share_bad / len(bad))
    order = np.argsort(s, kind="stable")
    at = int(np.searchsorted(np.cumsum(mass[order]), share_bad))
    at = min(max(at, 0), len(order) - 2)
    m.threshold = float((s[order[at]] + s[order[at + 1]]) / 2)
    return m


def margins(batches, model: Model | None):
    """Every batch of (_k, text) with the margins of its texts, NaN without a model."""
    for b in batches:
        texts = [(t or "").encode() for t in b.column(1).to_pylist()]
        out, start, held = [], 0, 0
        for i, t in enumerate(texts):
            held += len(t)
            if held >= 1 << 20 or i == len(texts) - 1:
                out.append(model.margin(features(texts[start:i + 1])) if model else np.full(i + 1 - start, np.nan))
                start, held = i + 1, 0
        yield b, np.concatenate(out) if out else np.zeros(0)


def quantile_cut(scores: DataFrame, share_bad: float) -> float:
    """The ``share_bad`` quantile of all rows of (label, s), the classes weighted as they occur, halfway to the next larger score."""
    n = {r["label"]: r["n"] for r in scores.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    mass = {0: share_bad / max(n.get(0, 0), 1), 1: (1 - share_bad) / max(n.get(1, 0), 1)}
    below, inside, goal = 0.0, scores, share_bad - 1e-9 * min(mass.values())
    sums = [F.sum((F.col("label") == y).cast("bigint")).alias(f"n{y}") for y in (0, 1)]
    weight = lambda r: mass[0] * r["n0"] + mass[1] * r["n1"]
    while True:
        lo, hi, rows = inside.agg(F.min("s"), F.max("s"), F.count(F.lit(1))).first()
        if rows <= MAX_VALUES or lo == hi:
            break
        part = F.least(F.floor((F.col("s") - lo) * (MAX_VALUES / (hi - lo))), F.lit(MAX_VALUES - 1))
        bins = inside.groupBy(part.alias("b")).agg(F.min("s").alias("lo"), F.max("s").alias("hi"), *sums).orderBy("lo").collect()
        for r in bins:
            if below + weight(r) >= goal or r is bins[-1]:
                break
            below += weight(r)
        inside = scores.filter(F.col("s").between(r["lo"], r["hi"]))
    values = inside.groupBy("s").agg(*sums).orderBy("s").collect()
    for r in values:
        below += weight(r)
        if below >= goal:
            break
    at = r["s"]
    if below > share_bad + 1e-9 * min(mass.values()) and r["n0"] + r["n1"] > 1:  # equal scores on both sides of the cut
        return float(at)
    after, before = scores.agg(F.min(F.when(F.col("s") > at, F.col("s"))), F.max(F.when(F.col("s") < at, F.col("s")))).first()
    other = before if after is None else after
    return float(at if other is None else (at + other) / 2)


def _scored(docs: DataFrame, labels: DataFrame, keep: list[str], *, folds: int = 3, held_out_fold: int = 1, id_col: str = "doc_id",
            text_col: str = "text", label: str = "quality", limit: int = MAX_LABELLED) -> DataFrame:
    """(_k, score): the kept columns as a struct, and the score."""
    sample, counts = labelled_sample(docs, labels, label, fold(id_col, folds) != held_out_fold, limit, id_col=id_col, text_col=text_col)
    total = sum(counts.values())
    width = features([b""]).shape[1]

    def measure(batches):
        for y, texts in blocks(batches):
            x = features(texts)
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], ["label", "x"])

    model = None
    if counts.get(0) and counts.get(1):
        rows = sample.select("label", "text").mapInArrow(releasing(measure), "label int, x array<double>").orderBy("x", "label").collect()
        x, y = np.array([r["x"] for r in rows]).reshape(-1, width), np.array([r["label"] for r in rows])
        if len(set(y.tolist())) == 2:
            model = fit(x, y, counts[0] / total)
            if max(counts.values()) > limit // 2:  # the weights come from a sample, the threshold does not
                model.threshold = 0.0

                def raw(batches):
                    for b, m in margins(batches, model):
                        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(m, pa.float64())], ["_k", "s"])

                train = fold(id_col, folds) != held_out_fold
                known = training_labels(labels, label, train, id_col)
                every = docs.filter(train).select(F.struct(F.col(id_col).alias("_doc")).alias("_k"), F.col(text_col).alias("_t"))
                every = every.mapInArrow(releasing(raw), T.StructType([T.StructField("_k", every.schema["_k"].dataType), T.StructField("s", T.DoubleType())]))
                every = every.select("_k._doc", "s").join(known, F.col("_doc") == F.col("_id")).select("label", "s")
                model.threshold = quantile_cut(checkpoint(every), counts[0] / total)
    flat = counts.get(1, 0) / total if total else 0.5
    inner = docs.select(F.struct(*keep).alias("_k"), F.col(text_col).alias("_t"))
    where = inner.schema["_k"].dataType

    def rate(batches):
        for b, m in margins(batches, model):
            s = 1 / (1 + np.exp(-np.clip(m, -30, 30)))
            s = np.where(np.isnan(s), flat, s)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64())], ["_k", "score"])

    return inner.mapInArrow(releasing(rate), T.StructType([T.StructField("_k", where), T.StructField("score", T.DoubleType())]))


def score(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, ``score`` (0 to 1) and ``predicted`` (1 if the score is 0.5 or more) of every document.

    Learns weights from labels whose id is outside the held-out fold, at most ``limit`` documents, and the threshold from the scores of
    all of them; scores every whole text, a null one as an
    empty one.  Without labels of both classes every document gets the share of label 1, or 0.5 without any.  Repeated rows are scored
    row by row; an empty table gives an empty result.  Options: ``folds``, ``held_out_fold``, ``id_col``, ``text_col``, ``label``, ``limit``.
    """
    key = options.get("id_col", "doc_id")
    return _scored(docs, labels, [key], **options).select("_k.*", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, with all their columns, that ``score`` does not reject."""
    return _scored(docs, labels, docs.columns, **options).filter("score >= 0.5").select("_k.*")

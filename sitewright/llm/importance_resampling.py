"""Resampling documents towards a target distribution over hashed words and word pairs.

Every document's weight is the mean gain of its features, looked up in one array of gains by bucket; counts come from per-task arrays
that are summed by bucket.  Seeded Gumbel noise on the weights makes the highest scores a weighted draw without replacement.  The
cutoff is found by bisection: exact counts over the written (score, id) table halve the range of scores, then that of the ids tied at
the cutoff.  Only drawn rows are range-partitioned for their ranks.
"""
from __future__ import annotations

import hashlib
import math
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from sitewright.session import checkpoint

BUCKETS = 10000
PIECE = 1 << 20
RESULTS = ("n_features", "weight", "score", "rank")
#: Lower-cases A-Z; every other ASCII byte that is no letter or digit becomes a space.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def runs(text: str | None, longest: int = 2, piece: int = PIECE):
    """(new words, crc32 of every run of 1 to ``longest`` words that ends in them), piece by piece of the text."""
    data = (text or "").encode().translate(FOLD)
    start, carry = 0, []
    while start < len(data):
        stop = data.find(b" ", start + piece)
        stop = len(data) if stop < 0 else stop
        fresh = data[start:stop].split()
        words, old = carry + fresh, len(carry)
        sums = list(map(crc32, words))
        out = sums[old:]
        for k in range(1, min(longest, len(words))):
            sums = list(map(crc32, words[k:], map(crc32, repeat(b" "), sums)))
            out += sums[max(0, old - k):]
        yield len(fresh), out
        carry = words[-(longest - 1):] if longest > 1 else []
        start = stop


def bucket_counts(texts: DataFrame, text_col: str, longest: int, n_buckets: int) -> np.ndarray:
    """Occurrences of features by bucket; one array per task, summed by bucket, ``n_buckets`` rows reach the driver."""

    def count(batches):
        total = np.zeros(n_buckets, np.int64)
        for b in batches:
            for t in b.column(0):
                for _, sums in runs(t.as_py(), longest):
                    total += np.bincount(np.array(sums, np.int64) % n_buckets, minlength=n_buckets)
        k = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(total[k])], ["bucket", "n"])

    per_task = texts.select(text_col).mapInArrow(count, "bucket long, n long")
    out = np.zeros(n_buckets, np.int64)
    for r in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log ratio of the smoothed shares, by bucket."""
    s, t, n = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log((float(b) + 1) * (s + n) / ((float(a) + 1) * (t + n)))) for a, b in zip(source, target)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, *, seed: int, longest: int, id_col: str, text_col: str, kept: list[str]) -> DataFrame:
    """(_k, _id, n_words, n_features, weight, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)

    def rate(batches):
        table = shared.value
        for b in batches:
            rows = []
            for i, t in zip(b.column(1).to_pylist(), b.column(2)):
                words = features = total = 0
                for fresh, sums in runs(t.as_py(), longest):
                    words, features = words + fresh, features + len(sums)
                    total += int(table[np.array(sums, np.int64) % len(table)].sum())
                h = int(hashlib.sha256(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
                weight = total // features if features else 0
                rows.append((words, features, weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array([r[k] for r in rows], pa.int64()) for k in range(4))],
                                             ["_k", "_id", "n_words", "n_features", "weight", "score"])

    inner = docs.select((F.struct(*kept) if kept else F.struct(F.lit(0).alias("_"))).alias("_k"), F.col(id_col).cast("bigint").alias("_id"),
                        F.col(text_col).alias("_t"))
    schema = T.StructType([*inner.schema.fields[:2], *(T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight", "score"))])
    return inner.mapInArrow(rate, schema)


def bisect(low: int, high: int, holds) -> int:
    """The largest value in [low, high) for which ``holds``; it holds at ``low`` and up to some value."""
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if holds(mid) else (low, mid)
    return low


def cutoff(scored: DataFrame, k: int) -> tuple[int, int | None]:
    """(score, id): the first ``k`` rows by falling score and rising id are above the score, or at it with an id up to this one.

    Null ids come last; the id is null if some of them are needed.  ``scored`` has (score, _id); each step is one exact count.
    """
    ends = scored.agg(F.min("score").alias("a"), F.max("score").alias("b")).first()
    score = bisect(ends["a"], ends["b"] + 1, lambda c: scored.filter(F.col("score") >= c).count() >= k)
    need = k - scored.filter(F.col("score") > score).count()
    tied = scored.filter((F.col("score") == score) & F.col("_id").isNotNull())
    ends = tied.agg(F.min("_id").alias("a"), F.max("_id").alias("b"), F.count(F.lit(1)).alias("n")).first()
    if ends["n"] < need:
        return score, None
    # the largest id below which too few of the tied rows lie is the one that completes them
    return score, bisect(ends["a"], ends["b"] + 1, lambda d: tied.filter(F.col("_id") < d).count() < need)


def resample(docs: DataFrame, target: DataFrame, *, percent: int = 25, min_words: int = 20, seed: int = 7, longest: int = 2,
             n_buckets: int = BUCKETS, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
             keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with ``n_features``, ``weight``, ``score`` and ``rank`` (null if not drawn).

    Draws ``percent`` of the rows with at least ``min_words`` words, rounded down, by falling score.  The id is a whole number; equal
    scores go by the smaller id, null ids last, and repeated rows of one id by fewer features and then in any order, each with a rank of its own.
    A null text has no words; a document without features has weight 0.  A null id draws like the text 'null'.  An empty target or an
    empty table counts nothing; an empty table gives none.  Columns of ``docs`` other than id, text and ``keep`` are not read; of ``keep``
    those named like a result are left out.
    """
    spark = docs.sparkSession
    kept = [c for c in keep if c not in RESULTS]
    gain = gains(bucket_counts(docs, text_col, longest, n_buckets), bucket_counts(target, target_text_col, longest, n_buckets))
    scored = checkpoint(weigh(docs, gain, seed=seed, longest=longest, id_col=id_col, text_col=text_col, kept=kept))
    able = F.col("n_words") >= min_words
    k = percent * scored.filter(able).count() // 100
    own = ["_k.*"] if kept else []
    if k == 0:
        return scored.select(*own, "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    score, last = cutoff(scored.filter(able).select("score", "_id"), k)
    inside = F.lit(True) if last is None else F.coalesce(F.col("_id") <= last, F.lit(False))
    drawn = able & ((F.col("score") > score) | ((F.col("score") == score) & inside))

    order = [F.desc("score"), F.asc_nulls_last("_id"), F.asc("n_features")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    sorted_rows = scored.filter(drawn).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = checkpoint(sorted_rows.withColumn("_p", F.shiftright(place, 33).cast("int")).withColumn("_i", place.bitwiseAND(F.lit((1 << 33) - 1))))
    # one row per partition: as many as shuffle partitions
    sizes = placed.groupBy("_p").agg(F.count(F.lit(1)).alias("_n"))
    before = sizes.select(F.col("_p").alias("_q"), (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_before"))
    rank = F.col("_before") + F.col("_i") + 1
    ranked = placed.join(F.broadcast(before), F.col("_p") == F.col("_q")).select(
        *own, "n_features", "weight", "score", F.when(rank <= k, rank).cast("bigint").alias("rank"))
    rest = scored.filter(~drawn).select(*own, "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank"))
    return ranked.unionByName(rest)

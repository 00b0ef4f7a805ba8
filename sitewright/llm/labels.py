"""Bounded, repeatable samples of labelled documents."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(id_col: str, n: int) -> Column:
    """crc32 of the id's text modulo n; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(n)).cast("int")


def training_labels(labels: DataFrame, label: str, train: Column, id_col: str = "doc_id") -> DataFrame:
    """(_id, label): one row per id that meets ``train``; an id labelled more than once takes the largest value, a null label is none."""
    return labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull()).filter(train).groupBy(F.col(id_col).alias("_id")).agg(
        F.max(label).cast("int").alias("label"))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, train: Column, limit: int, *, id_col: str = "doc_id",
                    text_col: str = "text", seed: int = 7) -> tuple[DataFrame, dict[int, int]]:
    """Up to ``limit`` / 2 documents of each class as (label, order, text), and the number of training labels of each class.

    ``train`` is a condition on the id; an id labelled more than once takes the largest value, a null label is none.  The sample holds
    the ids with the smallest seeded hashes, so at most ``limit`` ids are broadcast to find their texts.  The class counts are over all
    labels.
    """
    known = training_labels(labels, label, train, id_col).withColumn("order", F.xxhash64(F.lit(seed), F.col("_id")))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    half = [known.filter(F.col("label") == v).orderBy("order", "_id").limit(limit // 2) for v in (0, 1)]
    ids = half[0].unionByName(half[1])
    text = docs.select(F.col(id_col).alias("_doc"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return text.join(F.broadcast(ids), F.col("_doc") == F.col("_id")).select("label", "order", "text"), counts

"""From raw documents to token ids, stage by stage; every stage is written as Parquet and read again by the next one."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitewright.llm import bpe, mixing, ngram_join, quality_classifier, suffix_dedup
from sitewright.llm.queries import word_bpe
from sitewright.session import configure, stage_folder


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_classifier.accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles with a similarity of 0.8 or more: the one with the smallest id."""
    return ngram_join.one_of_each(docs, n=5, percent=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 400 bytes that occur elsewhere; ``n_chars`` follows the text."""
    return suffix_dedup.deduplicated(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and the text that the ids decode to."""
    return bpe.encode(docs, word_bpe(), keep=("doc_id", "lang", "source"))


STAGES = [("good_documents", good_documents), ("one_of_near_copies", one_of_near_copies), ("without_repeats", without_repeats),
          ("mixed_sources", mixed_sources), ("token_ids", token_ids)]
#: Learned scores and token ids are beyond SQL; the stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; returns the last one's frame."""
    configure(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{stage_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            out.write.parquet(f"{folder}/{k}-{name}")
            out = spark.read.parquet(f"{folder}/{k}-{name}")
        docs = out
    return docs

"""Tables to text."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

TIER_COLUMNS = ["site_id", "chrom", "pos", "transgene_positive", "clip_5p_len", "clip_3p_len", "hit_5p", "hit_5p_identity",
                "hit_5p_aln_len", "hit_5p_source", "hit_3p", "hit_3p_identity", "hit_3p_aln_len", "hit_3p_source"]


def write_tsv(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite").options(sep="\t", header=True, nullValue="", emptyValue="")
    (w.partitionBy(*partition_by) if partition_by else w).csv(path)


def write_table(df: DataFrame, path: str, partition_by: tuple = ("sample",), sort_by: tuple = ()) -> None:
    """Parquet partitioned by sample, rows sorted inside files so that min/max statistics prune.

    Only the partitions that ``df`` has are replaced; other samples of the table stay.
    """
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def tier_rows(tiers: DataFrame) -> DataFrame:
    """Tier table in file layout: booleans as True/False text."""
    flag = F.when(F.col("transgene_positive"), "True").otherwise("False")
    return tiers.withColumn("transgene_positive", flag).select(*[c for c in ("sample",) if c in tiers.columns], *TIER_COLUMNS)


def fasta_lines(df: DataFrame, name: str = "id", seq: str = "seq", width: int = 80) -> DataFrame:
    wrapped = F.regexp_replace(F.regexp_replace(F.col(seq), "(.{%d})" % width, "$1\n"), "\n$", "")
    return df.select(F.concat(F.lit(">"), F.col(name), F.lit("\n"), wrapped).alias("value"))


def write_fasta(df: DataFrame, path: str, name: str = "id", seq: str = "seq", width: int = 80) -> None:
    fasta_lines(df, name, seq, width).write.mode("overwrite").text(path)

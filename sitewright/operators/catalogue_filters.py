"""Row selection over contigs, catalogue headers, hits and junctions."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Header patterns that are always removed, and those that mark plant vectors.
REMOVE_WORDS = [r"\badapter\b", r"\bprimer\b", r"\blinker\b", r"\bPCR\b", r"\bIllumina\b", r"\bIon\s*Torrent\b", r"\b454\b",
                r"\bSOLiD\b", r"\bbarcode\b", r"\bindex\b"]
PLANT_WORDS = [r"\bbinary\b", r"\bpCAMBIA\b", r"\bpPZP\d", r"\bpGreen\b", r"\bpSoup\b", r"\bpBI\d", r"\bpBIN\d", r"\bBin\s*19\b",
               r"\bplant\s+transform", r"\bT-DNA\b", r"\bGUS\s+gene\s+fusion\b", r"\bpART\b", r"\bpORE\b", r"\bpMDC\b",
               r"\bpEarley\b", r"\bpGWB\b", r"\bpCLEAN\b", r"\bpMAA\b"]

# Rank of confidence labels; unknown labels rank as Medium.
CONFIDENCE_RANK = {"Low": 0, "Medium": 1, "High": 2}


def vector_reason(header, mode: str = "all"):
    """NULL for a header that stays, else the lower-cased keyword (or non-plant-vector) that removes it."""
    hit = F.lower(F.regexp_extract(header, "(?i)(" + "|".join(REMOVE_WORDS) + ")", 1))
    reason = F.when(hit != "", hit)
    if mode == "plant":
        reason = reason.when(~F.rlike(header, F.lit("(?i)" + "|".join(PLANT_WORDS))), "non-plant-vector")
    return reason


def filter_vectors(elements: DataFrame, mode: str = "all") -> DataFrame:
    """Vector records that stay, their header prefixed."""
    kept = elements.filter(vector_reason(F.col("header"), mode).isNull())
    return kept.withColumn("header", F.concat(F.lit("univec|"), "header"))


def vector_removals(elements: DataFrame, mode: str = "all") -> DataFrame:
    rows = elements.select(vector_reason(F.col("header"), mode).alias("reason")).filter("reason IS NOT NULL")
    return rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def filter_contigs_by_markers(contigs: DataFrame, hits: DataFrame, min_identity: float = 90.0, min_len: int = 200) -> DataFrame:
    """Contigs with a hit that passes in any marker set."""
    good = hits.filter((F.col("pident") >= min_identity) & (F.col("length") >= min_len)).select("sample", F.col("qseqid").alias("contig")).distinct()
    return contigs.join(good, ["sample", "contig"], "left_semi")


def marker_counts(contigs: DataFrame, kept: DataFrame) -> DataFrame:
    n = contigs.groupBy("sample").agg(F.count(F.lit(1)).alias("total"))
    k = kept.groupBy("sample").agg(F.count(F.lit(1)).alias("kept"))
    return n.join(k, "sample", "left").na.fill(0, ["kept"])


def element_hits(hits: DataFrame, min_len: int = 20) -> DataFrame:
    """Queries that hit any database, with the number of hits and the first one (database order, then line)."""
    first = F.min_by("sseqid", F.struct("db_idx", "line_no"))
    return hits.filter(F.col("length") >= min_len).groupBy("sample", "qseqid").agg(
        F.count(F.lit(1)).alias("n_hits"), first.alias("first_hit"))


def maps_to_host(paf: DataFrame, min_identity: float = 0.90, min_cov: float = 0.80) -> DataFrame:
    """Queries with an alignment over both gates."""
    ok = (F.col("block_len") > 0) & (F.col("identity") >= min_identity) & (F.col("aligned_frac") >= min_cov)
    return paf.filter(ok).select("sample", "qname").distinct()


def grna_hits(hits: DataFrame, max_mm: int = 4) -> DataFrame:
    """Near-full-length guide hits (0-based half-open); unaligned bases count as mismatches."""
    ok = (F.col("length") >= F.col("grna_len") - max_mm) & (F.col("n_mismatch") <= max_mm)
    plus = F.col("sstart") < F.col("send")
    return hits.filter(ok).withColumns({
        "strand": F.when(plus, "+").otherwise("-"),
        "t_start": F.least("sstart", "send") - 1,
        "t_end": F.greatest("sstart", "send"),
        "mismatches": F.col("n_mismatch") + F.col("grna_len") - F.col("length"),
    })


def candidate_inserts(sites: DataFrame, inserts: DataFrame) -> DataFrame:
    """Inserts of CANDIDATE sites with traceable headers."""
    keep = sites.filter(F.col("verdict") == "CANDIDATE").select("sample", "site_id")
    stem = F.regexp_replace("site_id", "^insertion_", "")
    return inserts.join(keep, ["sample", "site_id"]).withColumn(
        "header", F.concat_ws("|", "sample", stem, F.col("idx").cast("string"), "header"))


def dedupe_junctions(j: DataFrame) -> DataFrame:
    """Highest mapping quality per contig, chromosome and position (first row on ties)."""
    keys = ["sample", "contig", "host_chr", "junction_pos"]
    rest = [c for c in j.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct((-F.col("host_mapq")).alias("q"), F.col("line_no")))
    return j.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")


def confidence_rank(c):
    from sitewright.functions.sequence import literal_map

    return F.coalesce(literal_map(CONFIDENCE_RANK)[c], F.lit(CONFIDENCE_RANK["Medium"]))


def best_junctions(j: DataFrame, min_conf: str = "Medium") -> DataFrame:
    """Highest confidence per contig, chromosome and position, then the confidence gate."""
    keys = ["sample", "contig", "host_chr", "junction_pos"]
    rest = [c for c in j.columns if c not in keys]
    best = F.min_by(F.struct(*rest), F.struct((-confidence_rank(F.col("confidence"))).alias("q"), F.col("line_no")))
    out = j.groupBy(*keys).agg(best.alias("b")).select(*keys, "b.*")
    return out.filter(confidence_rank(F.col("confidence")) >= CONFIDENCE_RANK[min_conf])

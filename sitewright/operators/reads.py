"""Read-level filters and pair logic."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sitewright.functions import calls as fl, flag_is, revcomp
from sitewright.operators.core import bin_join, keep_known, key_hashes, scope
from sitewright.session import checkpoint


def primary(alignments: DataFrame) -> DataFrame:
    """Mapped primary records that carry a CIGAR and a sequence."""
    off = fl.UNMAPPED | fl.SECONDARY | fl.SUPPLEMENTARY
    return alignments.filter(~flag_is("flag", off) & F.col("cigar").isNotNull() & (F.col("cigar") != "*") & F.col("seq").isNotNull())


def quality_counts(qual) -> dict:
    """Bases at or above Q20 and Q30 by deleting the characters below each cut-off (Phred+33)."""
    low20 = "".join(chr(c) for c in range(33, 53))
    low30 = "".join(chr(c) for c in range(33, 63))
    n = lambda chars: F.length(F.translate(qual, chars, ""))
    return {"q20": n(low20), "q30": n(low30)}


def read_qc(reads: DataFrame, q: int = 20, min_len: int = 50, max_low: float = 0.4) -> DataFrame:
    """Pass/fail class per read: ``too_short``, ``low_quality`` (over 40 % of bases under ``q``) or ``passed``."""
    low = "".join(chr(c) for c in range(33, 33 + q))
    good = F.length(F.translate("qual", low, ""))
    bad_share = (F.length("qual") - good) / F.length("qual")
    status = F.when(bad_share > max_low, "low_quality").when(F.length("seq") < min_len, "too_short").otherwise("passed")
    return reads.withColumn("qc", status)


def qc_summary(checked: DataFrame, keys=("sample",)) -> DataFrame:
    """Counts and quality rates before and after the filter in one pass."""
    counts = quality_counts(F.col("qual"))
    rows = checked.select(*keys, "qc", F.length("seq").alias("len"), counts["q20"].alias("q20"), counts["q30"].alias("q30"))
    ok = F.col("qc") == "passed"
    agg = [F.count_if(F.col("qc") == s).alias(s) for s in ("passed", "low_quality", "too_short")]
    agg.append(F.count(F.lit(1)).alias("reads_before"))
    for tag, cond in (("before", F.lit(True)), ("after", ok)):
        agg += [F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0)).cast("bigint").alias(f"{n}_{tag}")
                for c, n in (("len", "bases"), ("q20", "q20_bases"), ("q30", "q30_bases"))]
    out = rows.groupBy(*keys).agg(*agg)
    for tag in ("before", "after"):
        for k in ("q20", "q30"):
            out = out.withColumn(f"{k}_rate_{tag}", F.col(f"{k}_bases_{tag}") / F.col(f"bases_{tag}"))
    return out.drop("q20_bases_before", "q30_bases_before", "q20_bases_after", "q30_bases_after")


def sampling_fraction(fraction: float | None = None, target_coverage: float | None = None, total_pairs: int | None = None,
                      read_length: int = 150, genome_size: int | None = None) -> float:
    """Share of pairs to keep, clamped to 1."""
    if fraction is not None:
        if fraction <= 0:
            raise ValueError(f"fraction must be > 0, got {fraction}")
        return min(1.0, float(fraction))
    if not (target_coverage and total_pairs and genome_size):
        raise ValueError("give fraction, or target_coverage with total_pairs and genome_size")
    return min(1.0, target_coverage * genome_size / (2 * read_length) / total_pairs)


def subsample_pairs(reads: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Keep a pair by a hash of its name, so that mates stay together and reruns agree."""
    f = sampling_fraction(fraction)
    if f >= 1:
        return reads
    key = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), "qname")), 1, 8), 16, 10).cast("bigint")
    return reads.filter(key < int(f * (1 << 32)))


def extract_pairs(alignments: DataFrame, reads: DataFrame) -> DataFrame:
    """Both mates of every pair with a mapped or supplementary record."""
    hit = ~flag_is("flag", fl.UNMAPPED) | flag_is("flag", fl.SUPPLEMENTARY)
    names = alignments.filter(hit).select("sample", "qname").distinct()
    return reads.join(names, ["sample", "qname"], "left_semi")


def pair_counts(reads: DataFrame) -> DataFrame:
    """Names, first and second mates, and names seen with one mate only."""
    per_name = reads.groupBy("sample", "qname").agg(
        F.count_if(F.col("mate") == 1).alias("r1"), F.count_if(F.col("mate") == 2).alias("r2"))
    return per_name.groupBy("sample").agg(
        F.count(F.lit(1)).alias("names"), F.sum("r1").alias("r1"), F.sum("r2").alias("r2"),
        F.count_if((F.col("r1") == 0) | (F.col("r2") == 0)).alias("singletons"))


def foreign_reads(alignments: DataFrame, mapq: int = 20) -> DataFrame:
    """Read names without any confidently mapped record of a fully mapped pair."""
    placed = alignments.filter(~flag_is("flag", fl.UNMAPPED | fl.MATE_UNMAPPED) & (F.col("mapq") >= mapq))
    names = alignments.select("sample", "qname").distinct()
    return names.join(placed.select("sample", "qname").distinct(), ["sample", "qname"], "left_anti")


def unmapped_reads(alignments: DataFrame, both: bool = False) -> DataFrame:
    """Unmapped records, or with ``both`` the records whose mate is unmapped too."""
    bits = fl.UNMAPPED | fl.MATE_UNMAPPED if both else fl.UNMAPPED
    return alignments.filter(F.col("flag").bitwiseAND(F.lit(bits)) == bits)


def read_pool(reads: DataFrame, min_len: int = 20) -> DataFrame:
    """Pairs in one orientation: mate 1 as is, mate 2 reverse-complemented; short or N-bearing pairs dropped whole.

    Only hashed names are shuffled; the reads are kept or dropped where they are read.
    """
    ok = (F.length("seq") >= min_len) & ~F.contains("seq", F.lit("N"))
    mates = F.when(ok & (F.col("mate") == 1), 1).when(ok & (F.col("mate") == 2), 2).otherwise(0)
    named = reads.filter("sample IS NOT NULL AND qname IS NOT NULL")
    names = named.select(*key_hashes("sample", "qname"), mates.alias("_mates")).groupBy("_h1", "_h2").agg(F.bit_or("_mates").alias("_mates"))
    names = checkpoint(names.select("_h1", "_h2", (F.col("_mates") == 3).alias("good")))
    kept = keep_known(reads, ["sample", "qname"], names)
    return kept.select("sample", "qname", "mate", F.when(F.col("mate") == 2, revcomp("seq")).otherwise(F.col("seq")).alias("seq"))


def homologous_regions(paf: DataFrame, min_identity: float = 0.80, min_len: int = 50) -> DataFrame:
    """Host intervals similar to the construct, of the sample or host that the hits belong to."""
    keep = (F.col("identity") >= min_identity) & (F.col("qend") - F.col("qstart") >= min_len)
    return paf.filter(keep).select(*scope(paf), F.col("tname").alias("chrom"), F.col("tstart").alias("start_pos"), F.col("tend").alias("end_pos"))


def in_homology(alignments: DataFrame, regions: DataFrame, slop: int = 500, pos="pos") -> DataFrame:
    """Mapped records whose position lies within ``slop`` of a region (closed ends)."""
    p, own = F.col(pos), [*scope(alignments, regions), "chrom"]
    iv = regions.select(*own, (F.col("start_pos") - slop).alias("_lo"), (F.col("end_pos") + slop).alias("_hi")).distinct()
    mapped = alignments.filter(~flag_is("flag", fl.UNMAPPED))
    return bin_join(mapped, iv, own, (p, p), (F.col("_lo"), F.col("_hi")), (p >= F.col("_lo")) & (p <= F.col("_hi")),
                    width=4096, how="left_semi", salts=4, salt_on=["qname"])


def homology_filter(alignments: DataFrame, regions: DataFrame, slop: int = 500, pos="pos") -> DataFrame:
    """Alignments of the pairs that no homologous region touches."""
    drop = in_homology(alignments, regions, slop, pos).select("sample", "qname").distinct()
    return alignments.join(drop, ["sample", "qname"], "left_anti")


def homology_report(alignments: DataFrame, regions: DataFrame, slop: int = 500, pos="pos") -> DataFrame:
    """Totals per sample: pair total as half of the mapped records, discarded names, retained difference."""
    totals = alignments.filter(~flag_is("flag", fl.UNMAPPED)).groupBy("sample").agg(
        F.floor(F.count(F.lit(1)) / 2).alias("total_pairs"), F.count_distinct("qname").alias("exact_pairs"))
    hit = in_homology(alignments, regions, slop, pos).groupBy("sample", "qname").agg(F.count(F.lit(1)).alias("n"))
    gone = hit.groupBy("sample").agg(F.count(F.lit(1)).alias("discarded_pairs"), F.sum("n").alias("discarded_records"))
    out = totals.join(gone, "sample", "left").na.fill(0, ["discarded_pairs", "discarded_records"])
    return out.withColumns({
        "retained_pairs": F.col("total_pairs") - F.col("discarded_pairs"),
        "discarded_frac": F.col("discarded_pairs") / F.greatest(F.col("total_pairs"), F.lit(1))})


def homology_by_chrom(alignments: DataFrame, regions: DataFrame, slop: int = 500, pos="pos") -> DataFrame:
    return in_homology(alignments, regions, slop, pos).groupBy("sample", "chrom").agg(F.count(F.lit(1)).alias("discarded"))


def phase_reads(alignments: DataFrame, sites: DataFrame, flank: int = 5000, jw: int = 20, min_clip: int = 20, salts: int = 8) -> DataFrame:
    """Class of every pair near a site: ``insertion``, ``wt`` or ``distal``, and whether it is kept.

    ``sites`` has sample, site_id, chrom and one row per junction position ``pos``; a read takes the class of the
    first listed position (``pos_idx``) that decides it.
    """
    from sitewright.functions import clip_left_len, clip_right_len

    off = fl.UNMAPPED | fl.SECONDARY | fl.SUPPLEMENTARY
    reads = alignments.filter(~flag_is("flag", off)).select(
        "sample", "qname", "chrom", "ref_start", "ref_end", clip_left_len("cigar").alias("lc"), clip_right_len("cigar").alias("rc"))
    span = sites.groupBy("sample", "site_id", "chrom").agg(
        (F.min("pos") - flank).alias("_lo"), (F.max("pos") + flank).alias("_hi"),
        F.transform(F.sort_array(F.collect_set(F.struct("pos_idx", "pos"))), lambda x: x["pos"]).alias("_positions"))
    near = bin_join(reads, span, ["sample", "chrom"], (F.col("ref_start"), F.col("ref_end") - 1), (F.col("_lo"), F.col("_hi")),
                    (F.col("ref_start") <= F.col("_hi")) & (F.col("ref_end") > F.col("_lo")), width=8192, salts=salts, salt_on=["qname"])
    s, e = F.col("ref_start"), F.col("ref_end")

    def verdict(pos):
        p = pos - 1
        far = (e < p - jw) | (s > p + jw)
        ins = ((F.col("rc") >= min_clip) & (F.abs(e - p) <= jw)) | ((F.col("lc") >= min_clip) & (F.abs(s - p) <= jw))
        wt = (s <= p - jw) & (e >= p + jw) & (F.col("rc") < min_clip) & (F.col("lc") < min_clip)
        return F.when(far, 0).when(ins, 2).when(wt, 1).otherwise(0)

    first = F.coalesce(F.get(F.filter(F.transform("_positions", verdict), lambda v: v > 0), F.lit(0)), F.lit(0))
    per_pair = near.select("sample", "site_id", "qname", first.alias("v")).groupBy("sample", "site_id", "qname").agg(
        F.max((F.col("v") == 2).cast("int")).alias("ins"), F.max((F.col("v") == 1).cast("int")).alias("wt"))
    kind = F.when(F.col("ins") == 1, "insertion").when(F.col("wt") == 1, "wt").otherwise("distal")
    return per_pair.select("sample", "site_id", "qname", kind.alias("phase"), (kind != "wt").alias("kept"))


def site_read_names(phased: DataFrame, alignments: DataFrame) -> DataFrame:
    """Names taken to assembly: kept local pairs per site, and once per sample (``site_id`` NULL, meant for every
    site of the sample) the pairs with both mates unmapped."""
    lost = unmapped_reads(alignments, both=True).select("sample", F.lit(None).cast("string").alias("site_id"), "qname").distinct()
    return phased.filter("kept").select("sample", "site_id", "qname").unionByName(lost)

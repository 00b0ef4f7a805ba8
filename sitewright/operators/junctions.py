"""Chimeric contigs, junction evidence, verdict and zygosity."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sitewright.functions import calls as fl, clip_left_len, clip_right_len, flag_is, ref_len, zygosity_call
from sitewright.operators.core import bin_join, interval_union

CONTIG = ["sample", "qname"]


def chimeric_junctions(host: DataFrame, construct: DataFrame, min_frac: float = 0.05, min_identity: float = 0.90, min_mapq: int = 10,
                       min_len: int = 50, min_cov: float = 0.5, max_overlap: int = 50) -> DataFrame:
    """Host x construct alignment pairs of one contig that cover different parts of it, with junction geometry."""
    span = F.col("qend") - F.col("qstart")
    ok = (F.col("identity") >= min_identity) & (span >= min_len) & (F.col("aligned_frac") >= min_frac)
    cols = ["qstart", "qend", "strand", "tname", "tlen", "tstart", "tend"]
    h = host.filter(ok & (F.col("mapq") >= min_mapq)).select(*CONTIG, "qlen", *[F.col(c).alias(f"h_{c}") for c in cols], F.col("mapq").alias("host_mapq"), F.col("line_no").alias("h_line"))
    c = construct.filter(ok).select(*CONTIG, *[F.col(x).alias(f"c_{x}") for x in cols], F.col("line_no").alias("c_line"))
    union = interval_union(construct.filter(ok).select(*CONTIG, F.col("qstart").alias("lo"), F.col("qend").alias("hi")), CONTIG, tile=None)
    # overlap of each host alignment with the construct union, and the union's own length
    cover = h.join(union, CONTIG).groupBy(*CONTIG, "h_line").agg(
        F.sum(F.col("hi") - F.col("lo")).alias("union_bp"),
        F.sum(F.greatest(F.lit(0), F.least("h_qend", "hi") - F.greatest("h_qstart", "lo"))).alias("shared_bp"))
    h = h.join(cover, [*CONTIG, "h_line"])
    combined = (F.col("h_qend") - F.col("h_qstart") + F.col("union_bp") - F.col("shared_bp")) / F.col("qlen")
    overlap = F.least("h_qend", "c_qend") - F.greatest("h_qstart", "c_qstart")
    pairs = h.filter(combined >= min_cov).join(c, CONTIG).filter(overlap <= max_overlap)
    return junction_geometry(pairs)


def junction_geometry(pairs: DataFrame) -> DataFrame:
    """Host junction coordinate and border type of host/construct alignment pairs."""
    host_left = F.col("h_qstart") < F.col("c_qstart")
    h_plus, c_plus = F.col("h_strand") == "+", F.col("c_strand") == "+"
    pos = F.when(host_left == h_plus, F.col("h_tend")).otherwise(F.col("h_tstart"))
    at = F.when(host_left == c_plus, F.col("c_tstart")).otherwise(F.col("c_tend"))
    lb, rb = at < F.col("c_tlen") * 0.3, at > F.col("c_tlen") * 0.7
    kind = F.when(lb, "LB").when(rb, "RB").otherwise(F.when(host_left, "LB").otherwise("RB"))
    return pairs.select(
        "sample", F.col("qname").alias("contig"), F.col("qlen").alias("contig_len"), F.col("h_tname").alias("host_chr"), F.col("h_tstart").alias("host_start"),
        F.col("h_tend").alias("host_end"), F.col("h_strand").alias("host_strand"), F.col("c_tname").alias("construct_element"),
        F.col("c_tstart").alias("construct_start"), F.col("c_tend").alias("construct_end"), pos.alias("junction_pos"), kind.alias("junction_type"),
        "host_mapq", "h_line", "c_line")


def junction_confidence(j: DataFrame) -> DataFrame:
    """One confidence per sample: both borders High, one kind Medium."""
    kinds = j.groupBy("sample").agg(F.collect_set("junction_type").alias("_k"))
    conf = F.when(F.array_contains("_k", "LB") & F.array_contains("_k", "RB"), "High").when(F.size("_k") == 1, "Medium").otherwise("Low")
    return j.join(kinds.select("sample", conf.alias("confidence")), "sample")


def rearrangements(j: DataFrame, far: int = 100_000, low_mapq: int = 10) -> DataFrame:
    """Structural warnings: contigs over several chromosomes, distant junctions on one, several low-quality junctions.

    Distant pairs are counted without listing them: with n positions sorted, the pairs over ``far`` apart of a
    contig and chromosome are those of distinct positions weighted by how many junctions share them.
    """
    chroms = j.groupBy("sample", "contig").agg(F.count_distinct("host_chr").alias("n"), F.count(F.lit(1)).alias("k"))
    multi = chroms.filter("k >= 2 AND n > 1").select("sample", "contig", F.lit("multi_chromosome").alias("warning"), F.col("n").alias("detail"))
    spots = j.groupBy("sample", "contig", "host_chr", "junction_pos").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("sample", "contig", "host_chr").orderBy("junction_pos").rangeBetween(Window.unboundedPreceding, -far - 1)
    pairs = spots.withColumn("_p", F.col("_n") * F.sum("_n").over(w)).groupBy("sample", "contig").agg(F.sum("_p").alias("detail"))
    distant = pairs.filter("detail > 0").select("sample", "contig", F.lit("distant_pairs").alias("warning"), "detail")
    low = j.groupBy("sample").agg(F.count_if(F.col("host_mapq") < low_mapq).alias("detail")).filter("detail >= 2").select(
        "sample", F.lit(None).cast("string").alias("contig"), F.lit("low_mapq").alias("warning"), "detail")
    return multi.unionByName(distant).unionByName(low)


def paf_stats(paf: DataFrame) -> DataFrame:
    return paf.groupBy("sample").agg(F.count(F.lit(1)).alias("total_alignments"), F.count_distinct("qname").alias("mapped_contigs"),
                                     F.count_distinct("tname").alias("target_sequences"), F.sum("matches").cast("bigint").alias("total_aligned_bases"))


def amplicon_partners(j: DataFrame, host: DataFrame, construct: DataFrame) -> DataFrame:
    """Longest host alignment on the junction chromosome (else anywhere) and the most complementary construct alignment."""
    a = lambda df, p: df.select("sample", F.col("qname").alias("contig"), F.col("qstart").alias(f"{p}_start"), F.col("qend").alias(f"{p}_end"),
                                F.col("tname").alias(f"{p}_name"), F.col("line_no").alias(f"{p}_line"))
    key = ["sample", "contig", "host_chr", "junction_pos"]
    h = j.select(*key).distinct().join(a(host, "h"), ["sample", "contig"])
    order = F.struct((F.col("h_name") != F.col("host_chr")).alias("other"), (F.col("h_start") - F.col("h_end")).alias("span"), "h_line")
    best = h.groupBy(*key).agg(F.min_by(F.struct("h_start", "h_end"), order).alias("h")).select(*key, "h.*")
    c = best.join(a(construct, "c"), ["sample", "contig"])
    overlap = F.greatest(F.lit(0), F.least("h_end", "c_end") - F.greatest("h_start", "c_start"))
    score = F.col("c_end") - F.col("c_start") - overlap
    pick = F.min_by(F.struct("c_start", "c_end"), F.struct((-score).alias("s"), "c_line"))
    return c.groupBy(*key, "h_start", "h_end").agg(pick.alias("c")).select(*key, "h_start", "h_end", "c.*")


JUNCTION = ["sample", "site_id"]


def junction_evidence(alignments: DataFrame, sites: DataFrame, window: int = 500, salts: int = 8) -> DataFrame:
    """Depth, clipped, split and discordant reads around each site (primary and supplementary records)."""
    hard = lambda f: f("cigar", hard=True)
    reads = alignments.filter(~flag_is("flag", fl.UNMAPPED | fl.SECONDARY)).select(
        "sample", "qname", "chrom", "ref_start", "ref_end", "flag", "has_sa",
        (F.greatest(hard(clip_left_len), hard(clip_right_len)) >= 20).alias("clipped"))
    s, e, p = F.col("ref_start"), F.col("ref_end"), F.col("pos")
    near = bin_join(reads, sites.select(*JUNCTION, "chrom", "pos"), ["sample", "chrom"], (s, e), (F.greatest(F.lit(0), p - window), p + window - 1),
                    (s < p + window) & (e > F.greatest(F.lit(0), p - window)), width=2048, salts=salts, salt_on=["qname"])
    discordant = flag_is("flag", fl.PAIRED) & ~flag_is("flag", fl.PROPER) & ~flag_is("flag", fl.MATE_UNMAPPED)
    counts = near.groupBy(*JUNCTION).agg(
        F.count_if(p.between(s, e)).alias("depth"), F.count_if(F.col("clipped") & ((F.abs(s - p) < 50) | (F.abs(e - p) < 50))).alias("soft_clipped"),
        F.count_if("has_sa").alias("split_reads"), F.count_if(discordant).alias("discordant_pairs"))
    return sites.select(*JUNCTION, "chrom", "pos").join(counts, JUNCTION, "left").na.fill(0, ["depth", "soft_clipped", "split_reads", "discordant_pairs"])


def zygosity_counts(alignments: DataFrame, sites: DataFrame, window: int = 200, min_mapq: int = 10, salts: int = 8) -> DataFrame:
    """Reads that span a junction against reads clipped at it (1-based ``pos``), and the clipped share."""
    reads = alignments.filter(~flag_is("flag", fl.UNMAPPED) & (F.col("mapq") >= min_mapq)).select(
        "sample", "qname", "chrom", (F.col("ref_start") + 1).alias("s"), "flag", "rnext", "pnext", ref_len("cigar").alias("len"),
        clip_left_len("cigar", hard=True).alias("lc"), clip_right_len("cigar", hard=True).alias("rc"))
    reads = reads.withColumn("e", F.col("s") + F.col("len"))
    s, e, p = F.col("s"), F.col("e"), F.col("pos")
    near = bin_join(reads, sites.select(*JUNCTION, "chrom", "pos"), ["sample", "chrom"], (s, e - 1), (p - window, p + window),
                    (s <= p + window) & (e - 1 >= p - window), width=2048, salts=salts, salt_on=["qname"])
    spans = (s < p - 10) & (e > p + 10)
    inner = ((F.col("lc") >= 15) & (F.abs(s - p) < 30)) | ((F.col("rc") >= 15) & (F.abs(e - p) < 30))
    edge = ((F.abs(s - p) < 30) | (F.abs(e - p) < 30)) & ((F.col("lc") >= 15) | (F.col("rc") >= 15))
    odd = flag_is("flag", fl.PAIRED) & ~flag_is("flag", fl.PROPER) & ~flag_is("flag", fl.MATE_UNMAPPED)
    mate = odd & ((F.col("rnext") == "=") | (F.col("rnext") == F.col("chrom"))) & (F.abs(F.col("pnext") - p) < window)
    counts = near.groupBy(*JUNCTION).agg(
        F.count_if(spans & ~inner).alias("spanning"), F.count_if(F.when(spans, inner).otherwise(edge)).alias("clipped"), F.count_if(mate).alias("discordant"))
    out = sites.select(*JUNCTION).join(counts, JUNCTION, "left").na.fill(0, ["spanning", "clipped", "discordant"])
    total = F.col("spanning") + F.col("clipped")
    return out.withColumn("allele_fraction", F.when(total > 0, F.col("clipped") / total).otherwise(0.0))


def call_zygosity(counts: DataFrame) -> DataFrame:
    return counts.withColumn("zygosity", zygosity_call(F.col("spanning") + F.col("clipped"), "allele_fraction"))


def control_reads(sites: DataFrame, control: DataFrame | None, slop: int | None = None) -> DataFrame:
    """Control read names per site: -1 without a control.  By default every control name counts at every site of the
    sample, as in the source rules; ``slop`` counts only names with a record that near."""
    if control is None:
        return sites.withColumn("wt_reads", F.lit(-1).cast("bigint"))
    if slop is None:
        n = control.groupBy("sample").agg(F.count_distinct("qname").alias("wt_reads"))
        return sites.join(n, "sample", "left").na.fill(0, ["wt_reads"])
    p = F.col("ref_start")
    near = bin_join(control.select("sample", "qname", "chrom", "ref_start"), sites.select(*JUNCTION, "chrom", "pos"), ["sample", "chrom"], (p, p),
                    (F.col("pos") - slop, F.col("pos") + slop), F.abs(p - F.col("pos")) <= slop, width=2048, salts=8, salt_on=["qname"])
    n = near.groupBy(*JUNCTION).agg(F.count_distinct("qname").alias("wt_reads"))
    return sites.join(n, JUNCTION, "left").na.fill(0, ["wt_reads"])


def junction_verdict(ev: DataFrame) -> DataFrame:
    """Score the evidence; low mapping quality or many control reads reject outright."""
    tier = lambda c, hi, lo: F.when(F.col(c) >= hi, 2).when(F.col(c) >= lo, 1).otherwise(0)
    drop = (F.col("depth_ratio") > 0) & (F.col("depth_ratio") < 0.3)
    score = (tier("host_mapq", 30, 10) + tier("split_reads", 3, 1) + tier("soft_clipped", 3, 1) + (F.col("discordant_pairs") >= 3).cast("int")
             + drop.cast("int") + (F.col("wt_reads") == 0).cast("int"))
    note = lambda cond, text: F.when(cond, F.lit(text))
    why = F.concat_ws("; ", note(F.col("host_mapq") >= 30, "high mapq"), note(F.col("host_mapq").between(10, 29), "moderate mapq"),
                      note(F.col("split_reads") >= 3, "split reads"), note(F.col("soft_clipped") >= 3, "soft-clipped reads"),
                      note(F.col("discordant_pairs") >= 3, "discordant pairs"), note(drop, "depth drop"), note(F.col("wt_reads") == 0, "no control reads"))
    reject = (F.col("host_mapq") < 5) | (F.col("wt_reads") > 10)
    return ev.withColumns({
        "score": score, "verdict": F.when(reject, "FALSE_POSITIVE").when(score >= 4, "TRUE").otherwise("UNCERTAIN"),
        "reasons": F.when(F.col("host_mapq") < 5, "very low mapq").when(F.col("wt_reads") > 10, "control reads at site").otherwise(why)})

"""Tables behind the reports: assembly statistics, truth matching, rollups, growth study, composition, recall."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitewright.functions import calls as fl, clip_left_len, clip_right_len, flag_is, left_clip_seq, norm_chrom, right_clip_seq
from sitewright.operators.annotations import filter_overlaps
from sitewright.operators.core import before, bin_join, carry, running_total, tile_of, upper_median_agg
from sitewright.operators.reads import primary

# Log line patterns of the assembly-growth study.
ROUND_LINE = r"(?i)Round\s+(\d+)\s+growth:\s*kmer=(\d+),\s*mm2=(\d+),\s*pilon=(\d+),\s*ssake=(\d+)"
SITE_LINE = r"=== Processing (insertion_\S+):"
FINAL_LINE = r"^(insertion_\S+)_assembly_rounds\t(\d+)\s*$"


def contig_stats(contigs: DataFrame, tile: int = 1 << 14) -> DataFrame:
    """Count, total bases and N50 per sample from a length histogram."""
    hist = contigs.groupBy("sample", "length").agg(F.count(F.lit(1)).alias("n"))
    rows = hist.withColumns({"_down": -F.col("length"), "_bp": F.col("n") * F.col("length")})
    totals = rows.groupBy("sample").agg(F.sum("n").alias("num_contigs"), F.sum("_bp").alias("total_bases"))
    cum = running_total(rows.select("sample", "length", "_down", "_bp"), ["sample"], "_down", "_bp", tile, "_cum").join(totals, "sample")
    n50 = cum.filter(F.col("_cum") >= F.col("total_bases") / 2).groupBy("sample").agg(F.max("length").alias("n50"))
    return totals.join(n50, "sample", "left").na.fill(0, ["n50"])


def truth_baseline(alignments: DataFrame, truth: DataFrame, window: int = 100, min_clip: int = 10, salts: int = 8) -> DataFrame:
    """Clip evidence at known positions (sample, chrom, position), zeros where nothing is clipped."""
    reads = primary(alignments).select("sample", "qname", "chrom", "ref_start", "ref_end", clip_left_len("cigar").alias("lc"), clip_right_len("cigar").alias("rc"),
                                       left_clip_seq("cigar", "seq").alias("ls"), right_clip_seq("cigar", "seq").alias("rs"))
    s, e, p = F.col("ref_start"), F.col("ref_end"), F.col("position")
    key = ["sample", "chrom", "position"]
    near = bin_join(reads, truth.select(*key).distinct(), ["sample", "chrom"], (s, e), (F.greatest(F.lit(0), p - window), p + window - 1),
                    (s < p + window) & (e > F.greatest(F.lit(0), p - window)), width=1024, salts=salts, salt_on=["qname"])
    right = (F.col("rc") >= min_clip) & (F.abs(e - p) <= window)
    left = (F.col("lc") >= min_clip) & (s > 0) & (F.abs(s - p) <= window)
    near = near.withColumns({"r_len": F.when(right, F.col("rc")), "l_len": F.when(left, F.col("lc"))})
    cols = [F.count(F.lit(1)).alias("total_reads")]
    for side, n, text in (("right", "r_len", "rs"), ("left", "l_len", "ls")):
        cols += [F.count(n).alias(f"{side}_clip_count"), F.max(n).alias(f"{side}_clip_max_len"), upper_median_agg(n).cast("int").alias(f"{side}_clip_median_len"),
                 F.max(F.when(F.col(n).isNotNull(), F.struct(F.col(n).alias("l"), F.col(text).alias("t"))))["t"].alias(f"{side}_consensus")]
    out = truth.join(near.groupBy(*key).agg(*cols), key, "left")
    numbers = [c for side in ("right", "left") for c in (f"{side}_clip_count", f"{side}_clip_max_len", f"{side}_clip_median_len")]
    return out.na.fill(0, ["total_reads", *numbers]).na.fill("", ["right_consensus", "left_consensus"]).withColumn(
        "found", (F.col("right_clip_count") + F.col("left_clip_count")) > 0)


def baseline_flags(baseline: DataFrame, element_hits: DataFrame, host_clips: DataFrame) -> DataFrame:
    """Element hit and host-map columns of each end (``element_hits``: key + end, element, identity, aln_len; ``host_clips``: key + end)."""
    key = ["sample", "chrom", "position"]
    out = baseline
    for e in ("5p", "3p"):
        h = element_hits.filter(F.col("end") == e).select(*key, F.lit(True).alias(f"element_hit_{e}"), F.col("element").alias(f"element_id_{e}"),
                                                         F.col("identity").alias(f"element_identity_{e}"), F.col("aln_len").alias(f"element_aln_len_{e}"))
        m = host_clips.filter(F.col("end") == e).select(*key, F.lit(True).alias(f"maps_to_host_{e}")).distinct()
        out = out.join(h, key, "left").join(m, key, "left")
        out = out.na.fill(False, [f"element_hit_{e}", f"maps_to_host_{e}"]).na.fill("-", [f"element_id_{e}"]).na.fill(0, [f"element_identity_{e}", f"element_aln_len_{e}"])
    return out


def match_truth(sites: DataFrame, truth: DataFrame | None, runs: DataFrame, tol: int = 0) -> DataFrame:
    """Status per run: HIT with the verdict of the first matching report of the first matching anchor, MISS, no_gt or pending."""
    run = ["sample", "coverage_tag"]
    if truth is None:
        return runs.select(*run, F.lit("pending").alias("gt_anchor_hit"))
    anchors = truth.select("sample", norm_chrom("chrom").alias("_c"), F.col("position").alias("_p"), "truth_idx")
    p = F.col("pos")
    rows = sites.select(*run, norm_chrom("chrom").alias("_c"), "pos", "verdict", "report_idx")
    hit = bin_join(rows, anchors, ["sample", "_c"], (p, p), (F.col("_p") - tol, F.col("_p") + tol), F.abs(p - F.col("_p")) <= tol, width=max(1, 2 * tol + 1))
    best = hit.groupBy(*run).agg(F.min_by(F.coalesce("verdict", F.lit("UNKNOWN")), F.struct("truth_idx", "report_idx")).alias("_v"))
    known = anchors.select("sample").distinct().withColumn("_k", F.lit(True))
    status = F.when(F.col("_k").isNull(), "no_gt").when(F.col("_v").isNull(), "MISS").otherwise(F.concat(F.lit("HIT:"), "_v"))
    return runs.select(*run).join(known, "sample", "left").join(best, run, "left").select(*run, status.alias("gt_anchor_hit"))


def verdict_matrix(sites: DataFrame, truth: DataFrame | None, runs: DataFrame, tol: int = 0) -> DataFrame:
    """Verdict tally per run with truth status and a note on empty runs (``runs``: sample, coverage_tag, has_output)."""
    run = ["sample", "coverage_tag"]
    n = lambda v: F.count_if(F.col("verdict") == v)
    tally = sites.filter("verdict IS NOT NULL").groupBy(*run).agg(
        F.count(F.lit(1)).alias("n_sites_total"), n("CANDIDATE").alias("n_candidate"), n("TRUE_INSERTION").alias("n_true"), n("UNKNOWN").alias("n_unknown"))
    out = runs.join(tally, run, "left").na.fill(0, ["n_sites_total", "n_candidate", "n_true", "n_unknown"]).join(match_truth(sites, truth, runs, tol), run)
    note = F.when(F.col("n_sites_total") > 0, "").when(F.col("has_output"), "pipeline complete, 0 insertion reports").otherwise("no s05 output (pipeline incomplete?)")
    return out.withColumn("notes", note).drop("has_output")


def summarize_verdicts(rows: DataFrame, verdict: str = "verdict") -> DataFrame:
    return rows.groupBy(verdict).agg(F.count(F.lit(1)).alias("n_sites"))


def rollup_sites(stats: DataFrame) -> DataFrame:
    """Sites, candidates and false positives per sample from key/value statistics."""
    verdict = F.endswith("key", F.lit("_verdict"))
    total = F.max(F.when(F.col("key") == "insertion_sites", F.col("value").try_cast("bigint")))
    return stats.groupBy("sample").agg(F.coalesce(total, F.lit(0)).alias("sites"), F.count_if(verdict & (F.col("value") == "CANDIDATE")).alias("candidates"),
                                       F.count_if(verdict & (F.col("value") == "FALSE_POSITIVE")).alias("false_positives"))


def percent(c: str, digits: int = 1) -> Column:
    return F.concat(F.format_string(f"%.{digits}f", F.round(F.col(c) * 100, digits)), F.lit("%"))


def rollup_edits(edits: DataFrame) -> DataFrame:
    return edits.select("sample", "chrom", F.col("pos").alias("position"), F.col("indel_type").alias("type"), "size", "indel_seq", percent("freq").alias("frequency"),
                        F.col("dp").alias("depth"), F.col("cnt").alias("count"), "zygosity", F.col("grna_idx").alias("grna"), "site_type")


def rollup_copies(copies: DataFrame) -> DataFrame:
    return copies.select("sample", F.col("estimated_copies").alias("copy_number"), F.col("construct_median").alias("construct_depth"),
                         F.col("host_median").alias("host_depth"), "marker", "confidence")


def rollup_effects(effects: DataFrame) -> DataFrame:
    where = F.concat("chrom", F.lit(":"), F.col("pos").cast("string"))
    what = F.concat("indel_type", F.lit(" "), F.col("size").cast("string"), F.lit("bp"))
    return effects.select("sample", where.alias("position"), what.alias("variant"), "effect", F.col("gene_id").alias("gene"), "aa_change")


def growth_rows(lines: DataFrame, tile: int = 1 << 16) -> DataFrame:
    """Round lines of assembly logs (file, line_no, value), each with the last site header above it in its file."""
    site, rnd = F.regexp_extract("value", SITE_LINE, 1), F.regexp_extract("value", ROUND_LINE, 1)
    rows = lines.select("file", "line_no", "value", F.nullif(site, F.lit("")).alias("_site"), F.nullif(rnd, F.lit("")).alias("_round"))
    rows = rows.filter("_site IS NOT NULL OR _round IS NOT NULL").withColumn("_tile", tile_of("line_no", tile))
    local = Window.partitionBy("file", "_tile").orderBy("line_no")
    rows = rows.withColumn("_here", F.last("_site", ignorenulls=True).over(local.rowsBetween(Window.unboundedPreceding, 0)))
    rows = carry(rows, ["file"], {"_last": F.max_by("_site", F.when(F.col("_site").isNotNull(), F.col("line_no")))},
                 {"_carry": lambda o: F.last("_last", ignorenulls=True).over(before(o))})
    parts = [F.regexp_extract("value", ROUND_LINE, i).cast("bigint") for i in (2, 3, 4, 5)]
    return rows.filter("_round IS NOT NULL AND _site IS NULL").select("file", F.coalesce("_here", "_carry", F.lit("unknown")).alias("site_id"),
                                                                      F.col("_round").cast("int").alias("round"), sum(parts[1:], parts[0]).alias("growth"))


def round_growth(rows: DataFrame) -> DataFrame:
    """Growth per round with its share of all growth and the cumulative share (few rounds)."""
    per = rows.groupBy("round").agg(F.count(F.lit(1)).alias("n_site_rounds"), F.sum("growth").alias("growth_bp"))
    every = Window.partitionBy(F.lit(1))
    total = F.when(F.sum("growth_bp").over(every) == 0, 1).otherwise(F.sum("growth_bp").over(every))
    cum = F.sum("growth_bp").over(every.orderBy("round"))
    return per.withColumns({"fraction": F.col("growth_bp") / total, "cumulative_fraction": cum / total})


def final_rounds(stat_lines: DataFrame) -> DataFrame:
    """Final assembly round per site from statistics lines (sample, value)."""
    return stat_lines.select("sample", F.regexp_extract("value", FINAL_LINE, 1).alias("site_id"), F.regexp_extract("value", FINAL_LINE, 2).alias("r")).filter(
        "site_id <> ''").select("sample", "site_id", F.col("r").cast("int").alias("final_round"))


def final_round_histogram(finals: DataFrame) -> DataFrame:
    per = finals.groupBy("final_round").agg(F.count(F.lit(1)).alias("n_sites"))
    every = Window.partitionBy(F.lit(1))
    total = F.sum("n_sites").over(every)
    return per.withColumns({"fraction": F.col("n_sites") / total, "cumulative_fraction": F.sum("n_sites").over(every.orderBy("final_round")) / total})


def final_round_samples(finals: DataFrame) -> DataFrame:
    return finals.groupBy("sample").agg(F.count(F.lit(1)).alias("n_sites"), F.max("final_round").alias("max_final_round"))


def composition(hits: DataFrame, sites: DataFrame) -> DataFrame:
    """Annotated bases per category over CANDIDATE inserts, plus what no hit covers."""
    cand = sites.filter("verdict = 'CANDIDATE'")
    per = hits.join(cand.select("sample", "site_id"), ["sample", "site_id"], "left_semi").groupBy("sample", "category").agg(F.sum("length").alias("bp"))
    total = cand.groupBy("sample").agg(F.sum("insert_len").alias("_t"))
    ann = per.groupBy("sample").agg(F.sum("bp").alias("_a"))
    rest = total.join(ann, "sample").select("sample", F.lit("unannotated").alias("category"), (F.col("_t") - F.col("_a")).alias("bp")).filter("bp > 0")
    return per.filter("bp > 0").unionByName(rest)


def site_composition(hits: DataFrame, sites: DataFrame) -> DataFrame:
    """Bases per category and site after the overlap filter, and the uncovered rest, CANDIDATE sites only."""
    cand = sites.filter("verdict = 'CANDIDATE'").select("sample", "site_id", "insert_len")
    mine = hits.join(cand.select("sample", "site_id"), ["sample", "site_id"], "left_semi").withColumnRenamed("site_id", "query")
    kept = filter_overlaps(mine, skip_empty=True).withColumnRenamed("query", "site_id")
    per = kept.groupBy("sample", "site_id", "category").agg(F.sum(F.col("q_end") - F.col("q_start")).alias("bp"))
    ann = per.groupBy("sample", "site_id").agg(F.sum("bp").alias("_a"))
    rest = cand.join(ann, ["sample", "site_id"], "left").select("sample", "site_id", F.lit("unannotated").alias("category"),
                                                                F.greatest(F.lit(0), F.col("insert_len") - F.coalesce("_a", F.lit(0))).alias("bp"))
    return per.unionByName(rest)


def clip_mapq_ratio(alignments: DataFrame, cut: int = 20) -> DataFrame:
    """Share of clipped proper-pair reads under the mapping-quality cut."""
    clipped = alignments.filter(~flag_is("flag", fl.SECONDARY) & flag_is("flag", fl.PROPER) & F.contains("cigar", F.lit("S")))
    low = F.count_if(F.col("mapq") < cut)
    return clipped.groupBy("sample").agg(low.alias("low"), (F.count(F.lit(1)) - low).alias("high"), (low / F.count(F.lit(1))).alias("ratio"))


def compare_runs(new: DataFrame, old: DataFrame, lo: float = 0.80, hi: float = 1.20) -> DataFrame:
    """Positive-site ratio of two runs per sample and whether it lies in the band."""
    n = lambda df, tag: df.groupBy("sample").agg(F.count_if("transgene_positive").alias(tag))
    rows = n(new, "n_new").join(n(old, "n_old"), "sample", "full").na.fill(0)
    ratio = F.when(F.col("n_old") > 0, F.col("n_new") / F.col("n_old")).otherwise(0.0)
    return rows.withColumn("ratio", ratio).withColumn("pass", (F.col("n_old") > 0) & F.col("ratio").between(lo, hi))


def anchor_recall(sites: DataFrame, truth: DataFrame) -> DataFrame:
    """Per truth prefix: first site whose id starts with it and whether its verdict mentions CANDIDATE.

    ``truth`` has sample, anchor (id text after ``insertion_``).  Site ids are cut to the lengths that prefixes have and only cuts that
    are a prefix of the truth are ordered, so a task sorts the few sites that count.  Of sites with one id the smallest verdict counts.
    """
    lens = truth.agg(F.collect_set(F.length("anchor")).alias("_lens"))
    stem = F.regexp_replace("site_id", "^insertion_", "")
    cut = sites.select("sample", "site_id", "verdict", stem.alias("_stem")).crossJoin(lens)
    cut = cut.withColumn("_n", F.explode(F.filter("_lens", lambda n: n <= F.length("_stem"))))
    keyed = cut.select("sample", "site_id", "verdict", F.substring("_stem", F.lit(1), F.col("_n")).alias("anchor"))
    met = keyed.join(truth.select("sample", "anchor").distinct(), ["sample", "anchor"], "left_semi")
    first = met.groupBy("sample", "anchor").agg(F.min(F.struct("site_id", "verdict")).alias("x"))
    out = truth.join(first, ["sample", "anchor"], "left")
    return out.select("sample", "anchor", F.col("x.site_id").alias("site_id"), F.coalesce(F.contains("x.verdict", F.lit("CANDIDATE")), F.lit(False)).alias("pass"))


def recall_total(recall: DataFrame) -> DataFrame:
    return recall.groupBy().agg(F.count_if("pass").alias("passed"), F.count(F.lit(1)).alias("total"))


def candidate_budget(sites: DataFrame, limit: int = 5) -> DataFrame:
    n = F.count_if(F.startswith("verdict", F.lit("CANDIDATE")))
    return sites.groupBy("sample").agg(n.alias("candidates"), (n <= limit).alias("within_budget"))


def tier_counts(tiers: DataFrame, keys=("sample",)) -> DataFrame:
    pos = F.count_if("transgene_positive")
    return tiers.groupBy(*keys).agg(pos.alias("positive"), (F.count(F.lit(1)) - pos).alias("negative"))

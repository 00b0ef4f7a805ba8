"""Evidence of assembled inserts and the verdict table."""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitewright.operators.core import bin_join, covered_bp, interval_union, scope

# Fixed value: rationale codes of a mask and their notes.
RATIONALE = {"X-01": "other >=98% identity endogenous (manual curation)"}


@dataclass(frozen=True)
class VerdictRules:
    """Thresholds of the verdict table and the element triplets that promote a site."""

    cand_host_fraction_max: float = 0.80
    fp_host_fraction_min: float = 0.80
    fp_largest_gap_max: int = 500
    fp_off_target_chrs_min: int = 2
    fp_combined_frac_min: float = 0.85
    fp_construct_frac_min: float = 0.25
    unknown_to_fp_host_fraction_min: float = 0.85
    unknown_to_fp_construct_frac_max: float = 0.05
    canonical_triplets: dict = field(default_factory=dict)


def _oriented(lo: str, hi: str) -> list[Column]:
    return [F.least(lo, hi).cast("bigint").alias("lo"), F.greatest(lo, hi).cast("bigint").alias("hi")]


def build_mask(hits: DataFrame, min_identity: float = 98, min_len: int = 200) -> DataFrame:
    """Host intervals covered by catalogue elements: strand-normalised, 0-based, touching intervals merged,
    distinct element names joined by ``;``.  Hits with a ``host`` give one mask per host."""
    ok = (F.col("pident") >= min_identity) & (F.col("length") >= min_len)
    own = [*(["host"] if "host" in hits.columns else []), "chrom"]
    rows = hits.filter(ok).select(*own, (F.least("sstart", "send") - 1).alias("lo"), F.greatest("sstart", "send").alias("hi"), "element", "pident")
    merged = interval_union(rows, own, extra={"names": F.collect_set("element"), "best": F.max("pident")},
                            merge={"names": F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))), "best": F.max("best")})
    return merged.select(*own, F.col("lo").alias("start_pos"), F.col("hi").alias("end_pos"), F.array_join("names", ";").alias("name"), F.col("best").alias("identity"))


def mask_rationale(mask: DataFrame, host: str, code: str = "X-01") -> DataFrame:
    return mask.select(F.lit(host).alias("host"), F.col("chrom").alias("region_chr"), F.col("start_pos").alias("region_start"),
                       F.col("end_pos").alias("region_end"), F.col("name").alias("element_name"), "identity",
                       (F.col("end_pos") - F.col("start_pos")).alias("length"), F.lit(code).alias("rationale_code"), F.lit(RATIONALE[code]).alias("rationale_note"))


SITE = ["sample", "site_id"]


def host_fraction(inserts: DataFrame, hits: DataFrame, min_identity: float = 90) -> DataFrame:
    """Covered bases, share of the N-free length and largest uncovered gap (both ends included)."""
    rows = hits.filter(F.col("pident") >= min_identity).select(*SITE, *_oriented("qstart", "qend"))
    merged = interval_union(rows, SITE, tile=None)
    w = Window.partitionBy(*SITE).orderBy("lo")
    merged = merged.withColumn("gap", F.col("lo") - F.coalesce(F.lag("hi").over(w), F.lit(0)) - 1)
    cov = merged.groupBy(*SITE).agg(covered_bp(closed=True).alias("host_bp"), F.max("gap").alias("_gap"), F.max("hi").alias("_end"))
    out = inserts.join(cov, SITE, "left")
    eff = F.col("insert_len") - F.col("n_count")
    bp = F.coalesce("host_bp", F.lit(0))
    return out.select(*inserts.columns, bp.alias("host_bp"), F.when(eff > 0, bp / eff).otherwise(0.0).alias("host_fraction"),
                      F.coalesce(F.greatest("_gap", F.col("insert_len") - F.col("_end")), F.col("insert_len")).alias("largest_gap"))


def off_target(inserts: DataFrame, hits: DataFrame, min_identity: float = 98, min_bp: int = 150) -> DataFrame:
    """Foreign chromosomes an insert aligns to, most bases first."""
    bp = hits.filter(F.col("pident") >= min_identity).groupBy(*SITE, F.col("subject").alias("chrom")).agg(F.sum("length").alias("bp"))
    far = bp.join(inserts.select(*SITE, "site_chr"), SITE).filter((F.col("chrom") != F.col("site_chr")) & (F.col("bp") >= min_bp))
    ordered = F.sort_array(F.collect_list(F.struct((-F.col("bp")).alias("k"), "chrom", "bp")))
    return far.groupBy(*SITE).agg(F.transform(ordered, lambda x: F.struct(x["chrom"].alias("chrom"), x["bp"].alias("bp"))).alias("off_target"))


def construct_coverage(inserts: DataFrame, hits: DataFrame, min_identity: float = 80) -> DataFrame:
    """Construct share of the N-free length and the capped sum with the host bases (``inserts`` carries ``host_bp``)."""
    rows = hits.filter(F.col("pident") >= min_identity).select(*SITE, *_oriented("qstart", "qend"))
    cov = interval_union(rows, SITE, tile=None, adjacent=True).groupBy(*SITE).agg(covered_bp(closed=True).alias("construct_bp"))
    eff = F.col("insert_len") - F.col("n_count")
    out = inserts.join(cov, SITE, "left")
    none = F.col("construct_bp").isNull()
    return out.select(*inserts.columns,
                      F.when((eff <= 0) | none, 0.0).otherwise(F.col("construct_bp") / eff).alias("construct_frac"),
                      F.when(eff <= 0, 0.0).when(none, F.col("host_fraction")).otherwise(
                          F.least(F.lit(1.0), (F.col("construct_bp") + F.col("host_bp")) / eff)).alias("combined_frac"))


def flanking_regions(hits: DataFrame, min_identity: float = 95, min_len: int = 50, edge: int = 100) -> DataFrame:
    """Host regions similar to a construct end; ``region_idx`` keeps input order."""
    near = (F.col("qstart") <= edge) | (F.col("qend") >= F.col("qlen") - edge)
    ok = (F.col("pident") >= min_identity) & (F.col("length") >= min_len) & near
    return hits.filter(ok).select(*scope(hits), "chrom", *_oriented("sstart", "send"), "region_idx")


def site_flanking(sites: DataFrame, regions: DataFrame, slop: int = 500) -> DataFrame:
    """First region (input order) whose slop-expanded closed interval holds the site; distinct positions meet distinct regions."""
    p, own = F.col("site_pos"), [*scope(sites, regions), "chrom"]
    r = regions.select(*own, (F.col("lo") - slop).alias("flank_lo"), (F.col("hi") + slop).alias("flank_hi"), "region_idx")
    r = r.groupBy(*own, "flank_lo", "flank_hi").agg(F.min("region_idx").alias("region_idx"))
    rows = sites.withColumn("chrom", F.col("site_chr")).select(*dict.fromkeys([*SITE, *own, "site_pos"]))
    spots = rows.select(*own, "site_pos").distinct()
    hit = bin_join(spots, r, own, (p, p), (F.col("flank_lo"), F.col("flank_hi")), (p >= F.col("flank_lo")) & (p <= F.col("flank_hi")), width=4096)
    best = F.min_by(F.struct("chrom", F.col("flank_lo").alias("lo"), F.col("flank_hi").alias("hi")), "region_idx").alias("flanking_hit")
    there = hit.groupBy(*own, "site_pos").agg(best, F.min("region_idx").alias("_first"))
    return rows.join(there, [*own, "site_pos"]).groupBy(*SITE).agg(F.min_by("flanking_hit", "_first").alias("flanking_hit"))


def element_copies(hits: DataFrame) -> DataFrame:
    """Copies and strands of each element on each insert."""
    strand = F.when(F.col("sstart") < F.col("send"), "+").otherwise("-")
    return hits.groupBy(*SITE, "element").agg(F.count(F.lit(1)).alias("copies"), F.array_join(F.array_sort(F.collect_set(strand)), "").alias("strands"))


def structure(copies: DataFrame, min_name: int = 30) -> DataFrame:
    """Arrangement of the insert from its element copies."""
    flip = F.max((F.col("strands") == "+-") & (F.length("element") > min_name))
    per = copies.groupBy(*SITE).agg(flip.alias("flip"), F.sum("copies").alias("n"), F.max("copies").alias("top"))
    label = F.when(F.col("flip"), "head-to-head 2-copy T-DNA").when(
        (F.col("n") > 3) & (F.col("top") >= 2), F.concat(F.lit("multi-copy (≥"), F.col("top").cast("string"), F.lit(" copies)"))).otherwise("single-copy")
    return per.select(*SITE, label.alias("structure"))


def triplet_match(matched: Column, rules: VerdictRules) -> Column:
    """Name of the first configured triplet fully inside ``matched``, else NULL."""
    out = F.lit(None).cast("string")
    for name, parts in reversed(list(rules.canonical_triplets.items())):
        if parts:
            full = F.size(F.array_except(F.array(*[F.lit(p) for p in sorted(parts)]), matched)) == 0
            out = F.when(full, F.lit(name)).otherwise(out)
    return out


def build_evidence(inserts: DataFrame, copies: DataFrame, endogenous: DataFrame, host_hits: DataFrame, construct_hits: DataFrame,
                   regions: DataFrame) -> DataFrame:
    """One evidence row per insert.  Inserts whose elements are all host-endogenous keep zero evidence."""
    endo = endogenous.select(F.col("qseqid").alias("element"), F.lit(True).alias("_endo"))
    elements = copies.join(endo, "element", "left").groupBy(*SITE).agg(
        F.array_sort(F.collect_set("element")).alias("elements"),
        F.array_sort(F.collect_set(F.when(F.col("_endo"), F.col("element")))).alias("host_endogenous_elements"))
    rows = inserts.join(elements, SITE, "left").withColumns({
        "elements": F.coalesce("elements", F.array().cast("array<string>")),
        "host_endogenous_elements": F.coalesce("host_endogenous_elements", F.array().cast("array<string>"))})
    skip = (F.size("elements") > 0) & (F.size("elements") == F.size("host_endogenous_elements"))
    needed = rows.filter(~skip).select(*inserts.columns)
    hf = host_fraction(needed, host_hits)
    cc = construct_coverage(hf, construct_hits)
    out = rows.join(cc.drop("site_chr", "site_pos", "insert_len", "n_count"), SITE, "left").join(
        off_target(needed, host_hits), SITE, "left").join(site_flanking(needed, regions), SITE, "left")
    zero = {"host_bp": F.lit(0).cast("bigint"), "host_fraction": F.lit(0.0), "largest_gap": F.lit(0).cast("bigint"), "construct_frac": F.lit(0.0), "combined_frac": F.lit(0.0)}
    return out.withColumns({c: F.coalesce(F.col(c), z) for c, z in zero.items()}).withColumn(
        "n_off_target", F.coalesce(F.size("off_target"), F.lit(0))).withColumn("matched_canonical", F.col("elements"))


def verdict(ev: DataFrame, rules: VerdictRules = VerdictRules()) -> DataFrame:
    """First matching rule decides; adds ``verdict``, ``rule`` and ``reason``.

    ``ev``: elements, host_endogenous_elements, matched_canonical, flanking_hit, site_chr, site_pos, n_off_target and the fractions.
    """
    hf, cf, n = F.col("host_fraction"), F.col("construct_frac"), F.size("elements")
    triplet = triplet_match(F.col("matched_canonical"), rules)
    flank = F.col("flanking_hit")
    in_flank = flank.isNotNull() & ((F.col("site_chr") == "") | (flank["chrom"] == F.col("site_chr"))) & F.col("site_pos").between(flank["lo"], flank["hi"])
    all_endo = (n > 0) & (F.size(F.array_except("elements", "host_endogenous_elements")) == 0)
    pct = lambda c: F.concat(F.format_string("%.0f", c * 100), F.lit("%"))
    fp, cand = "FALSE_POSITIVE", "CANDIDATE"
    table = [
        ("1", triplet.isNotNull() & (hf < rules.cand_host_fraction_max), cand, F.concat(F.lit("canonical triplet "), triplet, F.lit(", host "), pct(hf))),
        ("1.5", all_endo, fp, F.lit("all annotated elements are host-endogenous")),
        ("2", in_flank, fp, F.lit("site lies in a construct-flanking host region")),
        ("3", F.col("n_off_target") >= rules.fp_off_target_chrs_min, fp, F.concat(F.lit("chimeric: "), F.col("n_off_target").cast("string"), F.lit(" off-target chromosomes"))),
        ("4", (cf >= rules.fp_construct_frac_min) & (F.col("combined_frac") >= rules.fp_combined_frac_min), fp,
         F.concat(F.lit("construct "), pct(cf), F.lit(" and host explain the insert"))),
        ("5", (hf >= rules.fp_host_fraction_min) & (F.col("largest_gap") < rules.fp_largest_gap_max), fp, F.concat(F.lit("host "), pct(hf), F.lit(" without a foreign gap"))),
        ("6", n > 0, cand, F.concat(n.cast("string"), F.lit(" element(s) annotated, host "), pct(hf))),
        ("7", (hf >= rules.unknown_to_fp_host_fraction_min) & (cf <= rules.unknown_to_fp_construct_frac_max), fp, F.concat(F.lit("no elements, host "), pct(hf))),
    ]
    out = F.struct(F.lit("UNKNOWN").alias("verdict"), F.lit("8").alias("rule"), F.lit("no element annotations").alias("reason"))
    for rule, cond, label, why in reversed(table):
        out = F.when(cond, F.struct(F.lit(label).alias("verdict"), F.lit(rule).alias("rule"), why.alias("reason"))).otherwise(out)
    return ev.withColumn("_v", out).select(*ev.columns, "_v.*")


def canonical_override(sites: DataFrame, rules: VerdictRules) -> DataFrame:
    """Promote an existing verdict when a triplet matches and the host share allows it."""
    hit = (triplet_match(F.col("elements"), rules).isNotNull()) & (F.col("host_fraction") < rules.cand_host_fraction_max)
    return sites.withColumn("verdict", F.when(hit, "CANDIDATE").otherwise(F.col("verdict")))


def promote_unknown(sites: DataFrame, min_borders: int = 4, min_gap: int = 1000) -> DataFrame:
    """UNKNOWN with enough border motifs and a long foreign gap becomes CANDIDATE_LOW_CONF."""
    up = (F.col("verdict") == "UNKNOWN") & (F.col("n_borders") >= min_borders) & (F.col("largest_gap") >= min_gap)
    return sites.withColumn("verdict", F.when(up, "CANDIDATE_LOW_CONF").otherwise(F.col("verdict")))


# Title words of vector records in a top-hit review.
TRUE_TITLES = ["agrobacterium", "t-dna", "vector", "plasmid"]


def classify_top_hit(hits: DataFrame, host_words: list[str], min_identity: float = 85) -> DataFrame:
    """Review class of each query from its best hit (bit score, then input order)."""
    title = F.lower("title")
    top = F.min_by(F.struct("title", "pident"), F.struct((-F.col("bitscore")).alias("b"), "line_no"))
    rows = hits.groupBy("sample", "qseqid").agg(top.alias("t")).select("sample", "qseqid", "t.*")
    label = (F.when(F.col("title").isNull() | (F.col("pident") < min_identity), "CANDIDATE")
             .when(title.rlike("|".join(w.lower() for w in host_words)), "FALSE_POSITIVE")
             .when(title.rlike("|".join(TRUE_TITLES)), "TRUE_INSERTION").otherwise("CANDIDATE"))
    return rows.select("sample", "qseqid", "title", "pident", label.alias("classification"))

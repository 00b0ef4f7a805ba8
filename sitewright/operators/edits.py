"""Pileups, indel calls, case-control subtraction and variant effects."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitewright.functions import (
    calls as fl, cigar_blocks, flag_is, freq_gt, freq_zygosity, gt_zygosity, is_crispr_candidate, nhej, pam_motif, revcomp, translate_codon,
)
from sitewright.functions.sequence import literal_map
from sitewright.operators.core import TILE, before, bin_join, carry, scope, tile_of
from sitewright.operators.reference import fetch_ref
from sitewright.session import checkpoint

SPOT = ["sample", "chrom", "pos"]
BIN = 1024
BASES = ["A", "T", "G", "C", "DEL", "INS"]


def pileup_events(alignments: DataFrame, regions: DataFrame | None = None, min_mapq: int = 10, orphans: bool = False) -> DataFrame:
    """One row per read and event: bases and deleted bases at their position, insertions and deletions at the base before
    (1-based positions).  Reads of broken pairs are skipped unless ``orphans``.  Equal alignments are spread out once, with
    their number as ``copies``."""
    off = fl.UNMAPPED | fl.SECONDARY | fl.QC_FAIL | fl.DUPLICATE
    reads = alignments.filter(~flag_is("flag", off) & (F.col("mapq") >= min_mapq))
    if not orphans:
        reads = reads.filter(~flag_is("flag", fl.PAIRED) | flag_is("flag", fl.PROPER))
    reads = reads.groupBy("sample", "chrom", "ref_start", "ref_end", "cigar", "seq").agg(F.count(F.lit(1)).alias("copies"))
    reads = reads.withColumn("_rbin", F.lit(None).cast("bigint"))
    if regions is not None:
        # a read is taken once per region bin it reaches and later emits only the events of that bin
        covered = regions.select("chrom", F.explode(F.sequence(F.floor(F.col("lo") / BIN), F.floor(F.col("hi") / BIN))).alias("_rbin")).distinct()
        spans = F.sequence(F.floor(F.col("ref_start") / BIN), F.floor(F.col("ref_end") / BIN))
        reads = reads.withColumn("_rbin", F.explode(spans)).join(covered, ["chrom", "_rbin"], "left_semi")
    blocks = reads.select("sample", "chrom", "ref_start", "seq", "copies", "_rbin", F.explode(cigar_blocks("cigar", "ref_start")).alias("b"))
    op, r, n = F.col("b.op"), F.col("b.r"), F.col("b.len")
    inner = r > F.col("ref_start")
    # plain numbers are exploded and the base is cut afterwards: arrays of event rows cost several times as much
    base, gone, extra = op.isin("M", "=", "X"), (op == "D") & inner, (op == "I") & inner
    first = F.when(gone, F.lit(-1)).otherwise(0)
    last = F.when(base | gone, n - 1).otherwise(0)
    blocks = blocks.filter((base & (n > 0)) | gone | extra).select("sample", "chrom", "_rbin", "copies", "seq", op.alias("op"), r.alias("r"), n.alias("n"), F.col("b.q").alias("q"),
                                                  F.explode(F.sequence(first, last)).alias("i"))
    op, r, n, q, i = (F.col(c) for c in ("op", "r", "n", "q", "i"))
    marker, gap = (op == "D") & (i < 0), (op == "D") & (i >= 0)
    rows = blocks.select("sample", "chrom", "_rbin", "copies", (r + F.when(op == "I", 0).otherwise(i + 1)).alias("pos"),
                         F.when(marker, "L").when(gap, "D").when(op == "I", "I").otherwise("B").alias("kind"),
                         F.when(op == "I", F.upper(F.substring("seq", q + 1, n))).when(op != "D", F.upper(F.substring("seq", q + i + 1, F.lit(1)))).alias("text"),
                         F.when(marker | (op == "I"), n).otherwise(1).alias("len"))
    if regions is not None:
        p = F.col("pos")
        rows = rows.filter(F.floor(p / BIN) == F.col("_rbin"))
        rows = bin_join(rows, regions.select("chrom", "lo", "hi").distinct(), ["chrom"], (p, p), (F.col("lo"), F.col("hi")),
                        p.between(F.col("lo"), F.col("hi")), width=4096, how="left_semi")
    return rows.drop("_rbin")


def pileup(events: DataFrame) -> DataFrame:
    """Counts per position: A, C, G, T, N, deleted bases, insertions after the base, depth."""
    k, t = F.col("kind"), F.col("text")
    n = lambda cond: F.sum(F.when(cond, F.col("copies")).otherwise(0))
    base = lambda x: n((k == "B") & (t == x)).alias(x)
    return events.groupBy(*SPOT).agg(*[base(x) for x in "ATGCN"], n(k == "D").alias("DEL"), n(k == "I").alias("INS"),
                                     n(k.isin("B", "D")).alias("dp"))


def indel_counts(events: DataFrame, ref: DataFrame) -> DataFrame:
    """Insertion and deletion sequences per position with their counts and the depth; deleted text comes from the reference.

    The reads are walked once: the counted events are a stage from which both the indels and the depth are taken.
    """
    base = F.col("kind").isin("B", "D")
    spectrum = checkpoint(events.groupBy(*SPOT, F.when(base, "B").otherwise(F.col("kind")).alias("kind"), F.when(base, 1).otherwise(F.col("len")).alias("len"),
                                         F.when(base, "").otherwise(F.coalesce("text", F.lit(""))).alias("text")).agg(F.sum("copies").alias("cnt")))
    raw = spectrum.filter("kind <> 'B'")
    at = [*scope(raw, ref), "chrom", "pos", "len"]
    wins = raw.select(*at).distinct().withColumns({"lo": F.col("pos") - 1, "hi": F.col("pos") + F.col("len")})
    seqs = fetch_ref(wins, ref, at)
    depth = spectrum.filter("kind = 'B'").select(*SPOT, F.col("cnt").alias("dp"))
    rows = raw.join(seqs, at, "left").join(depth, SPOT, "left")
    deleted = F.col("kind") == "L"
    return rows.select(*SPOT, F.when(deleted, "deletion").otherwise("insertion").alias("indel_type"),
                       F.when(deleted, F.substring("ref_seq", F.lit(2), F.col("len"))).otherwise(F.col("text")).alias("indel_seq"), "cnt",
                       F.coalesce("dp", F.lit(0)).alias("dp"), F.substring("ref_seq", 1, 1).alias("ref_base"))


def pileup_indels(c) -> Column:
    """Array of (indel_type, indel_seq) in a pileup text: read-start marks with their quality character go first, then every
    sign with a length takes that many of the letters after it."""
    text = F.regexp_replace(c if isinstance(c, Column) else F.col(c), r"\^.", "")
    pat = r"([+-])(\d+)([A-Za-z*]*)"
    part = lambda g: F.regexp_extract_all(text, F.lit(pat), F.lit(g))
    zipped = F.arrays_zip(part(1).alias("s"), part(2).alias("n"), part(3).alias("t"))
    return F.transform(zipped, lambda x: F.struct(
        F.when(x["s"] == "+", "insertion").otherwise("deletion").alias("indel_type"),
        F.substring(x["t"], F.lit(1), x["n"].cast("int")).alias("indel_seq")))


def indel_calls(counts: DataFrame, min_freq: float = 0.1) -> DataFrame:
    """Calls over the frequency gate with alleles, quality, genotype and zygosity."""
    freq = F.col("cnt") / F.col("dp")
    rows = counts.filter(F.col("dp") > 0).withColumn("freq", freq).filter(F.col("freq") >= min_freq)
    deleted = F.col("indel_type") == "deletion"
    longer = F.concat("ref_base", "indel_seq")
    return rows.withColumns({
        "size": F.length("indel_seq"), "ref": F.when(deleted, longer).otherwise(F.col("ref_base")), "alt": F.when(deleted, F.col("ref_base")).otherwise(longer),
        "qual": F.least(F.col("freq") * F.col("dp") * 10, F.lit(999.0)), "gt": freq_gt("freq"), "zygosity": freq_zygosity("freq")})


def modification_profile(treat: DataFrame, control: DataFrame, ref: DataFrame, targets: DataFrame, window: int = 30) -> DataFrame:
    """Base frequencies of both pileups and the non-reference share within ``window`` of each cut."""
    key = scope(targets, treat, control)
    at = [*key, "chrom", "pos"]
    spots = targets.select(*[c for c in scope(targets, ref) if c not in key], *key, "chrom", "cut_pos", F.explode(F.sequence(F.greatest(F.lit(1).cast("bigint"), F.col("cut_pos") - window), F.col("cut_pos") + window)).alias("pos"))
    there = [*scope(spots, ref), "chrom", "pos"]
    wins = spots.select(*there).distinct().withColumns({"lo": F.col("pos") - 1, "hi": F.col("pos")})
    base = fetch_ref(wins, ref, there, "ref_base")
    side = lambda df, tag: df.select(*at, *[F.col(b).alias(f"{tag}_{b}") for b in [*BASES, "dp"]])
    rows = spots.join(side(treat, "t"), at, "left").join(side(control, "c"), at, "left").join(base, there, "left")
    n = lambda tag, b: F.coalesce(F.col(f"{tag}_{b}"), F.lit(0))
    floor = lambda tag: F.greatest(n(tag, "dp"), F.lit(1))
    cols = [(n(tag, b) / floor(tag)).alias(f"{tag}_{b.lower()}") for tag in "tc" for b in BASES]
    ref_n = F.coalesce(*[F.when((F.col("ref_base") == b) & F.col("t_dp").isNotNull(), n("t", b)) for b in "ATGC"], F.lit(0))
    return rows.select(*key, "chrom", "cut_pos", "pos", *cols, (1.0 - ref_n / floor("t")).alias("modified"))


INDEL = ["chrom", "pos", "indel_type", "indel_seq"]


def without_control(treat: DataFrame, control: DataFrame, key: list[str]) -> DataFrame:
    """Treatment rows whose ``key`` no control row has.

    A treatment table with ``control_sample`` is held against the rows of that sample only, one without against all
    of ``control``; tables with a ``host`` are compared within it.
    """
    paired = "control_sample" in treat.columns
    own = [F.col("sample").alias("control_sample")] if paired else []
    on = [*(["control_sample"] if paired else []), *[c for c in scope(treat, control) if c == "host"], *key]
    return treat.join(control.select(*own, *[c for c in on if c != "control_sample"]).distinct(), on, "left_anti")


def edits_at_targets(treat: DataFrame, control: DataFrame, targets: DataFrame, window: int = 50, min_size: int = 1) -> DataFrame:
    """Treatment calls near a cut site that the control does not share."""
    own = without_control(treat, control, INDEL).filter(F.col("size") >= min_size)
    p, key = F.col("pos"), [*scope(own, targets), "chrom"]
    t = targets.select(*key, "grna_idx", "site_type", "mismatches", "cut_pos", F.greatest(F.lit(1), F.col("cut_pos") - window).alias("_lo"), (F.col("cut_pos") + window).alias("_hi"))
    hit = bin_join(own, t, key, (p, p), (F.col("_lo"), F.col("_hi")), p.between(F.col("_lo"), F.col("_hi")), width=1024)
    return hit.drop("_lo", "_hi").withColumn("distance_to_cut", F.abs(p - F.col("cut_pos")))


def specific_indels(treat: DataFrame, control: DataFrame, min_size: int = 2) -> DataFrame:
    """Treatment indels whose alleles the control lacks."""
    key = ["chrom", "pos", "ref", "alt"]
    big = F.col("size") >= min_size
    return without_control(treat.filter(big), control.filter(big), key)


def nearest_junction(indels: DataFrame, junctions: DataFrame, tile: int = TILE) -> DataFrame:
    """Nearest junction of the same chromosome per indel position, earlier file row on ties; -1 and empty id when none."""
    key = [*scope(indels, junctions), "chrom"]
    j = junctions.groupBy(*key, "pos").agg(F.min("line_no").alias("line_no"))
    marks = j.select(*key, "pos", F.struct("pos", "line_no").alias("_j")).unionByName(
        indels.select(*key, "pos").distinct().withColumn("_j", F.lit(None).cast("struct<pos:bigint,line_no:bigint>")))
    rows = marks.withColumn("_tile", tile_of("pos", tile))
    w = Window.partitionBy(*key, "_tile").orderBy("pos").rangeBetween(Window.unboundedPreceding, 0)
    v = Window.partitionBy(*key, "_tile").orderBy("pos").rangeBetween(0, Window.unboundedFollowing)
    rows = rows.withColumn("_lo", F.max("_j").over(w)).withColumn("_hi", F.min("_j").over(v))
    after = lambda o: o.rowsBetween(1, Window.unboundedFollowing)
    rows = carry(rows, key, {"_max": F.max("_j"), "_min": F.min("_j")},
                 {"_below": lambda o: F.max("_max").over(before(o)), "_above": lambda o: F.min("_min").over(after(o))})
    lo, hi = F.coalesce("_lo", "_below"), F.coalesce("_hi", "_above")
    near = lambda x: F.when(x.isNotNull(), F.struct(F.abs(F.col("pos") - x["pos"]).alias("d"), x["line_no"].alias("l"), x["pos"].alias("p")))
    best = rows.filter("_j IS NULL").select(*key, "pos", F.least(near(lo), near(hi)).alias("_b"))
    best = best.select(*key, "pos", F.coalesce("_b.d", F.lit(-1)).alias("distance_to_junction"),
                       F.coalesce(F.concat("chrom", F.lit(":"), F.col("_b.p").cast("string")), F.lit("")).alias("nearest_junction"))
    return indels.join(best, [*key, "pos"])


def annotate_indels(indels: DataFrame, ref: DataFrame, min_qual: float = 20) -> DataFrame:
    """PAM near the indel, repair signature, candidate flag and genotype zygosity."""
    at = [*scope(indels, ref), "chrom", "pos"]
    wins = indels.select(*at).distinct().withColumns({"lo": F.greatest(F.lit(1), F.col("pos") - 8) - 1, "hi": F.col("pos") + 8})
    rows = indels.join(fetch_ref(wins, ref, at, "_w"), at, "left")
    rows = rows.withColumn("pam_motif", F.coalesce(pam_motif("_w"), F.lit(""))).drop("_w")
    rows = rows.withColumns({"has_pam": F.col("pam_motif") != "", "nhej_signature": nhej("indel_type", "size"), "zygosity": gt_zygosity("gt")})
    return rows.withColumn("crispr_candidate", is_crispr_candidate("has_pam", "nhej_signature", "qual", min_qual))


def edit_summary(edits: DataFrame) -> DataFrame:
    return edits.groupBy().agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("site_type") == "on-target").alias("on_target"),
                               F.count_if(F.col("site_type") == "off-target").alias("off_target"))


def top_candidates(edits: DataFrame, n: int = 20) -> DataFrame:
    return edits.filter("crispr_candidate").orderBy(F.desc("qual"), "chrom", "pos", "indel_type", "indel_seq").limit(n)


# ---- gene models ----

def gene_models(features: DataFrame) -> DataFrame:
    """One row per gene with its sorted distinct CDS, exon and UTR intervals, children resolved through their transcript."""
    key = [*scope(features), "chrom"]
    genes = features.filter("ftype = 'gene'").select(*key, F.col("id").alias("gene_id"), F.col("start_pos").alias("g_start"), F.col("end_pos").alias("g_end"), "strand")
    mrna = features.filter("ftype = 'mRNA'").select(*key, F.col("id").alias("parent"), F.col("parent").alias("_gene")).distinct()
    kids = features.filter(F.col("ftype").isin("CDS", "exon", "five_prime_UTR", "three_prime_UTR")).join(mrna, [*key, "parent"], "left")
    kids = kids.select(*key, F.coalesce("_gene", "parent").alias("gene_id"), "ftype", F.struct(F.col("start_pos").alias("s"), F.col("end_pos").alias("e"), F.coalesce("phase", F.lit(0)).alias("ph")).alias("iv"))
    pick = lambda cond: F.array_sort(F.collect_set(F.when(cond, F.col("iv"))))
    flat = lambda a: F.array_distinct(F.transform(a, lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))
    kinds = kids.groupBy(*key, "gene_id").agg(pick(F.col("ftype") == "CDS").alias("cds"), flat(pick(F.col("ftype") == "exon")).alias("exons"),
                                                flat(pick(F.endswith("ftype", F.lit("UTR")))).alias("utrs"))
    out = genes.join(kinds, [*key, "gene_id"], "left")
    empty = {"cds": "array<struct<s:bigint,e:bigint,ph:int>>", "exons": "array<struct<s:bigint,e:bigint>>", "utrs": "array<struct<s:bigint,e:bigint>>"}
    return out.withColumns({c: F.coalesce(F.col(c).cast(t), F.array().cast(t)) for c, t in empty.items()})


def _own_models(points: DataFrame, features: DataFrame) -> DataFrame:
    """Gene models without the cohort keys that ``points`` lacks."""
    return gene_models(features).drop(*[c for c in scope(features) if c not in points.columns])


def gene_context(points: DataFrame, features: DataFrame, flank: int = 10_000) -> DataFrame:
    """Genes within ``flank`` of each region (point_id, chrom, r_start, r_end), with the child intervals that reach into it."""
    lo, hi = F.col("r_start") - flank, F.col("r_end") + flank
    hit = bin_join(points.withColumns({"_lo": lo, "_hi": hi}), _own_models(points, features), [*scope(points, features), "chrom"], (F.col("_lo"), F.col("_hi")), (F.col("g_start"), F.col("g_end")),
                   (F.col("g_end") >= F.col("_lo")) & (F.col("g_start") <= F.col("_hi")), width=16384)
    near = lambda c: F.filter(c, lambda x: (x["e"] >= F.col("_lo")) & (x["s"] <= F.col("_hi")))
    return hit.withColumns({c: near(c) for c in ("cds", "exons", "utrs")}).drop("_lo", "_hi")


def location_in_gene(pos, cds="cds", exons="exons", start="g_start", end="g_end") -> Column:
    p = F.col(pos)
    inside = lambda arr: F.exists(arr, lambda x: p.between(x["s"], x["e"]))
    return F.when(inside(cds), "CDS").when(inside(exons), "UTR").when(p.between(F.col(start), F.col(end)), "intron").otherwise("intergenic")


def junction_location(points: DataFrame, features: DataFrame, flank: int = 10_000) -> DataFrame:
    """Location of a junction (``pos``) against its best gene: CDS, UTR, intron, else intergenic."""
    rows = gene_context(points.withColumns({"r_start": F.col("pos"), "r_end": F.col("pos")}), features, flank)
    rank = literal_map({"CDS": 0, "UTR": 1, "intron": 2, "intergenic": 3})
    best = rows.withColumn("location", location_in_gene("pos")).groupBy("point_id").agg(F.min_by("location", rank[F.col("location")]).alias("location"))
    return points.join(best, "point_id", "left").withColumn("location", F.coalesce("location", F.lit("intergenic")))


def _transcript(cds: str, strand: str) -> Column:
    """Coding intervals in transcript order, each with the bases ahead of it (``c``), their total length and the first one's phase."""
    ordered = F.when(F.col(strand) == "+", F.col(cds)).otherwise(F.reverse(cds))
    size = lambda x: x["e"] - x["s"] + 1
    seed = F.struct(F.lit(0).cast("bigint").alias("n"), F.array().cast("array<struct<s:bigint,e:bigint,c:bigint>>").alias("o"))
    return F.aggregate(ordered, seed, lambda acc, x: F.struct(
        (acc["n"] + size(x)).alias("n"), F.array_append(acc["o"], F.struct(x["s"].alias("s"), x["e"].alias("e"), acc["n"].alias("c"))).alias("o")),
        lambda acc: F.struct(acc["n"].alias("n"), F.get(ordered, F.lit(0))["ph"].cast("bigint").alias("ph"), acc["o"].alias("o")))


def cds_context(variants: DataFrame, features: DataFrame) -> DataFrame:
    """Gene of each variant position: one with a CDS hit first, else the first gene; NULLs outside genes."""
    p = F.col("pos")
    own = scope(variants, features)
    models = _own_models(variants, features).withColumn("tx", _transcript("cds", "strand"))
    hit = bin_join(variants.select("var_id", *own, "chrom", "pos"), models, [*own, "chrom"], (p, p), (F.col("g_start"), F.col("g_end")),
                   p.between(F.col("g_start"), F.col("g_end")), width=16384)
    coding = F.col("location") == "CDS"
    on = F.get(F.filter("cds", lambda x: p.between(x["s"], x["e"])), F.lit(0))
    # gene models go along only where they are needed
    hit = hit.withColumn("location", location_in_gene("pos")).withColumns({"hit_cds": F.when(coding, on), "tx": F.when(coding, F.col("tx"))})
    order = F.struct((F.col("location") != "CDS").alias("a"), "g_start", "gene_id")
    best = hit.groupBy("var_id").agg(F.min_by(F.struct("gene_id", "strand", "location", "tx", "hit_cds"), order).alias("g"))
    return variants.join(best.select("var_id", "g.*"), "var_id", "left")


# Three-letter amino acid names.
AA_NAMES = {
    "A": "Ala", "C": "Cys", "D": "Asp", "E": "Glu", "F": "Phe", "G": "Gly", "H": "His", "I": "Ile", "K": "Lys", "L": "Leu", "M": "Met",
    "N": "Asn", "P": "Pro", "Q": "Gln", "R": "Arg", "S": "Ser", "T": "Thr", "V": "Val", "W": "Trp", "Y": "Tyr", "*": "Stop",
}


def variant_effect(context: DataFrame, ref: DataFrame) -> DataFrame:
    """Effect of each variant from its CDS index; ``context`` comes from :func:`cds_context`.

    The index comes from the bases ahead of the interval in transcript order, summed once per gene.  The reference text of
    a minus-strand codon is taken in transcript order and reverse-complemented once more, as the source rules do.
    """
    p, plus = F.col("pos"), F.col("strand") == "+"
    inside = F.get(F.filter("tx.o", lambda x: p.between(x["s"], x["e"])), F.lit(0))
    rows = context.withColumn("_at", F.when(F.col("location") == "CDS", inside)).withColumns(
        {"_raw": F.col("_at.c") + F.when(plus, p - F.col("_at.s")).otherwise(F.col("_at.e") - p), "_ph": F.col("tx.ph")}).withColumns(
        {"_idx": F.col("_raw") - F.col("_ph"), "_n": F.col("tx.n") - F.col("_ph")})
    place = lambda raw, x: F.when(plus, x["s"] + raw - x["c"]).otherwise(x["e"] - raw + x["c"])
    holds = lambda raw, x: (raw >= x["c"]) & (raw <= x["c"] + x["e"] - x["s"])

    def genomic(k: str) -> Column:
        raw = F.col(k) + F.col("_ph")
        # nearly always in the interval of the variant itself
        return F.when(holds(raw, F.col("_at")), place(raw, F.col("_at"))).when(
            raw.isNotNull(), place(raw, F.get(F.filter("tx.o", lambda x: holds(raw, x)), F.lit(0))))

    idx, n, size = F.col("_idx"), F.col("_n"), F.col("size")
    snv = ~F.col("indel_type").isin("deletion", "insertion")
    valid = idx >= 0
    codon0 = idx - idx % 3
    deletion = (F.col("indel_type") == "deletion") & (size % 3 == 0) & (n > idx + size)
    first = F.when(snv & (codon0 + 3 <= n), codon0).when(deletion, idx)
    last = F.when(snv, codon0 + 2).otherwise(F.least(idx + size + 2, n - 1))
    splice = F.exists("tx.o", lambda x: (F.abs(p - x["s"]) <= 2) | (F.abs(p - x["e"]) <= 2))
    rows = rows.withColumns({"_k0": F.when(valid, first), "_k1": F.when(valid & snv, codon0 + 1), "_k2": F.when(valid & first.isNotNull(), last)})
    rows = rows.withColumns({"_g0": genomic("_k0"), "_g1": genomic("_k1"), "_g2": genomic("_k2"), "_splice": F.when(F.col("location") == "CDS", splice)})
    # written once without the gene models; rows that need no reference text are not joined
    rows = checkpoint(rows.drop("tx", "hit_cds", "_at", "_raw", "_ph", "_k0", "_k1", "_k2"))
    read = rows.filter("_g0 IS NOT NULL")
    wins = read.select("var_id", *scope(rows, ref), "chrom", (F.least("_g0", "_g2") - 1).alias("lo"), F.greatest("_g0", "_g2").alias("hi"))
    read = read.join(fetch_ref(wins, ref, ["var_id"], "_ref"), "var_id", "left")
    rows = read.unionByName(rows.filter("_g0 IS NULL").withColumn("_ref", F.lit(None).cast("string")))
    base = lambda g: F.substring("_ref", (F.col(g) - F.least("_g0", "_g2") + 1).cast("int"), F.lit(1))
    raw_codon = F.concat(base("_g0"), base("_g1"), base("_g2"))
    codon = F.when(plus, raw_codon).otherwise(revcomp(raw_codon, strict=True))
    alt = F.right("alt", F.lit(1))
    alt = F.when(plus, alt).otherwise(revcomp(alt, strict=True))
    rows = rows.withColumns({"_codon": F.when(snv & F.col("_g0").isNotNull(), codon), "_off": (idx % 3).cast("int")})
    changed = F.concat(F.substring("_codon", F.lit(1), F.col("_off")), alt, F.substring("_codon", F.col("_off") + 2, F.lit(3)))
    rows = rows.withColumn("_alt", F.when(F.col("_codon").isNotNull(), changed)).withColumns(
        {"_a": translate_codon("_codon"), "_b": translate_codon("_alt"), "_aa": (F.floor(idx / 3) + 1)})
    in_cds = F.col("location") == "CDS"
    effect = (F.when(F.col("location").isNull(), "intergenic").when(~in_cds, F.col("location")).when(~F.coalesce(valid, F.lit(False)), "CDS_boundary")
              .when(~snv & (size % 3 != 0), "frameshift").when(F.col("indel_type") == "deletion", "in-frame_deletion").when(~snv, "in-frame_insertion")
              .when(F.col("_codon").isNull(), "CDS_boundary").when(F.col("_a") == F.col("_b"), "synonymous").when(F.col("_b") == "*", "stop_gained")
              .when(F.col("_a") == "*", "stop_lost").otherwise("nonsynonymous"))
    rows = rows.withColumn("effect", effect)
    name = lambda c: F.coalesce(literal_map(AA_NAMES)[F.col(c)], F.col(c))
    at = F.col("_aa").cast("string")
    gone = F.when(plus, F.col("_ref")).otherwise(revcomp("_ref", strict=True))
    lost = F.array_join(F.transform(F.filter(F.sequence(F.lit(1), F.greatest(F.length(gone) - 2, F.lit(1)), F.lit(3)), lambda i: i + 2 <= F.length(gone)),
                                    lambda i: translate_codon(F.substring(gone, i, F.lit(3)))), "")
    aas = F.floor(size / 3).cast("string")
    change = (F.when(F.col("effect") == "in-frame_insertion", F.concat(F.lit("ins "), aas, F.lit("aa")))
              .when((F.col("effect") == "in-frame_deletion") & F.col("_ref").isNotNull(), F.concat(F.lit("del "), aas, F.lit("aa ("), lost, F.lit(")")))
              .when(F.col("effect") == "in-frame_deletion", F.concat(F.lit("del "), aas, F.lit("aa")))
              .when(F.col("effect") == "synonymous", F.concat(F.lit("p."), name("_a"), at, F.lit("=")))
              .when(F.col("effect") == "stop_gained", F.concat(F.lit("p."), name("_a"), at, F.lit("*")))
              .when(F.col("effect") == "stop_lost", F.concat(F.lit("p.*"), at, name("_b")))
              .when(F.col("effect") == "nonsynonymous", F.concat(F.lit("p."), name("_a"), at, name("_b"))).otherwise(""))
    shown = ~F.col("effect").isin("intergenic", "UTR", "intron", "CDS_boundary")
    return rows.select("var_id", "chrom", "pos", F.coalesce("gene_id", F.lit("")).alias("gene_id"), "effect", change.alias("aa_change"),
                       F.coalesce(F.when(snv, F.col("_codon")), F.lit("")).alias("codon_ref"), F.coalesce("_alt", F.lit("")).alias("codon_alt"),
                       F.when(shown, F.col("_aa")).otherwise(0).cast("bigint").alias("aa_pos"), F.coalesce("_splice", F.lit(False)).alias("near_splice"))

"""Decision columns: flags, zygosity, repair signature, PAM, copy class."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from sitewright.functions.sequence import _col

UNMAPPED, MATE_UNMAPPED, PROPER, PAIRED = 4, 8, 2, 1
SECONDARY, QC_FAIL, DUPLICATE, SUPPLEMENTARY = 256, 512, 1024, 2048


def flag_is(c, bit: int) -> Column:
    return _col(c).bitwiseAND(F.lit(bit)) != 0


def freq_gt(freq) -> Column:
    f = _col(freq)
    return F.when(f >= 0.85, "1/1").when(f >= 0.2, "0/1").otherwise("0/0")


def freq_zygosity(freq) -> Column:
    f = _col(freq)
    return F.when(f >= 0.85, "homozygous").when(f >= 0.2, "heterozygous").otherwise("low-frequency")


def gt_zygosity(gt) -> Column:
    """Zygosity from genotype text, phased or not."""
    g = F.coalesce(_col(gt), F.lit("."))
    alleles = F.split(F.replace(g, F.lit("|"), F.lit("/")), "/")
    one = F.size(F.array_distinct(alleles)) == 1
    return (
        F.when(~g.rlike(r"[/|]"), "unknown")
        .when(one & (F.get(alleles, F.lit(0)) != "0"), "homozygous")
        .when(~F.array_contains(alleles, "0"), "biallelic")
        .otherwise("heterozygous")
    )


def nhej(kind, size) -> Column:
    k, s = _col(kind), _col(size)
    return ((k == "deletion") & s.between(1, 20)) | ((k == "insertion") & s.between(1, 5))


def pam_and_type(strand, pam_seq, mismatches, start, end) -> Column:
    """Struct has_pam, site_type, cut_pos of one guide hit (0-based half-open target)."""
    plus = _col(strand) == "+"
    pam = F.upper(_col(pam_seq))
    has = (F.length(pam) >= 3) & F.when(plus, F.substring(pam, 2, 2) == "GG").otherwise(F.substring(pam, 1, 2) == "CC")
    exact = _col(mismatches) == 0
    kind = F.when(exact & has, "on-target").when(exact, "on-target-no-PAM").otherwise("off-target")
    cut = F.when(plus, _col(end) - 3).otherwise(_col(start) + 3)
    return F.struct(has.alias("has_pam"), kind.alias("site_type"), cut.alias("cut_pos"))


def pam_motif(window) -> Column:
    """PAM text found around the middle of a 17 bp window, empty if none."""
    w = F.upper(_col(window))
    return (
        F.when((F.length(w) >= 14) & (F.substring(w, 13, 2) == "GG"), F.concat(F.substring(w, 12, 3), F.lit("(+)")))
        .when(F.substring(w, 3, 2) == "CC", F.concat(F.substring(w, 3, 3), F.lit("(-)")))
        .otherwise("")
    )


def is_crispr_candidate(has_pam, nhej_col, qual, min_qual: float = 20) -> Column:
    return _col(has_pam) & _col(nhej_col) & (_col(qual) >= min_qual)


def zygosity_call(total, af) -> Column:
    t, a = _col(total), _col(af)
    return (
        F.when(t < 5, "uncertain").when(a >= 0.8, "homozygous").when(a.between(0.3, 0.65), "heterozygous")
        .when(a > 0.65, "likely_homozygous").when((a < 0.3) & (a > 0.1), "likely_heterozygous").otherwise("uncertain")
    )


def copies_rounded(ratio) -> Column:
    r = _col(ratio)
    return (
        F.when(r < 0.25, F.bround(r, 2)).when(r < 0.75, 1.0).when(r < 1.25, 1.0).when(r < 1.75, 2.0)
        .otherwise(F.bround(r, 1))
    )


def copy_class(ratio) -> Column:
    r = _col(ratio)
    return (
        F.when(r < 0.25, "low-level / mosaic").when(r < 0.75, "hemizygous single-copy")
        .when(r < 1.25, "homozygous single-copy (or 2 hemizygous copies)").when(r < 1.75, "likely 2-3 copies")
        .otherwise(F.format_string("multi-copy (~%.1fx)", F.bround(r, 1)))
    )

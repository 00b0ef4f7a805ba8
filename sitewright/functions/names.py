"""Column functions over element names, catalogue headers and titles."""
from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from sitewright.functions.sequence import _col, literal_map

SRC_MARK = "|src="

# Rank of each source tag; tags that are not listed rank 0.
SRC_TIERS = {"element_db": 2, "payload": 2, "sample_contig": 2, "univec": 1}

# Name fragments of each element class.
PROMOTER = ["promoter", "p-35s", "p-e35s", "p-fmv", "p-nos", "p-ocs", "p-ubi", "p-act1", "p-ta29", "p-csvmv",
            "p-ssuara", "p-cdpk", "p-rice_actin", "p-fmv34s"]
TERMINATOR = ["terminator", "t-nos", "t-35s", "t-e9", "t-ocs", "t-pcambia", "t-pinii", "nos_ter", "polya"]
BORDER = ["lb-tdna", "rb-tdna", "left_border", "right_border"]
BORDER_SUFFIX = ["-lb", "-rb"]
INTRON = ["intron", "i-hsp", "ivs", "enhancer", "aint", "adh1"]
INSULATOR = ["insulator", "mar", "sar", "scaffold_attachment", "rb7", "matrix_attachment"]
TRANSIT = ["ctp", "transit", "signal_peptide", "chloroplast_transit"]
CODING = ["nptii", "bar", "pat", "hpt", "aada", "cp4-epsps", "epsps", "cry1", "cry2", "cry3", "gus", "barnase",
          "barstar", "thaumatin", "gat", "dsred", "mepsps", "cat-f", "rerio"]
REGULATORY = ["border", "ori", "backbone"]
CONSTRUCT = ["ql-con", "qt-con", "construct-specific"]
ELEMENT = ["ql-ele", "qt-ele", "element-specific"]
EVENT = ["ql-eve", "qt-eve", "event-specific"]
TAXON = ["ql-tax", "qt-tax", "taxon-specific"]
VECTOR = ["univec", "vector"]

# Title words that mark a vector or plasmid record.
VECTOR_TITLES = ["vector", "plasmid", "cloning", "pbi", "pcambia", "pbluescript", "puc", "pgem", "pet-", "pbr322",
                 "pgreen", "pbin", "psoup", "binary vector", "shuttle vector", "expression vector", "t-dna",
                 "transformation vector", "construct", "recombinant plasmid"]
MAX_ELEMENT_LENGTH = 8000

# Method-type words, then method-code infixes, and the scope each stands for.
SCOPE_WORDS = [("event", "event-specific"), ("construct", "construct-specific"), ("element", "element-specific"),
               ("taxon", "taxon-specific"), ("species", "taxon-specific"), ("plant", "plant-specific")]
SCOPE_INFIXES = [("-EVE-", "event-specific"), ("-CON-", "construct-specific"), ("-ELE-", "element-specific"),
                 ("-TAX-", "taxon-specific"), ("-PLN-", "plant-specific"), ("-BAC-", "bacterial-control")]


def any_of(words) -> str:
    """Regular expression matching any of the fragments literally."""
    return "|".join(re.escape(w).replace(r"\_", "_") for w in words)


def _first_match(name: Column, rules, otherwise) -> Column:
    out = None
    for test, label in rules:
        cond = name.rlike(test) if isinstance(test, str) else test
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(otherwise)


def classify_element(c) -> Column:
    """13-way element class; rules are tried in order."""
    n = F.lower(_col(c))
    suffix = "(?:%s)$" % any_of(BORDER_SUFFIX)
    return _first_match(n, [
        (any_of(PROMOTER), "promoter"), (any_of(TERMINATOR), "terminator"), (any_of(BORDER), "border"),
        (suffix, "border"), (any_of(INTRON), "intron"), (any_of(INSULATOR), "insulator"),
        (any_of(TRANSIT), "transit"), (any_of(CODING), "coding"), (any_of(REGULATORY), "regulatory"),
        (any_of(CONSTRUCT), "construct"), (any_of(ELEMENT), "element"), (any_of(EVENT), "event"),
        (any_of(TAXON), "taxon"),
    ], F.lit("unknown"))


def classify_element_summary(c) -> Column:
    """Summary variant: short names without a pipe count as construct-specific."""
    c = _col(c)
    n = F.lower(c)
    plain = (~F.contains(c, F.lit("|"))) & (F.length(c) < 60)
    return _first_match(n, [
        (any_of(PROMOTER), "promoter"), (any_of(TERMINATOR), "terminator"), (any_of(BORDER), "border"),
        ("(?:%s)$" % any_of(BORDER_SUFFIX), "border"), (any_of(CODING), "cds"), (any_of(INTRON), "marker"),
        (any_of(CONSTRUCT), "construct-specific"), (any_of(ELEMENT), "element-specific"),
        (any_of(EVENT), "event-specific"), (any_of(VECTOR), "vector"), (plain, "construct-specific"),
    ], F.lit("unknown"))


def header_part(c, i: int, fallback: int | None = None) -> Column:
    """Part ``i`` of a pipe header; without it, the first ``fallback`` characters of the whole text (or NULL)."""
    c = _col(c)
    part = F.get(F.split(c, r"\|"), F.lit(i))
    return part if fallback is None else F.coalesce(part, F.substring(c, 1, fallback))


def strip_src_tag(c) -> Column:
    c = _col(c)
    at = F.instr(c, SRC_MARK)
    return F.when(at > 0, F.substring(c, F.lit(1), at - 1)).otherwise(c)


def src_tag(c, default: str = "") -> Column:
    """Text after the first ``|src=``."""
    c = _col(c)
    at = F.instr(c, SRC_MARK)
    return F.when(at > 0, F.substring(c, at + len(SRC_MARK), F.length(c))).otherwise(F.lit(default))


def parse_src_tag(c, default: str = "") -> Column:
    return F.struct(strip_src_tag(c).alias("accession"), src_tag(c, default).alias("src_tag"))


def src_tier(c, tiers: dict | None = None) -> Column:
    return F.coalesce(literal_map(tiers or SRC_TIERS)[_col(c)], F.lit(0))


def safe_token(c, cap: int | None = 80) -> Column:
    """Header-safe text: separators and blanks to ``_``, quotes dropped, empty text to ``NA``."""
    c = F.regexp_replace(_col(c), r"[|/\\]", "_")
    c = F.regexp_replace(c, "['\"]", "")
    c = F.regexp_replace(F.regexp_replace(c, r"^\s+|\s+$", ""), r"\s+", "_")
    if cap:
        c = F.substring(c, 1, cap)
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("NA"))


def element_header(element_class, header_id, organism, accession, boundary, version: str = "canonical_v1") -> Column:
    rule = F.substring(F.replace(F.replace(_col(boundary), F.lit(" "), F.lit("_")), F.lit(";"), F.lit("")), 1, 80)
    return F.concat_ws("|", _col(element_class), _col(header_id), _col(organism), _col(accession), rule, F.lit(version))


def target_scope(method_type, code) -> Column:
    t = F.lower(F.coalesce(_col(method_type), F.lit("")))
    code = F.coalesce(_col(code), F.lit(""))
    rules = [(F.contains(t, F.lit(w)), s) for w, s in SCOPE_WORDS]
    rules += [(F.contains(code, F.lit(w)), s) for w, s in SCOPE_INFIXES]
    return _first_match(t, rules, F.lit(""))


def is_vector(title, length) -> Column:
    return F.lower(_col(title)).rlike(any_of(VECTOR_TITLES)) | (_col(length) > MAX_ELEMENT_LENGTH)

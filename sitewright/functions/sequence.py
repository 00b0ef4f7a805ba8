"""Column functions over nucleotide text."""
from __future__ import annotations

import sys
from itertools import product
from math import log

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Nearest-neighbour enthalpy (kcal/mol) and entropy (cal/mol/K), SantaLucia 1998.
NN_ENTHALPY = {
    "AA": -7.9, "TT": -7.9, "AT": -7.2, "TA": -7.2, "CA": -8.5, "TG": -8.5, "GT": -8.4, "AC": -8.4,
    "CT": -7.8, "AG": -7.8, "GA": -8.2, "TC": -8.2, "CG": -10.6, "GC": -9.8, "GG": -8.0, "CC": -8.0,
}
NN_ENTROPY = {
    "AA": -22.2, "TT": -22.2, "AT": -20.4, "TA": -21.3, "CA": -22.7, "TG": -22.7, "GT": -22.4, "AC": -22.4,
    "CT": -21.0, "AG": -21.0, "GA": -22.2, "TC": -22.2, "CG": -27.2, "GC": -24.4, "GG": -19.9, "CC": -19.9,
}
NN_UNKNOWN = (-7.5, -21.0)
NN_INITIATION = (0.2, -5.7)
SALT_TERM = 0.368
GAS_CONSTANT = 1.987
KELVIN = 273.15

# The standard genetic code, amino acids in TCAG codon order.
CODON_BASES = "TCAG"
CODON_AMINO_ACIDS = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"

# IUPAC degenerate codes and the bases they stand for.
IUPAC = {
    "R": "AG", "Y": "CT", "S": "GC", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG",
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def revcomp(c, strict: bool = False) -> Column:
    """Reverse complement; ``strict`` upper-cases and turns every other letter into N."""
    c = _col(c)
    if strict:
        c = F.regexp_replace(F.upper(c), "[^ACGTN]", "N")
    return F.reverse(F.translate(c, "ACGTacgt", "TGCAtgca"))


def gc(c) -> Column:
    """GC fraction, 0 for empty text."""
    up = F.upper(_col(c))
    n = F.length(up)
    hits = n - F.length(F.translate(up, "GC", ""))
    return F.when(n > 0, hits / n).otherwise(F.lit(0.0))


def has_run(c, n: int = 4) -> Column:
    return F.upper(_col(c)).rlike(r"(.)\1{%d}" % (n - 1))


def tm_nn(c, oligo_nm: float = 250.0, na_mm: float = 50.0) -> Column:
    """Nearest-neighbour melting temperature; text under 10 bases gives 0.

    A batch of texts is summed position by position, so every sum adds its terms from left to right.
    """
    letters = "ACGT?"
    enthalpy, entropy = (np.array([t.get(a + b, u) for a in letters for b in letters]) for t, u in zip((NN_ENTHALPY, NN_ENTROPY), NN_UNKNOWN))
    salt, strand = log(na_mm / 1000.0), GAS_CONSTANT * log(oligo_nm * 1e-9 / 4.0)
    initiation, term, kelvin = NN_INITIATION, SALT_TERM, KELVIN

    @F.pandas_udf("double")
    def melt(texts: pd.Series) -> pd.Series:
        known = texts.notna().to_numpy()
        n = texts.str.len().fillna(0).to_numpy(dtype=np.int64)
        order = np.argsort(-n, kind="stable")
        size = n[order]
        first = (np.cumsum(n) - n)[order]
        points = np.frombuffer("".join(texts[known]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        code = np.full(len(points), 4, dtype=np.int64)
        for i, x in enumerate("ACGT"):
            code[points == ord(x)] = i
        dh, ds = np.zeros(len(n)), np.zeros(len(n))
        for i in range(int(size[0]) - 1 if len(size) else 0):
            live = int(np.searchsorted(-size, -(i + 1)))  # the texts, longest first, with a pair at i
            at = first[:live] + i
            pair = code[at] * 5 + code[at + 1]
            dh[:live] += enthalpy[pair]
            ds[:live] += entropy[pair]
        dh += initiation[0]
        ds = ds + initiation[1] + term * (size - 1) * salt
        out = np.empty(len(n))
        out[order] = np.where(size < 10, 0.0, dh * 1000.0 / (ds + strand) - kelvin)
        return pd.Series(out).where(known)

    return melt(F.upper(_col(c)))


def iupac_regex(c) -> Column:
    """Regular expression text that a degenerate primer stands for."""
    out = F.upper(_col(c))
    out = F.regexp_replace(out, "([%s])" % "".join(IUPAC), "<$1>")
    for code, bases in IUPAC.items():
        out = F.replace(out, F.lit(f"<{code}>"), F.lit(f"[{bases}]"))
    return out


def clean_seq(c) -> Column:
    return F.upper(F.regexp_replace(_col(c), "[^A-Za-z]", ""))


def eff_len(c) -> Column:
    """Length without Ns."""
    c = _col(c)
    return F.length(c) - (F.length(c) - F.length(F.translate(c, "Nn", "")))


def n_gaps(c, min_gap: int = 10) -> Column:
    """Array of half-open [start, end) structs, one per run of at least ``min_gap`` Ns."""
    # stretches of N and of other letters alternate, so one linear match covers the text
    parts = F.regexp_extract_all(F.upper(_col(c)), F.lit("(N+|[^N]+)"), F.lit(1))
    seed = F.struct(
        F.lit(0).alias("at"),
        F.array().cast("array<struct<start:int,end:int>>").alias("gaps"),
    )

    def step(acc, x):
        end = acc["at"] + F.length(x)
        gap = F.startswith(x, F.lit("N")) & (F.length(x) >= min_gap)
        return F.struct(
            end.alias("at"),
            F.when(gap, F.array_append(acc["gaps"], F.struct(acc["at"].alias("start"), end.alias("end")))).otherwise(acc["gaps"]).alias("gaps"),
        )

    return F.aggregate(parts, seed, step, lambda acc: acc["gaps"])


def norm_chrom(c) -> Column:
    return F.regexp_replace(_col(c), r"\.\d+$", "")


def codon_table() -> dict:
    codons = ("".join(t) for t in product(CODON_BASES, repeat=3))
    return dict(zip(codons, CODON_AMINO_ACIDS))


def translate_codon(c) -> Column:
    """One-letter amino acid by position in TCAG order, ``?`` for anything unknown."""
    c = _col(c)
    index = F.lit(0)
    for i in (1, 2, 3):
        index = index * 4 + F.instr(F.lit(CODON_BASES), F.substring(c, i, 1)) - 1
    known = c.rlike("^[ACGT]{3}$")
    return F.when(known, F.substring(F.lit(CODON_AMINO_ACIDS), index + 1, F.lit(1))).otherwise(F.lit("?"))

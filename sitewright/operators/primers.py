"""Primer choice and junction amplicons."""
from __future__ import annotations

import sys
from math import log

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from sitewright.functions.sequence import GAS_CONSTANT, KELVIN, NN_ENTHALPY, NN_ENTROPY, NN_INITIATION, NN_UNKNOWN, SALT_TERM

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Primer lengths, window step, GC bands tried in order, target temperature.
LENGTHS = (18, 25)
STEP = 5
GC_BANDS = [(0.35, 0.65), (0.25, 0.75)]
TARGET_TM = 60.0
# Oligo concentration (nM) and sodium (mM) of the melting temperature.
OLIGO_NM, NA_MM = 250.0, 50.0
PICKED = "fwd_primer string, fwd_tm double, fwd_gc double, fwd_pos int, rev_primer string, rev_tm double, rev_gc double, rev_pos int"
_SWAP = str.maketrans("ACGT", "TGCA")


def _choose(texts: list[str], limits: np.ndarray, forward: bool) -> list[tuple | None]:
    """(primer, temperature, GC fraction, position) of each upper-case text, None where no window yields a primer.

    The windows of all texts are tried step by step; a text leaves with its first window that holds a primer.
    """
    sizes = np.arange(LENGTHS[0], LENGTHS[1] + 1)
    most = sizes[-1]
    n = np.array([len(x) for x in texts], dtype=np.int64)
    base = np.concatenate([[0], np.cumsum(n)])
    letters = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    code = np.full(len(letters), 4, dtype=np.int64)
    for i, x in enumerate("ACGT"):
        code[letters == ord(x)] = i
    up_to = lambda flags: np.concatenate([[0], np.cumsum(flags)])
    strong, unknown = up_to((code == 1) | (code == 2)), up_to(letters == ord("N"))
    same = np.zeros(len(letters), dtype=bool)  # three equal letters follow
    if len(letters) > 3:
        same[:-3] = (letters[:-3] == letters[1:-2]) & (letters[1:-2] == letters[2:-1]) & (letters[2:-1] == letters[3:])
    runs = up_to(same)
    values = lambda table, other: np.array([table.get(a + b, other) for a in "ACGT?" for b in "ACGT?"])
    dh, ds = values(NN_ENTHALPY, NN_UNKNOWN[0]), values(NN_ENTROPY, NN_UNKNOWN[1])
    last = np.minimum(limits, n - most) - 1
    out: list[tuple | None] = [None] * len(texts)
    rows, w = np.nonzero(last >= 0)[0], 0
    while len(rows):
        # half-open span of every candidate in the joined letters, one column per length
        if forward:
            lo = np.repeat((base[rows] + w)[:, None], len(sizes), axis=1)
            hi = lo + sizes
        else:
            hi = np.repeat((base[rows] + n[rows] - w)[:, None], len(sizes), axis=1)
            lo = hi - sizes
        share = (strong[hi] - strong[lo]) / sizes
        band = np.full(share.shape, len(GC_BANDS))
        for i, (low, high) in reversed(list(enumerate(GC_BANDS))):
            band[(share >= low) & (share <= high)] = i
        band[(unknown[hi] > unknown[lo]) | (runs[hi - 3] > runs[lo])] = len(GC_BANDS)
        best = band.min(axis=1)
        hit = np.nonzero(best < len(GC_BANDS))[0]
        if len(hit):
            if forward:
                primer = code[lo[hit, -1][:, None] + np.arange(most)]
            else:
                back = code[hi[hit, -1][:, None] - 1 - np.arange(most)]
                primer = np.where(back < 4, 3 - back, 4)
            pair = primer[:, :-1] * 5 + primer[:, 1:]
            sum_h = np.cumsum(dh[pair], axis=1)[:, sizes - 2] + NN_INITIATION[0]
            sum_s = np.cumsum(ds[pair], axis=1)[:, sizes - 2] + NN_INITIATION[1] + SALT_TERM * (sizes - 1) * log(NA_MM / 1000.0)
            tm = sum_h * 1000.0 / (sum_s + GAS_CONSTANT * log(OLIGO_NM * 1e-9 / 4.0)) - KELVIN
            off = np.where(band[hit] == best[hit][:, None], np.abs(tm - TARGET_TM), np.inf)
            for j, k in enumerate(off.argmin(axis=1)):  # the first of equals is the shorter one
                i = rows[hit[j]]
                a, b = lo[hit[j], k] - base[i], hi[hit[j], k] - base[i]
                text = texts[i][a:b]
                out[i] = (text if forward else text.translate(_SWAP)[::-1], float(tm[j, k]), float(share[hit[j], k]), int(w if forward else n[i] - w))
        w += STEP
        rows = np.delete(rows, hit)
        rows = rows[last[rows] >= w]
    return out


def _with_primers(amplicons: DataFrame) -> DataFrame:
    """Adds both primers to each amplicon row; rows without one of them drop out."""
    names = amplicons.columns

    def pick(batches):
        for pdf in batches:
            pdf = pdf[pdf["amplicon_seq"].notna() & pdf["junction_offset"].notna()]
            texts, off = [x.upper() for x in pdf["amplicon_seq"]], pdf["junction_offset"].to_numpy(dtype=np.int64)
            n = np.array([len(x) for x in texts], dtype=np.int64)
            fwd, rev = _choose(texts, off, True), _choose(texts, n - off, False)
            both = [i for i, (f, r) in enumerate(zip(fwd, rev)) if f and r]
            found = pd.DataFrame([fwd[i] + rev[i] for i in both], columns=[c.split()[0] for c in PICKED.split(", ")])
            yield pd.concat([pdf.iloc[both].reset_index(drop=True), found], axis=1)

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in amplicons.select(*names).schema)
    return amplicons.mapInPandas(pick, f"{kinds}, {PICKED}")


def pick_primers(amplicons: DataFrame, keys: list[str]) -> DataFrame:
    """Forward and reverse primer of each amplicon (``amplicon_seq``, ``junction_offset``, one row per key): the first window from
    the edge that yields one; inside a window the tighter GC band first, then the closest temperature, then the shorter primer."""
    return _with_primers(amplicons.select(*keys, "amplicon_seq", "junction_offset")).drop("amplicon_seq", "junction_offset")


def frame_amplicons(junctions: DataFrame, target: int = 200, least: int = 150) -> DataFrame:
    """Breakpoint and framed sequence on each contig (``seq``, h_start/h_end, c_start/c_end); too short ones drop out."""
    half = target // 2
    hs, he, cs, ce = (F.col(c) for c in ("h_start", "h_end", "c_start", "c_end"))
    mid = lambda a, b: F.floor((a + b) / 2).cast("int")
    at = F.when(he <= cs, mid(he, cs)).when(ce <= hs, mid(ce, hs)).otherwise(mid(F.greatest(hs, cs), F.least(he, ce)))
    side = F.when(he <= cs, "left").when(ce <= hs, "right").otherwise(F.when(hs < cs, "left").otherwise("right"))
    rows = junctions.withColumns({"_at": at, "host_region": side, "_n": F.length("seq")})
    rows = rows.withColumns({"_a": F.greatest(F.lit(0), F.col("_at") - half), "_b": F.least("_n", F.col("_at") + half)})
    short = F.col("_b") - F.col("_a") < least
    moved = F.when(short & (F.col("_a") > 0), F.greatest(F.lit(0), F.col("_a") - (least - (F.col("_b") - F.col("_a"))))).otherwise(F.col("_a"))
    rows = rows.withColumn("_a", moved)
    rows = rows.withColumn("_b", F.when(F.col("_b") - F.col("_a") < least, F.least("_n", F.col("_a") + least)).otherwise(F.col("_b")))
    rows = rows.filter(F.col("_b") - F.col("_a") >= least)
    return rows.withColumns({"amplicon_seq": F.substring(F.col("seq"), F.col("_a") + 1, F.col("_b") - F.col("_a")), "junction_offset": F.col("_at") - F.col("_a")})


def design_amplicons(junctions: DataFrame, keys: list[str], target: int = 200, least: int = 150) -> DataFrame:
    """Amplicons across the junction of chimeric contigs, trimmed from primer to primer."""
    framed = frame_amplicons(junctions, target, least)
    rows = _with_primers(framed.select(*keys, "host_region", "amplicon_seq", "junction_offset"))
    size = F.col("rev_pos") - F.col("fwd_pos")
    return rows.select(*keys, "host_region", F.substring(F.col("amplicon_seq"), F.col("fwd_pos") + 1, size).alias("amplicon_seq"), size.alias("amplicon_len"),
                       (F.col("junction_offset") - F.col("fwd_pos")).alias("junction_offset"), "fwd_primer", "fwd_tm", "fwd_gc", "rev_primer", "rev_tm", "rev_gc")

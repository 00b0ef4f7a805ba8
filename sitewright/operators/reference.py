"""Access to reference sequence held as blocks (chrom, 0-based start_pos, seq)."""
from __future__ import annotations

import sys
from itertools import combinations, product
from math import comb

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from sitewright.functions import pam_and_type
from sitewright.operators.core import SCOPE, bin_join, scope

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Two bits a letter in one signed 64-bit number.
MAX_GUIDE = 31
#: Pieces that agree beyond the number of mismatches, where windows are cut into pieces.
EXTRA = 3
#: Windows that are coded at a time.
WINDOWS = 1 << 16
LETTER_CODES = np.full(256, -1, np.int8)
LETTER_CODES[np.frombuffer(b"ACGT", np.uint8)] = range(4)


def fetch_ref(windows: DataFrame, ref: DataFrame, keys: list[str], out: str = "ref_seq", width: int = 4096) -> DataFrame:
    """Reference text of each window [lo, hi) (0-based), joined from the blocks it touches.

    Blocks that overlap their successor carry ``core_len``; only the core is used.
    """
    core = F.col("core_len") if "core_len" in ref.columns else F.length("seq")
    own = [*scope(windows, ref), "chrom"]
    blocks = ref.select(*own, F.col("start_pos").cast("bigint").alias("_bs"), core.alias("_bl"), F.col("seq").alias("_bseq"))
    blocks = blocks.withColumn("_be", F.col("_bs") + F.least("_bl", F.length("_bseq")))
    lo, hi = F.col("lo"), F.col("hi")
    hit = bin_join(windows.select(*keys, *[c for c in own if c not in keys], "lo", "hi"), blocks, own, (lo, hi - 1), (F.col("_bs"), F.col("_be") - 1),
                   (lo < F.col("_be")) & (hi > F.col("_bs")), width=width)
    a, b = F.greatest(lo, F.col("_bs")), F.least(hi, F.col("_be"))
    piece = F.substring("_bseq", (a - F.col("_bs") + 1).cast("int"), (b - a).cast("int"))
    parts = hit.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(a.alias("at"), piece.alias("p")))).alias("_parts"))
    return parts.select(*keys, F.upper(F.array_join("_parts.p", "")).alias(out))


def seed_deltas(bases: int, changes: int) -> np.ndarray:
    """Exclusive-or masks that change up to ``changes`` of ``bases`` two-bit letters."""
    out = []
    for n in range(min(changes, bases) + 1):
        for at in combinations(range(bases), n):
            for new in product((1, 2, 3), repeat=n):
                out.append(sum(v << 2 * k for k, v in zip(at, new)))
    return np.array(sorted(out), np.int64)


def _coded(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Two-bit letters of a sequence, and 1 where a letter is none of A, C, G, T."""
    code = LETTER_CODES[np.frombuffer(text, np.uint8)]
    return np.where(code < 0, 0, code).astype(np.int64), (code < 0).astype(np.int64)


def _halves(code, length: int):
    """(half, seed) of a coded window: the first length // 2 letters and the rest."""
    rest = 2 * (length - length // 2)
    return (0, code >> rest), (1, code & (1 << rest) - 1)


def _cuts(length: int, pieces: int) -> list[tuple[int, int]]:
    """(shift, bits) of ``pieces`` even pieces of a coded window, first letters first."""
    edge = [length * k // pieces for k in range(pieces + 1)]
    return [(2 * (length - b), 2 * (b - a)) for a, b in zip(edge, edge[1:])]


def _piece_keys(code: np.ndarray, length: int, max_mm: int):
    """(kind, seed) for every choice of ``EXTRA`` of the ``max_mm`` + ``EXTRA`` pieces of coded windows; kinds have the chosen pieces as bits."""
    cuts = _cuts(length, max_mm + EXTRA)
    for chosen in combinations(range(len(cuts)), EXTRA):
        seed = np.zeros(len(code), np.int64)
        for k in chosen:
            shift, bits = cuts[k]
            seed = seed << bits | code >> shift & (1 << bits) - 1
        yield sum(1 << k for k in chosen), seed


def _skipped(length: int, max_mm: int) -> dict[int, list[int]]:
    """By kind, the letters of the pieces ahead of its last chosen one that are not chosen: a pair that meets there first differs in all of them."""
    low = 0x1555555555555555
    masks = [((1 << bits) - 1 << shift) & low for shift, bits in _cuts(length, max_mm + EXTRA)]
    return {sum(1 << k for k in chosen): [masks[k] for k in range(chosen[-1]) if k not in chosen] for chosen in combinations(range(len(masks)), EXTRA)}


def _guide_index(guides: DataFrame, keys: list[str], max_mm: int, by_pieces: set[int]) -> DataFrame:
    """One row per guide, strand and seed: choices of pieces, or halves with every seed within max_mm // 2 changes."""
    flip = bytes.maketrans(b"ACGT", b"TGCA")
    inner = guides.select(*[F.col(k).alias(f"_g_{k}") for k in keys], "grna_idx", F.upper("guide").alias("guide")).filter(F.length("guide").between(2, MAX_GUIDE))

    def run(batches):
        deltas: dict[int, np.ndarray] = {}
        for b in batches:
            groups: dict[tuple[int, str], list] = {}
            for row, guide in enumerate(b.column(b.num_columns - 1).to_pylist()):
                text = guide.encode()
                if len(text) != len(guide):
                    continue
                for strand, t in (("+", text), ("-", text.translate(flip)[::-1])):
                    letters, bad = _coded(t)
                    place = 2 * np.arange(len(t) - 1, -1, -1)
                    groups.setdefault((len(t), strand), []).append((row, int((letters << place).sum()), int((bad << place).sum())))
            for (length, strand), some in groups.items():
                row, code, off = (np.array(x, np.int64) for x in zip(*some))
                if length in by_pieces:
                    found = [(kind, seed[:, None]) for kind, seed in _piece_keys(code, length, max_mm)]
                else:
                    size = (length // 2, length - length // 2)
                    found = [(half, seed[:, None] ^ deltas.setdefault(size[half], seed_deltas(size[half], max_mm // 2))) for half, seed in _halves(code, length)]
                for kind, seeds in found:
                    step = max(1, WINDOWS // seeds.shape[1])
                    for lo in range(0, len(row), step):
                        part = seeds[lo:lo + step]
                        n = part.size
                        each = lambda v: pa.array(np.repeat(v[lo:lo + step], part.shape[1]))
                        yield pa.RecordBatch.from_arrays(
                            [*(b.column(k).take(each(row)) for k in range(b.num_columns - 1)), pa.array([strand]).take(pa.array(np.zeros(n, np.int32))),
                             pa.array(np.full(n, length)), pa.array(np.full(n, kind)), pa.array(part.ravel()), each(code), each(off)],
                            [*b.schema.names[:-1], "strand", "_glen", "_ghalf", "_gseed", "_gcode", "_goff"])

    schema = T.StructType([*inner.schema.fields[:-1], T.StructField("strand", T.StringType()),
                           *(T.StructField(c, T.LongType()) for c in ("_glen", "_ghalf", "_gseed", "_gcode", "_goff"))])
    return inner.repartition(guides.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, schema)


def _lengths_by_pieces(ref: DataFrame, counts: dict[int, int], max_mm: int) -> set[int]:
    """The guide lengths for which choices of pieces make fewer rows than halves with all their near variants."""
    bases = ref.agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).alias("n")).first()["n"]
    out = set()
    for length, guides in counts.items():
        if length < 2 * (max_mm + EXTRA):
            continue
        choices = comb(max_mm + EXTRA, EXTRA)
        near = sum(comb(length - length // 2, n) * 3 ** n for n in range(max_mm // 2 + 1))
        if choices * (bases + 2 * guides) < 2 * bases + 4 * near * guides:
            out.add(length)
    return out


def grna_sites(ref: DataFrame, guides: DataFrame, max_mm: int = 4) -> DataFrame:
    """Guide targets on both strands within ``max_mm`` mismatches, with PAM, type and cut position.

    ``guides`` has (grna_idx, guide), any number of rows of 2 to 31 letters; a guide of another length has no target.  Pigeonhole seeds: of
    a guide's two halves one has at most ``max_mm`` // 2 mismatches, so every half is indexed with all its variants within that many, joined
    with the halves of all windows, and the coded windows are compared bit by bit.  A pair whose halves both qualify counts for the first.
    Where there are many guides for the reference, both are cut into ``max_mm`` + ``EXTRA`` pieces instead, of which ``EXTRA`` agree; every
    choice of that many pieces is a seed, without variants, and a pair counts for the first pieces that agree.
    Letters other than A, C, G, T match nothing.  If guides carry ``host`` or ``sample`` as the reference does, they are sought there only.

    Blocks overlap their successor by at least guide + PAM - 1 bases and a hit belongs to the block whose core holds its start.
    """
    own, keys = [*(c for c in SCOPE if c in ref.columns), "chrom"], scope(ref, guides)
    counts = {r["n"]: r["m"] for r in guides.groupBy(F.length("guide").alias("n")).agg(F.count(F.lit(1)).alias("m")).filter(F.col("n").between(2, MAX_GUIDE)).collect()}
    lengths = sorted(counts)
    by_pieces = _lengths_by_pieces(ref, counts, max_mm)
    core = F.col("core_len") if "core_len" in ref.columns else F.length("seq")
    blocks = ref.select(*own, F.col("start_pos").cast("bigint").alias("_block"), core.cast("bigint").alias("_core"), F.upper("seq").alias("_seq"))
    width = len(own)

    def windows(batches):
        for b in batches:
            for row in range(b.num_rows):
                block, core_len, seq = (b.column(width + k)[row].as_py() for k in range(3))
                if not seq or core_len is None:
                    continue
                letters, bad = _coded(seq.encode())
                for length in lengths:
                    n = min(len(letters) - length + 1, core_len)
                    for first in range(0, n, WINDOWS):
                        m = min(WINDOWS, n - first)
                        code, off = np.zeros(m, np.int64), np.zeros(m, np.int64)
                        for k in range(length):
                            code = code << 2 | letters[first + k:first + k + m]
                            off = off << 2 | bad[first + k:first + k + m]
                        at = np.arange(first, first + m)
                        after = pa.array([seq[i + length:i + length + 3] for i in at.tolist()])
                        ahead = pa.array([seq[max(0, i - 3):i] for i in at.tolist()])
                        found = list(_piece_keys(code, length, max_mm) if length in by_pieces else _halves(code, length))
                        # short blocks give their windows in one batch
                        step = max(1, WINDOWS // m)
                        for lo in range(0, len(found), step):
                            some = found[lo:lo + step]
                            n_rows = m * len(some)
                            every = lambda v: pa.array(np.tile(v, len(some)))
                            same = [b.column(k).slice(row, 1).take(pa.array(np.zeros(n_rows, np.int32))) for k in range(width)]
                            text = every(np.arange(m))
                            yield pa.RecordBatch.from_arrays(
                                [*same, every(block + at), pa.array(np.full(n_rows, length)), pa.array(np.repeat([kind for kind, _ in some], m)),
                                 pa.array(np.concatenate([seed for _, seed in some])), every(code), every(off), after.take(text), ahead.take(text)], names)

    numbers = ("t_start", "_len", "_half", "_seed", "_code", "_off")
    names = [*own, *numbers, "_after", "_ahead"]
    schema = T.StructType([*blocks.schema.fields[:width], *(T.StructField(c, T.LongType()) for c in numbers),
                           *(T.StructField(c, T.StringType()) for c in ("_after", "_ahead"))])
    # a small table of blocks or guides makes many rows: they are dealt out and never broadcast
    found = blocks.repartition(ref.sparkSession.sparkContext.defaultParallelism).mapInArrow(windows, schema).hint("merge")
    index = _guide_index(guides, keys, max_mm, by_pieces)
    differ = F.col("_code").bitwiseXOR(F.col("_gcode"))
    low = F.lit(0x1555555555555555)
    changed = differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(low)
    wrong = changed.bitwiseOR(F.col("_off")).bitwiseOR(F.col("_goff"))
    on = (F.col("_len") == F.col("_glen")) & (F.col("_half") == F.col("_ghalf")) & (F.col("_seed") == F.col("_gseed"))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_g_{k}"))
    rest = F.col("_len") - F.floor(F.col("_len") / 2)
    first_half = F.bit_count(F.call_function("shiftrightunsigned", changed, (2 * rest).cast("int")))
    first_met = (F.col("_half") == 0) | (first_half > max_mm // 2)
    for length in sorted(by_pieces):
        skipped = [F.when(F.col("_half") == kind, F.array(*[F.lit(m) for m in masks])) for kind, masks in _skipped(length, max_mm).items() if masks]
        ahead_differ = F.forall(F.coalesce(*skipped, F.array().cast("array<bigint>")), lambda m: changed.bitwiseAND(m) != 0)
        first_met = F.when(F.col("_len") == length, ahead_differ).otherwise(first_met)
    on = on & (F.bit_count(wrong) <= max_mm)
    plus = F.col("strand") == "+"
    hits = found.join(index, on).filter(first_met).select(
        *own, "grna_idx", "strand", "t_start", (F.col("t_start") + F.col("_len")).alias("t_end"), F.bit_count(wrong).cast("int").alias("mismatches"),
        F.when(plus, F.col("_after")).otherwise(F.col("_ahead")).alias("pam_seq"))
    info = pam_and_type("strand", "pam_seq", "mismatches", "t_start", "t_end")
    return hits.withColumn("_i", info).select(*hits.columns, "_i.*")


def rank_targets(targets: DataFrame) -> DataFrame:
    """Fewest mismatches first, on-target sites ahead of others."""
    return targets.orderBy("mismatches", F.when(F.col("site_type") == "on-target", 0).otherwise(1))


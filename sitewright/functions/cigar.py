"""Column functions over CIGAR text."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from sitewright.functions.sequence import _col

OPS = r"(\d+)([MIDNSHP=X])"


def cigar_ops(c) -> Column:
    """``array<struct<op:string,len:int>>``"""
    c = _col(c)
    lens = F.transform(F.regexp_extract_all(c, F.lit(OPS), F.lit(1)), lambda x: x.cast("int"))
    ops = F.regexp_extract_all(c, F.lit(OPS), F.lit(2))
    return F.arrays_zip(ops.alias("op"), lens.alias("len"))


def ref_len(c) -> Column:
    """Reference bases consumed: lengths of M, D, N, = and X."""
    parts = F.regexp_extract_all(_col(c), F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda acc, x: acc + x.cast("bigint"))


def ref_end(pos, c) -> Column:
    return _col(pos) + ref_len(c)


def _lead(c, pattern: str) -> Column:
    text = F.regexp_extract(_col(c), pattern, 1)
    return F.coalesce(F.nullif(text, F.lit("")).cast("int"), F.lit(0))


def clip_left_len(c, hard: bool = False) -> Column:
    """Soft-clip length when S is the first operation (``hard`` looks past an H)."""
    return _lead(c, r"^(?:\d+H)?(\d+)S" if hard else r"^(\d+)S")


def clip_right_len(c, hard: bool = False) -> Column:
    return _lead(c, r"(\d+)S(?:\d+H)?$" if hard else r"(\d+)S$")


def left_clip_seq(c, seq) -> Column:
    return F.substring(_col(seq), F.lit(1), clip_left_len(c))


def right_clip_seq(c, seq) -> Column:
    return F.right(_col(seq), clip_right_len(c))


def cigar_blocks(c, start) -> Column:
    """Walk the CIGAR once: ``array<struct<op,len,r,q>>`` with 0-based reference and query offsets of each operation."""
    seed = F.struct(
        _col(start).cast("bigint").alias("r"), F.lit(0).alias("q"),
        F.array().cast("array<struct<op:string,len:int,r:bigint,q:int>>").alias("out"),
    )

    def step(acc, x):
        on_ref = x["op"].isin("M", "D", "N", "=", "X")
        on_query = x["op"].isin("M", "I", "S", "=", "X")
        return F.struct(
            (acc["r"] + F.when(on_ref, x["len"]).otherwise(0)).alias("r"),
            (acc["q"] + F.when(on_query, x["len"]).otherwise(0)).alias("q"),
            F.array_append(acc["out"], F.struct(
                x["op"].alias("op"), x["len"].alias("len"), acc["r"].alias("r"), acc["q"].alias("q"))).alias("out"),
        )

    return F.aggregate(cigar_ops(c), seed, step, lambda acc: acc["out"])

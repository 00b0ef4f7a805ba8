"""Fill-in-the-middle: a text's units are counted and cut by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` keeps every repetition of its group; ``ends(1)`` gives the number of units and both cut offsets.  The
draws, the form and the output are column functions around that one call, so the text itself does not come back from Python.
The matcher's memory grows with the text, so a text is matched in stretches of STRETCH characters or more, each of which ends where a
run of letters ends; the ends of all stretches are those of the whole text.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F, types as T

UNITS = regex.compile(r"([A-Za-z]+|[^A-Za-z])*")
NO_LETTER = regex.compile(r"[^A-Za-z]")
STRETCH = 1 << 19
#: Markers of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def unit_ends(text: str, stretch: int = STRETCH) -> np.ndarray:
    """End offset of every unit."""
    ends, start = [], 0
    while start < len(text) or not ends:
        last = NO_LETTER.search(text, start + stretch) if start + stretch < len(text) else None
        stop = last.end() if last else len(text)
        ends.append(np.array(UNITS.fullmatch(text, start, stop).ends(1), np.int64))
        start = stop
    return ends[0] if len(ends) == 1 else np.concatenate(ends)


def cuts(text: str, first: int, second: int, stretch: int = STRETCH) -> tuple[int, int, int]:
    """(units, characters before the middle, characters before the suffix) for two draws."""
    ends = unit_ends(text, stretch)
    n = len(ends)
    a, b = sorted((first % (n + 1), second % (n + 1)))
    return n, int(ends[a - 1]) if a else 0, int(ends[b - 1]) if b else 0


CUTS = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "first", "second")])


@F.arrow_udf(CUTS)
def _cuts(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> pa.Array:
    rows = [cuts(t.as_py(), a, b) for t, a, b in zip(texts, h1.to_pylist(), h2.to_pylist())]
    n, first, second = (pa.array([r[i] for r in rows], pa.int64()) for i in range(3))
    return pa.StructArray.from_arrays([n, first, second], ["n", "first", "second"])


def draws(id_col: Column, seed: int, count: int = 4) -> list[Column]:
    """Unsigned 32-bit draws: the first 8-digit groups of sha256('<seed>:<id>'); a null id draws like the text 'null'."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null"))), 256)
    return [F.conv(F.substring(h, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(count)]


def transform(docs: DataFrame, *, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, id_col: str = "doc_id", text_col: str = "text",
              keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns of every row with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    A text that is null is an empty one.  An empty text, one that holds a marker and ``plain_percent`` of the others stay as they are
    (form ``plain``, no cut, both lengths null); of the rest ``spm_percent`` put the suffix first.  Draws depend on seed and id only, so rows that share
    an id draw alike, and a null id draws like the text 'null'.  Columns of ``docs`` other than id, text and ``keep`` are not read; of
    ``keep`` those named like a result are left out.  An empty table gives none.
    """
    kept = [c for c in keep if c not in ("n", "form", "prefix_chars", "middle_chars", "output")]
    text = F.coalesce(F.col(text_col), F.lit(""))
    h = docs.select(F.struct(*kept).alias("_k") if kept else F.lit(None).alias("_k"), text.alias("_t"), F.array(*draws(F.col(id_col), seed)).alias("_h"))
    h = h.withColumn("_c", _cuts("_t", F.col("_h")[0], F.col("_h")[1]))
    t, first, second = F.col("_t"), F.col("_c.first"), F.col("_c.second")
    marked = F.lit(False)
    for m in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | t.contains(m)
    plain = (t == "") | marked | (F.col("_h")[2] % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(F.col("_h")[3] % 100 < spm_percent, "spm").otherwise("psm")
    h = h.withColumn("_f", form)
    prefix, middle = F.substring(t, F.lit(1), first.cast("int")), F.substring(t, (first + 1).cast("int"), (second - first).cast("int"))
    suffix = F.substring(t, (second + 1).cast("int"), F.length(t))
    output = F.when(F.col("_f") == "plain", t).when(F.col("_f") == "spm", F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    cut = F.col("_f") != "plain"
    return h.select(*(["_k.*"] if kept else []), F.col("_c.n").alias("n"), F.col("_f").alias("form"), F.when(cut, first).alias("prefix_chars"),
                    F.when(cut, second - first).alias("middle_chars"),
                    output.otherwise(F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle)).alias("output"))


def restored(output: Column, form: Column) -> Column:
    """The text again, from output and form alone."""
    tail = F.substring_index(output, MIDDLE, -1)
    head = F.substring_index(output, MIDDLE, 1)

    def parts(a: str, b: str) -> tuple[Column, Column]:
        return F.substring(F.substring_index(head, b, 1), F.lit(len(a) + 1), F.length(head)), F.substring_index(head, b, -1)

    prefix, suffix = parts(PREFIX, SUFFIX)
    suffix_first, prefix_last = parts(SUFFIX, PREFIX)
    return F.when(form == "plain", output).when(form == "spm", F.concat(prefix_last, tail, suffix_first)).otherwise(F.concat(prefix, tail, suffix))

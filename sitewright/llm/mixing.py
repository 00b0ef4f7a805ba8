"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions.

Native throughout.  The text is read once to get (source, draw, size); everything after works on sums per source and per slice of the
draw, so a source that holds most rows is never ordered in one task: only the documents of one slice of 2**-24 of it are.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitewright.session import checkpoint

WORD = r"[^\x20\x09-\x0D]+"
DRAW_BITS = 60
SLICE_BITS = (48, 36)
SALTS = 32


def word_count(text) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(key, seed: int) -> Column:
    """A seeded whole number below 2**60 per key, the same in every run; a null key draws like the text 'null'."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit("null")))
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("bigint")


def fill_targets(sizes: DataFrame, *, share: float = 1.5, max_epochs: float = 2.0, pattern: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Targets of sources: ``share`` of all sizes split by weight, no source over ``max_epochs`` times its size.

    ``sizes`` has (source, source_size).  Clamping the sources with the smallest size per unit of weight first and resharing what is
    left among the rest is the fixed point of redistributing the excess until no target is above its cap.  One row per source is
    ordered in one task; there are as many rows as sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    rank = F.pmod(F.row_number().over(by_name) - 1, F.lit(len(pattern)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in pattern]), (rank + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("cap", F.lit(max_epochs) * F.col("source_size"))
    by_need = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    below, above = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn("_total", F.lit(share) * F.sum("source_size").over(everything))
    s = s.withColumn("_left", F.col("_total") - F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
    s = s.withColumn("_share", F.col("_left") * F.col("weight") / F.sum("weight").over(above))
    s = s.withColumn("_open", F.col("_share") < F.col("cap"))
    # once a source keeps its share, so does every later one, at the same level
    s = s.withColumn("_level", F.first(F.when(F.col("_open"), F.col("_left") / F.sum("weight").over(above)), ignorenulls=True).over(
        by_need.rowsBetween(Window.unboundedPreceding, 0)))
    return s.select("source", "source_size", F.coalesce(F.col("_level") * F.col("weight"), F.col("cap")).alias("target"))


def plan_copies(docs: DataFrame, *, seed: int = 42, share: float = 1.5, max_epochs: float = 2.0, pattern: tuple[int, ...] = (5, 2, 1),
                id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Copies of every row of ``docs``: its columns and ``size``, ``source_size``, ``target``, ``copies``.

    A source whose target is r times its size is taken floor(r) times whole; of the rest, the documents with the smallest draws are
    taken once more, up to the one that brings the sum nearest.  Rows that share an id share their draw and go together.  A null or
    empty text has size 0; a null source is a source of its own, the last one.  An empty table gives an empty plan.
    Columns of ``docs`` that have the names of results are replaced.
    """
    own = [c for c in docs.columns if c not in ("size", "source_size", "target", "copies")]
    sized = checkpoint(docs.select(F.col(source_col).alias("source"), draw(id_col, seed).alias("draw"),
                                   word_count(F.col(text_col)).alias("size")))
    targets = fill_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), share=share, max_epochs=max_epochs,
                           pattern=pattern)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("int")
    need = F.col("target") - F.col("whole") * F.col("source_size")
    targets = checkpoint(targets.withColumn("whole", whole).withColumn("need", need))

    # narrow the boundary draw slice by slice; ``taken`` is what lies below the slice
    edge = targets.select("source", "need", F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("taken"))
    width = DRAW_BITS
    for bits in SLICE_BITS:
        part = _inside(sized, edge, width).withColumn("low", F.shiftright("draw", bits))
        part = part.groupBy("source", "need", "taken", "low").agg(F.sum("size").alias("size"))
        upto = F.col("taken") + F.sum("size").over(Window.partitionBy("source").orderBy("low"))
        part = part.withColumn("upto", upto).filter(F.col("upto") > F.col("need"))
        edge = part.groupBy("source").agg(F.min(F.struct("low", "need", (F.col("upto") - F.col("size")).alias("taken"))).alias("e"))
        edge = checkpoint(edge.select("source", "e.need", F.shiftleft("e.low", bits).alias("low"), "e.taken"))
        width = bits
    last = _inside(sized, edge, width).groupBy("source", "need", "taken", "draw").agg(F.sum("size").alias("size"))
    upto = F.col("taken") + F.sum("size").over(Window.partitionBy("source").orderBy("draw"))
    last = last.withColumn("middle", upto - F.col("size") / F.lit(2.0)).filter(F.col("middle") > F.col("need"))
    # the draws below the first one that would overshoot; a source without such a slice or draw keeps the slice's end
    cut = edge.select("source", (F.col("low") + F.lit(1 << width)).alias("end")).join(
        last.groupBy(F.col("source").alias("_s")).agg(F.min("draw").alias("first")), F.col("source").eqNullSafe(F.col("_s")), "left")
    cut = cut.select(F.col("source").alias("_c"), F.coalesce("first", "end").alias("cut"))
    rule = targets.join(cut, F.col("source").eqNullSafe(F.col("_c")), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "whole", F.coalesce("cut", F.lit(1 << DRAW_BITS)).alias("_cut"))
    out = docs.select(own).withColumn("_draw", draw(id_col, seed)).withColumn("size", word_count(F.col(text_col)))
    out = out.join(_salted(rule), F.col(source_col).eqNullSafe(F.col("_source")) & (_salt("_draw") == F.col("_salt")))
    extra = ((F.col("_draw") < F.col("_cut")) & (F.col("target") > F.col("whole") * F.col("source_size"))).cast("int")
    return out.select(*own, "size", "source_size", "target", (F.col("whole") + extra).alias("copies"))


def _salt(draw_col: str) -> Column:
    return F.pmod(F.col(draw_col), F.lit(SALTS)).cast("int")


def _salted(per_source: DataFrame) -> DataFrame:
    """One row per source and salt, so that a join spreads the documents of a large source over as many tasks."""
    return per_source.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _inside(sized: DataFrame, edge: DataFrame, width: int) -> DataFrame:
    """Rows of the slice [low, low + 2**width) of their source."""
    e = _salted(edge.select(F.col("source").alias("_s"), "need", "taken", F.col("low").alias("_low")))
    inside = (_salt("draw") == F.col("_salt")) & (F.col("draw") >= F.col("_low")) & (F.col("draw") < F.col("_low") + F.lit(1 << width))
    return sized.join(e, F.col("source").eqNullSafe(F.col("_s")) & inside).select("source", "need", "taken", "draw", "size")


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the plan takes it."""
    plan = plan_copies(docs, **options)
    return plan.withColumn("_n", F.explode(F.sequence(F.lit(1), F.when(F.col("copies") > 0, F.col("copies"))))).select(docs.columns)

"""Depth of coverage as run-length intervals, and copy number."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from sitewright.functions import calls as fl, cigar_blocks, copies_rounded, copy_class, flag_is
from sitewright.operators.core import TILE, before, bin_join, carry, tile_of, upper_median
from sitewright.session import checkpoint

REF = ["sample", "chrom"]


def depth_runs(alignments: DataFrame, refs: DataFrame, tile: int = TILE) -> DataFrame:
    """Constant-depth runs [start, end) from 0 to the reference length, zero runs included.

    Reads become +1/-1 events that are summed per position before any ordering; the running sum is taken tile
    by tile.  ``refs`` has sample, chrom, length.
    """
    off = fl.UNMAPPED | fl.SECONDARY | fl.QC_FAIL | fl.DUPLICATE
    blocks = alignments.filter(~flag_is("flag", off)).select(*REF, F.explode(cigar_blocks("cigar", "ref_start")).alias("b")).filter(
        F.col("b.op").isin("M", "=", "X"))
    edge = lambda at, d: F.struct(at.cast("bigint").alias("pos"), F.lit(d).alias("d"))
    events = blocks.select(*REF, F.explode(F.array(edge(F.col("b.r"), 1), edge(F.col("b.r") + F.col("b.len"), -1))).alias("x")).select(*REF, "x.*")
    frame = refs.select(*REF, F.explode(F.array(edge(F.lit(0), 0), edge(F.col("length"), 0))).alias("x")).select(*REF, "x.*")
    events = checkpoint(events.unionByName(frame).groupBy(*REF, "pos").agg(F.sum("d").alias("d")))
    return runs_from_events(events, tile)


def runs_from_events(events: DataFrame, tile: int = TILE) -> DataFrame:
    from pyspark.sql import Window

    rows = events.withColumn("_tile", tile_of("pos", tile))
    local = Window.partitionBy(*REF, "_tile").orderBy("pos")
    rows = rows.withColumn("_here", F.sum("d").over(local.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_next", F.lead("pos").over(local))
    rows = carry(rows, REF, {"_sum": F.sum("d"), "_first": F.min("pos")},
                 {"_below": lambda o: F.sum("_sum").over(before(o)), "_after": lambda o: F.lead("_first").over(o)})
    rows = rows.select(*REF, F.col("pos").alias("start_pos"), F.coalesce("_next", "_after").alias("end_pos"),
                       (F.col("_here") + F.coalesce("_below", F.lit(0))).alias("depth"))
    return rows.filter(F.col("end_pos").isNotNull())


def expand_depth(runs: DataFrame) -> DataFrame:
    """One row per position (0-based), only when asked for."""
    return runs.select(*REF, F.explode(F.sequence("start_pos", F.col("end_pos") - 1)).alias("pos"), "depth")


def depth_summary(runs: DataFrame, keys=("sample",)) -> DataFrame:
    """Positions, covered share, mean, upper median, minimum and maximum from runs or single positions."""
    keys = list(keys)
    rows = weigh(runs)
    hist = rows.groupBy(*keys, "depth").agg(F.sum("w").alias("w"))
    base = hist.groupBy(*keys).agg(
        F.sum("w").alias("positions"), F.sum(F.when(F.col("depth") > 0, F.col("w")).otherwise(0)).alias("covered"),
        (F.sum(F.col("w") * F.col("depth")) / F.sum("w")).alias("mean_depth"), F.min("depth").alias("min_depth"), F.max("depth").alias("max_depth"))
    med = upper_median(hist, keys, "depth", "w", "median_depth").drop("n")
    return base.join(med, keys).withColumn("covered_pct", F.col("covered") * 100.0 / F.col("positions"))


def weigh(df: DataFrame) -> DataFrame:
    return df.withColumn("w", F.col("end_pos") - F.col("start_pos")) if "end_pos" in df.columns else df.withColumn("w", F.lit(1).cast("bigint"))


def flagstat(alignments: DataFrame) -> DataFrame:
    mapped = F.count_if(~flag_is("flag", fl.UNMAPPED))
    return alignments.groupBy("sample").agg(F.count(F.lit(1)).alias("total"), mapped.alias("mapped"), (mapped / F.count(F.lit(1))).alias("mapping_rate"))


def construct_median(depth: DataFrame) -> DataFrame:
    """Highest per-element upper median among elements at least half covered; else that of all covered positions."""
    hist = weigh(depth).groupBy("sample", "ref_name", "depth").agg(F.sum("w").alias("w"))
    cover = hist.groupBy("sample", "ref_name").agg(F.sum("w").alias("positions"), F.sum(F.when(F.col("depth") > 0, F.col("w")).otherwise(0)).alias("covered"))
    med = upper_median(hist, ["sample", "ref_name"], "depth", "w").drop("n")
    good = med.join(cover, ["sample", "ref_name"]).filter((F.col("covered") >= F.col("positions") * 0.5) & (F.col("median") > 0))
    best = good.groupBy("sample").agg(F.max("median").alias("best"), F.max_by("positions", F.struct("median", F.col("ref_name"))).alias("best_n"),
                                      F.min_by("ref_name", F.struct((-F.col("median")).alias("m"), "ref_name")).alias("marker"))
    rest = upper_median(hist.filter("depth > 0"), ["sample"], "depth", "w", "fallback")
    names = depth.select("sample").distinct()
    out = names.join(best, "sample", "left").join(rest, "sample", "left")
    return out.select("sample", F.coalesce("best", "fallback", F.lit(0)).cast("double").alias("construct_median"), "marker")


def host_median(depth: DataFrame) -> DataFrame:
    """Exact upper median over all positions."""
    return upper_median(weigh(depth), ["sample"], "depth", "w", "host_median").withColumn("host_median", F.col("host_median").cast("double"))


def flank_depth(runs: DataFrame, sites: DataFrame, outer: int = 2000, inner: int = 100, include_zero: bool = False) -> DataFrame:
    """Mean depth left [pos-outer, pos-inner] and right [pos+inner, pos+outer] over covered positions (same base as ``sites.pos``)."""
    if not include_zero:
        runs = runs.filter("depth > 0")
    p = F.col("pos")
    sides = F.explode(F.array(F.struct(F.lit("left").alias("side"), F.greatest(F.lit(0), p - outer).alias("lo"), (p - inner).alias("hi")),
                              F.struct(F.lit("right").alias("side"), (p + inner).alias("lo"), (p + outer).alias("hi"))))
    spans = sites.select("sample", "site_id", "chrom", sides.alias("x")).select("sample", "site_id", "chrom", "x.*").filter("lo <= hi")
    hit = bin_join(runs, spans, REF, (F.col("start_pos"), F.col("end_pos") - 1), (F.col("lo"), F.col("hi")),
                   (F.col("start_pos") <= F.col("hi")) & (F.col("end_pos") > F.col("lo")), width=2048)
    n = F.least(F.col("end_pos") - 1, F.col("hi")) - F.greatest("start_pos", "lo") + 1
    mean = lambda s: (F.sum(F.when(F.col("side") == s, n * F.col("depth"))) / F.sum(F.when(F.col("side") == s, n)))
    out = hit.groupBy("sample", "site_id").agg(mean("left").alias("depth_left"), mean("right").alias("depth_right"))
    return sites.select("sample", "site_id").join(out, ["sample", "site_id"], "left").na.fill(0.0, ["depth_left", "depth_right"])


def binned_depth(depth: DataFrame, keys: list[str], start: int, end: int, width: int = 100) -> DataFrame:
    """Mean depth per bin of a region [start, end]; regions of at most two bins' worth of rows stay per position.

    Bin edges divide the region evenly into ``(end - start) // width`` bins, positions at ``end`` fall outside.
    """
    region = depth.filter(F.col("pos").between(start, end))
    n_bins = max(1, (end - start) // width)
    i = F.floor((F.col("pos") - start) * n_bins / (end - start))
    size = region.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    rows = region.join(size, keys)
    big = F.col("_n") > 2 * width
    center = F.when(big, F.lit(float(start)) + (i + 0.5) * ((end - start) / n_bins)).otherwise(F.col("pos").cast("double"))
    rows = rows.filter(~big | (i < n_bins)).select(*keys, center.alias("center"), "depth")
    return rows.groupBy(*keys, "center").agg(F.avg("depth").alias("mean_depth"))


def top_references(depth: DataFrame, n: int = 15, min_mean: float = 1) -> DataFrame:
    """References by mean depth over positions 0..max (1-based input leaves slot 0 empty), best ``n`` per sample."""
    from pyspark.sql import Window

    means = depth.groupBy("sample", "ref_name").agg((F.sum("depth") / (F.max("pos") + 1)).alias("mean_depth")).filter(F.col("mean_depth") >= min_mean)
    w = Window.partitionBy("sample").orderBy(F.desc("mean_depth"), "ref_name")
    return means.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def candidate_sites(stats: DataFrame) -> DataFrame:
    """CANDIDATE verdicts per sample in long key/value statistics."""
    hit = F.endswith("key", F.lit("_verdict")) & (F.col("value") == "CANDIDATE")
    return stats.groupBy("sample").agg(F.count_if(hit).alias("candidate_sites"))


def site_validation(count, copies) -> Column:
    n, c = F.col(count), F.col(copies)
    return (F.when(n == 0, "no_candidate_sites")
            .when(n == 1, F.when(c <= 1.5, "consistent_single_locus").otherwise("depth_suggests_multicopy_single_locus"))
            .otherwise(F.when(c > 1.5, "consistent_multi_locus").otherwise("multiple_sites_but_low_depth")))


def copy_confidence(construct, host, count, validation) -> Column:
    v = F.col(validation)
    return (F.when((F.col(host) < 1.0) | (F.col(construct) < 1.0), "Low")
            .when((F.col(count) >= 1) & F.contains(v, F.lit("consistent")), "High").when(F.col(count) >= 1, "Medium").otherwise("Low"))


def copy_number(construct_depth: DataFrame, host_depth: DataFrame, stats: DataFrame) -> DataFrame:
    """Copy-number report, one row per sample."""
    rows = construct_median(construct_depth).join(host_median(host_depth).drop("n"), "sample", "left").join(candidate_sites(stats), "sample", "left")
    rows = rows.na.fill(0, ["candidate_sites"]).na.fill(0.0, ["host_median"])
    rows = rows.withColumn("depth_ratio", F.when(F.col("host_median") > 0, F.col("construct_median") / F.col("host_median")).otherwise(0.0))
    rows = rows.withColumns({"estimated_copies": copies_rounded("depth_ratio"), "copy_description": copy_class("depth_ratio")})
    rows = rows.withColumn("site_validation", site_validation("candidate_sites", "estimated_copies"))
    return rows.withColumn("confidence", copy_confidence("construct_median", "host_median", "candidate_sites", "site_validation"))

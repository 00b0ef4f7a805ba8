"""Audit of processing logs: time order, pre/post pairing, hash continuity.

A log may be long, so its lines are tiled by line number and only tile summaries are scanned in order.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from sitewright.operators.core import before, carry, tile_of

TILE_LINES = 1 << 16


def _tiled(log: DataFrame, width: int) -> DataFrame:
    return log.withColumn("_tile", tile_of("line_no", width))


def custody_monotone(log: DataFrame, tile: int = TILE_LINES) -> DataFrame:
    """Lines whose time is earlier than the last readable one, and lines whose time cannot be read."""
    rows = _tiled(log.withColumn("_t", F.col("ts").try_cast("timestamp")), tile)
    local = Window.partitionBy("log_id", "_tile").orderBy("line_no")
    rows = rows.withColumn("_prev", F.last("_t", ignorenulls=True).over(before(local)))
    rows = carry(rows, ["log_id"], {"_last": F.max_by("_t", F.when(F.col("_t").isNotNull(), F.col("line_no")))},
                 {"_carry": lambda o: F.last("_last", ignorenulls=True).over(before(o))})
    prev = F.coalesce("_prev", "_carry")
    error = F.when(F.col("_t").isNull(), "unparseable").when(F.col("_t") < prev, "earlier")
    return rows.select("log_id", "line_no", error.alias("error")).filter("error IS NOT NULL")


def _balance(log: DataFrame, tile: int) -> DataFrame:
    """Running pre/post balance per step and the lowest balance before each line (never above 0)."""
    keys = ["log_id", "step"]
    step = F.when(F.col("event") == "pre", 1).when(F.col("event") == "post", -1)
    rows = _tiled(log.filter(F.col("event").isin("pre", "post")).withColumn("_d", step), tile)
    local = Window.partitionBy(*keys, "_tile").orderBy("line_no")
    rows = rows.withColumn("_bal", F.sum("_d").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_low", F.min("_bal").over(before(local)))
    rows = carry(rows, keys, {"_sum": F.sum("_d"), "_min": F.min("_bal")}, {
        "_off": lambda o: F.coalesce(F.sum("_sum").over(before(o)), F.lit(0)),
        "_abs": lambda o: F.col("_off") + F.col("_min"),
        "_floor": lambda o: F.min("_abs").over(before(o))})
    low = F.least(F.lit(0), F.col("_off") + F.col("_low"), F.col("_floor"))
    return rows.select(*keys, "line_no", "event", (F.col("_off") + F.col("_bal")).alias("balance"), low.alias("low"))


def custody_pairs(log: DataFrame, tile: int = TILE_LINES) -> DataFrame:
    """``post`` lines without an open ``pre`` (one row each) and steps with ``pre`` lines left open."""
    rows = _balance(log, tile)
    orphan = rows.filter(F.col("balance") < F.col("low")).select(
        "log_id", "step", "line_no", F.lit("post_without_pre").alias("error"), F.lit(1).cast("bigint").alias("n"))
    ends = rows.groupBy("log_id", "step").agg(F.max_by("balance", "line_no").alias("b"), F.min(F.least("low", "balance")).alias("m"))
    open_pre = ends.filter(F.col("b") > F.col("m")).select(
        "log_id", "step", F.lit(None).cast("bigint").alias("line_no"), F.lit("open_pre").alias("error"), (F.col("b") - F.col("m")).alias("n"))
    return orphan.unionByName(open_pre)


def custody_hashes(log: DataFrame, tile: int = TILE_LINES) -> DataFrame:
    """Files whose digest differs between a ``post`` line and the ``pre`` line right after it (``files`` map per line)."""
    rows = _tiled(log.filter(F.col("event").isin("pre", "post") & F.col("files").isNotNull()), tile)
    rows = rows.withColumn("_me", F.struct("line_no", "event", "step", "files"))
    local = Window.partitionBy("log_id", "_tile").orderBy("line_no")
    rows = rows.withColumn("_lead", F.lead("_me").over(local))
    rows = carry(rows, ["log_id"], {"_first": F.min_by("_me", "line_no")}, {"_after": lambda o: F.lead("_first").over(o)})
    nxt = F.coalesce("_lead", "_after")
    pairs = rows.withColumn("_next", nxt).filter((F.col("event") == "post") & (F.col("_next.event") == "pre"))
    files = pairs.select("log_id", "line_no", "step", F.col("_next.step").alias("next_step"), F.col("_next.files").alias("_in"),
                         F.explode("files").alias("fname", "digest_out"))
    files = files.withColumn("digest_in", F.col("_in")[F.col("fname")]).filter(F.col("digest_in") != F.col("digest_out"))
    return files.drop("_in")


def custody_ok(log: DataFrame, tile: int = TILE_LINES) -> DataFrame:
    """Every log with its error count; clean means none of the three checks fired."""
    errors = custody_monotone(log, tile).select("log_id").unionByName(custody_pairs(log, tile).select("log_id")).unionByName(
        custody_hashes(log, tile).select("log_id"))
    n = errors.groupBy("log_id").agg(F.count(F.lit(1)).alias("errors"))
    return log.select("log_id").distinct().join(n, "log_id", "left").na.fill(0, ["errors"]).withColumn("clean", F.col("errors") == 0)

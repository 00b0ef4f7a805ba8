"""Interval and ordered-position helpers shared by the operators.

Positions along one chromosome or insert are never handled as one window group.  Work is cut into
fixed-width tiles of the coordinate axis; each tile is summarised to one row, the few summary rows
are scanned in order, and the carried value is joined back to its tile.  A task therefore holds at
most one tile of *distinct* positions, however many reads pile up there, because rows are
pre-aggregated per position (map-side) before anything is ordered.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

TILE = 1 << 20
#: Columns that tell cohorts apart: reads and calls belong to a sample, reference tables to a host.
SCOPE = ("sample", "host")
FOLD_TILE = 4096
#: Tile maps that are composed in one row, and how often: 2 ** 27 tiles, chromosomes of up to 2 ** 39 bases.
FAN, ROUNDS = 512, 3
#: Bits that a filter spends on each key of a set, and bits of a filter that every task may hold.
KEY_BITS, FILTER_BITS = 8, 1 << 30
#: Power of two of the bits of a small table: a large one for few keys is met by chance hardly ever, so few tables follow.
LEAST_BITS, MOST_TABLES = 22, 24


def scope(*frames: DataFrame) -> list[str]:
    """The cohort keys that every frame carries; whatever is matched by coordinate is matched within them."""
    return [c for c in SCOPE if all(c in f.columns for f in frames)]


def tile_of(pos, width: int) -> Column:
    pos = F.col(pos) if isinstance(pos, str) else pos
    return F.floor(pos / F.lit(width)).cast("bigint")


def carry(df: DataFrame, keys: list[str], summary: dict, carried: dict, tile: str = "_tile") -> DataFrame:
    """Summarise every tile, scan the summaries in tile order, join the carried values back.

    ``summary`` maps names to aggregates; ``carried`` maps names to functions of the ordered window
    over the one-row-per-tile summaries.
    """
    per_tile = df.groupBy(*keys, tile).agg(*[e.alias(n) for n, e in summary.items()])
    order = Window.partitionBy(*keys).orderBy(tile)
    for n, f in carried.items():  # later entries may build on earlier ones
        per_tile = per_tile.withColumn(n, f(order))
    per_tile = per_tile.select(*keys, tile, *carried)
    return df.join(per_tile, [*keys, tile])


def before(order):
    return order.rowsBetween(Window.unboundedPreceding, -1)


def islands(df: DataFrame, keys: list[str], pos: str, gap: int, tile: int = TILE) -> DataFrame:
    """Tag each distinct position with the first position of its island; neighbours over ``gap`` apart split.

    ``df`` must hold distinct (keys, pos).  Adds ``island``.
    """
    df = df.withColumn("_tile", tile_of(pos, tile))
    local = Window.partitionBy(*keys, "_tile").orderBy(pos)
    p = F.col(pos)
    df = df.withColumn("_prev", F.lag(pos).over(local))
    df = df.withColumn("_cut", F.when(F.col("_prev").isNotNull() & (p - F.col("_prev") > gap), p))
    head_is_cut = lambda o: F.coalesce(F.col("_first") - F.lag("_last").over(o) > gap, F.lit(True))
    # a tile's last known island start: its own inner cut, else its head when that starts an island
    df = df.groupBy(*keys, "_tile").agg(
        F.min(pos).alias("_first"), F.max(pos).alias("_last"), F.max("_cut").alias("_inner")
    ).transform(lambda s: _island_carry(s, keys, head_is_cut)).join(df, [*keys, "_tile"])
    own = F.max("_cut").over(local.rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("island", F.coalesce(own, F.when(F.col("_head_cut"), F.col("_first")), F.col("_carry"))).drop(
        "_tile", "_prev", "_cut", "_first", "_head_cut", "_carry")


def _island_carry(s: DataFrame, keys: list[str], head_is_cut) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy("_tile")
    s = s.withColumn("_head_cut", head_is_cut(order))
    s = s.withColumn("_open", F.coalesce("_inner", F.when(F.col("_head_cut"), F.col("_first"))))
    return s.select(*keys, "_tile", "_first", "_head_cut",
                    F.last("_open", ignorenulls=True).over(before(order)).alias("_carry"))


def interval_union(df: DataFrame, keys: list[str], lo: str = "lo", hi: str = "hi", *, adjacent: bool = False,
                   tile: int | None = TILE, extra: dict | None = None, merge: dict | None = None) -> DataFrame:
    """Merge intervals per key: ``lo <= reach`` joins, ``adjacent`` also joins ``lo == reach + 1``.

    ``tile=None`` skips the tiling for short axes (positions inside one insert or contig).  ``extra``
    are aggregates kept per distinct start and ``merge`` how they combine per merged interval.
    Returns keys, lo, hi and the merged extras.
    """
    extra, merge = extra or {}, merge or {}
    slack = 1 if adjacent else 0
    d = df.select(*keys, F.col(lo).cast("bigint").alias("lo"), F.col(hi).cast("bigint").alias("hi"),
                  *[c for c in df.columns if c not in (*keys, lo, hi)])
    d = d.groupBy(*keys, "lo").agg(F.max("hi").alias("hi"), *[e.alias(n) for n, e in extra.items()])
    d = d.withColumn("_tile", tile_of("lo", tile) if tile else F.lit(0).cast("bigint"))
    local = Window.partitionBy(*keys, "_tile").orderBy("lo")
    d = d.withColumn("_reach", F.max("hi").over(before(local)))
    if tile:
        d = carry(d, keys, {"_hi": F.max("hi")}, {"_before": lambda o: F.max("_hi").over(before(o))})
        d = d.withColumn("_reach", F.greatest("_reach", "_before")).drop("_before")
    starts = F.col("_reach").isNull() | (F.col("lo") > F.col("_reach") + slack)
    d = d.withColumn("_cut", F.when(starts, F.col("lo")))
    d = d.withColumn("_island", F.max("_cut").over(local.rowsBetween(Window.unboundedPreceding, 0)))
    if tile:
        d = carry(d, keys, {"_open": F.max("_cut")},
                  {"_carry": lambda o: F.last("_open", ignorenulls=True).over(before(o))})
        d = d.withColumn("_island", F.coalesce("_island", "_carry"))
    return d.groupBy(*keys, "_island").agg(F.max("hi").alias("hi"), *[e.alias(n) for n, e in merge.items()]).select(
        *keys, F.col("_island").alias("lo"), "hi", *merge)


def covered_bp(closed: bool) -> Column:
    return F.sum(F.col("hi") - F.col("lo") + (1 if closed else 0)).cast("bigint")


def bin_join(left: DataFrame, right: DataFrame, keys: list[str], left_span, right_span, condition: Column, *,
             width: int, how: str = "inner", salts: int = 1, salt_on: list[str] | None = None) -> DataFrame:
    """Interval join as an equi-join on coordinate bins.

    ``left_span``/``right_span`` are (low, high) closed integer expressions covering every position at
    which a row may match; a point has low == high.  With a point on the left the join may be an outer,
    semi or anti join.  Two real intervals meet in several bins and are kept in the first shared one.
    ``salts`` replicates the right (small) side and spreads the left rows of one bin over that many tasks.
    """
    def side(df, span, tag, point):
        lo, hi = span
        first = F.floor(lo / width)
        if point:
            return df.withColumn("_bin", first)
        df = df.withColumn(f"_{tag}_first", first).withColumn("_bin", F.explode(
            F.when(hi >= lo, F.sequence(first, F.floor(hi / width)))))
        return df

    point = left_span[0] is left_span[1]
    l = side(left, left_span, "l", point)
    r = side(right, right_span, "r", right_span[0] is right_span[1])
    on = [*keys, "_bin"]
    if salts > 1:
        l = l.withColumn("_salt", F.pmod(F.xxhash64(*(salt_on or left.columns)), F.lit(salts)).cast("int"))
        r = r.withColumn("_salt", F.explode(F.array(*[F.lit(i) for i in range(salts)])))
        on.append("_salt")
    renamed = r.select([F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in r.columns])
    cond = condition
    for c in on:
        cond = (F.col(c) == F.col(f"_r_{c}")) & cond
    if not point and right_span[0] is not right_span[1]:
        cond = cond & (F.col("_bin") == F.greatest("_l_first", "_r_first"))
    out = l.join(renamed, cond, how)
    return out.drop("_bin", "_salt", "_l_first", "_r_first", *[f"_r_{c}" for c in on])


def upper_median(df: DataFrame, keys: list[str], value: str, weight: str | None = None, out: str = "median") -> DataFrame:
    """Element ``n // 2`` of the sorted values per key, from a value histogram (combined map-side)."""
    n = F.sum(weight) if weight else F.count(F.lit(1))
    hist = df.groupBy(*keys, value).agg(n.alias("_n"))
    w = Window.partitionBy(*keys).orderBy(value)
    hist = hist.withColumn("_cum", F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    hist = hist.withColumn("_all", F.sum("_n").over(Window.partitionBy(*keys)))
    return hist.filter(F.col("_cum") > F.floor(F.col("_all") / 2)).groupBy(*keys).agg(
        F.min(value).alias(out), F.first("_all").cast("bigint").alias("n"))


def upper_median_agg(value) -> Column:
    """The same as an aggregate over few distinct values (state is one counter per distinct value)."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {value} DESC)")


def tile_entries(tiles: DataFrame, keys: list[str], states: int) -> DataFrame:
    """(keys, _tile, _slot): the state in which each tile is entered.

    ``tiles`` has one row per (keys, _tile) with ``_map``, the state it is left in for each of ``states`` entry states.  A tile that does
    not follow on another is entered in state 0.  Maps compose associatively, so they are scanned in rounds: FAN neighbours become one
    map, ROUNDS times, and on the way back every group hands its members their states.  No row holds more than FAN maps, however
    long the chromosome; tiles are numbered from 0 and fewer than FAN ** ROUNDS.
    """
    at = F.col("_tile").cast("bigint")
    level = tiles.select(*keys, at.alias("_at"), at.alias("_first"), at.alias("_last"), "_map")
    joins = lambda acc, x: F.coalesce(x["_first"] == acc["last"] + 1, F.lit(False))
    groups = []
    for _ in range(ROUNDS):
        members = F.sort_array(F.collect_list(F.struct("_at", "_first", "_last", "_map"))).alias("_members")
        g = level.groupBy(*keys, F.floor(F.col("_at") / FAN).cast("bigint").alias("_up")).agg(members)
        groups.append(g)
        through = F.aggregate("_members", F.struct(F.element_at("_members", 1)["_first"].alias("first"), (F.element_at("_members", 1)["_first"] - 1).alias("last"),
                                                   F.sequence(F.lit(0), F.lit(states - 1)).alias("map")),
                              lambda acc, x: F.struct(acc["first"].alias("first"), x["_last"].alias("last"), F.when(
                                  joins(acc, x), F.transform(acc["map"], lambda s: F.get(x["_map"], s))).otherwise(
                                  F.array_repeat(F.get(x["_map"], F.lit(0)), states)).alias("map")))
        level = g.select(*keys, F.col("_up").alias("_at"), through.alias("_t")).select(
            *keys, "_at", F.col("_t.first").alias("_first"), F.col("_t.last").alias("_last"), F.col("_t.map").alias("_map"))
    entered = groups[-1].withColumn("_slot", F.lit(0))
    for lower in [*reversed(groups[:-1]), None]:
        seed = F.struct((F.element_at("_members", 1)["_first"] - 1).alias("last"),
                        F.col("_slot").alias("slot"), F.array().cast("array<struct<at:bigint,slot:int>>").alias("out"))

        def step(acc, x):
            slot = F.when(joins(acc, x), acc["slot"]).otherwise(F.lit(0))
            return F.struct(x["_last"].alias("last"), F.get(x["_map"], slot).alias("slot"),
                            F.array_append(acc["out"], F.struct(x["_at"].alias("at"), slot.alias("slot"))).alias("out"))

        down = entered.select(*keys, F.explode(F.aggregate("_members", seed, step, lambda a: a["out"])).alias("_e"))
        if lower is not None:
            entered = lower.join(down.select(*keys, F.col("_e.at").alias("_up"), F.col("_e.slot").alias("_slot")), [*keys, "_up"])
    return down.select(*keys, F.col("_e.at").alias("_tile"), F.col("_e.slot").alias("_slot"))


def anchored_clusters(df: DataFrame, keys: list[str], pos: str, window: int, tile: int = FOLD_TILE) -> DataFrame:
    """Tag each distinct position with its cluster anchor.

    Scanning upwards, a position more than ``window`` above the current anchor becomes the next anchor.
    The scan is sequential, so each tile is folded on its own: a tile with a gap over ``window`` leaves the
    same last anchor whatever came before, and a tile without one is folded for each of its ``window + 2``
    possible entry states.  Scanning these maps of states gives every tile its true entry state.
    ``df`` holds distinct (keys, pos) plus any payload; adds ``anchor``.
    """
    assert window < tile
    df = df.withColumn("_tile", tile_of(pos, tile))
    tiles = df.groupBy(*keys, "_tile").agg(F.sort_array(F.collect_list(F.col(pos).cast("bigint"))).alias("_ps"))
    floor = F.col("_tile") * tile - 1

    def leave(entry: Column) -> Column:
        # ``reach`` = last anchor + window: positions up to it belong to that anchor
        return F.aggregate("_ps", entry, lambda reach, p: F.when(p > reach, p + window).otherwise(reach))

    breaks = F.exists(
        F.sequence(F.lit(1), F.size("_ps")),
        lambda i: F.get("_ps", i) - F.get("_ps", i - 1) > window)
    # a slot is how far a reach goes beyond the end of the tile before
    slot = lambda reach: F.greatest(reach - (floor + tile), F.lit(0)).cast("int")
    maps = tiles.withColumn("_map", F.when(F.coalesce(breaks, F.lit(False)), F.array_repeat(slot(leave(floor)), window + 2)).otherwise(
        F.transform(F.sequence(F.lit(0), F.lit(window + 1)), lambda i: slot(leave(floor + i)))))
    entries = tile_entries(maps.select(*keys, "_tile", "_map"), keys, window + 2).select(*keys, "_tile", (floor + F.col("_slot")).alias("_entry"))

    fold_seed = F.struct(F.col("_entry").alias("reach"), F.array().cast("array<bigint>").alias("anchors"))
    anchors = F.aggregate("_ps", fold_seed, lambda acc, p: F.when(p > acc["reach"], F.struct(
        (p + window).alias("reach"), F.array_append(acc["anchors"], p).alias("anchors"))).otherwise(acc),
        lambda acc: acc["anchors"])
    tagged = tiles.select(*keys, "_tile", "_ps").join(entries, [*keys, "_tile"]).select(
        *keys, "_tile", "_entry", anchors.alias("_anchors"))
    df = df.join(tagged, [*keys, "_tile"])
    own = F.array_max(F.filter("_anchors", lambda a: a <= F.col(pos)))
    return df.withColumn("anchor", F.coalesce(own, F.col("_entry") - window)).drop("_tile", "_entry", "_anchors")


def running_total(df: DataFrame, keys: list[str], order: str, value: str, tile: int, out: str) -> DataFrame:
    """Inclusive running sum over distinct ``order`` values, tile by tile."""
    df = df.withColumn("_tile", tile_of(order, tile))
    local = Window.partitionBy(*keys, "_tile").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("_part", F.sum(value).over(local))
    df = carry(df, keys, {"_sum": F.sum(value)}, {"_below": lambda o: F.sum("_sum").over(before(o))})
    return df.withColumn(out, F.col("_part") + F.coalesce("_below", F.lit(0))).drop("_tile", "_part", "_below")


def key_hashes(*keys: str) -> list[Column]:
    """Two 64-bit hashes ``_h1`` and ``_h2`` that stand for a key together."""
    return [F.xxhash64(*keys).alias("_h1"), F.xxhash64(F.lit(1), *reversed(keys)).alias("_h2")]


def keep_known(rows: DataFrame, keys: list[str], known: DataFrame) -> DataFrame:
    """The rows whose key is ``good`` in ``known``, a written table (_h1, _h2, good) with every key of ``rows`` once.

    The rows are not shuffled.  The smaller kind of keys is held as a bit table; the other keys that meet its bits by chance are held
    in a second one, keys of the first kind that meet these in a third, and so on until none is left, so the answer is exact.
    Where these tables would be too many or outgrow ``FILTER_BITS``, rows and keys are joined instead.
    """
    rows = rows.filter(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))
    n = {r["good"]: r["count"] for r in known.groupBy("good").count().collect()}
    side = n.get(True, 0) < n.get(False, 0)  # kind of key that the next table holds
    words, tables = np.zeros(1, np.int64), []

    def place(level: int, bits: int) -> Column:
        return F.xxhash64("_h1", "_h2", F.lit(level)).bitwiseAND(F.lit(bits - 1)).cast("int")

    def bit(i: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)  # by the last six bits of i

    def hits(level: int) -> Column:
        first, bits = tables[level]
        i = place(level, bits)
        return F.get("_words", F.shiftright(i, 6) + F.lit(first)).bitwiseAND(bit(i)) != 0

    def beside(df: DataFrame) -> DataFrame:
        one = df.sparkSession.createDataFrame(pa.table({"_words": pa.array([words], pa.list_(pa.int64()))}))
        return df.crossJoin(F.broadcast(one))

    while True:
        these = known.filter(F.col("good") == side)
        if tables:
            these = beside(these)
            for level in range(len(tables)):
                these = these.filter(hits(level))
        size = these.count()
        if not size:
            break
        bits = 1 << max(LEAST_BITS, (KEY_BITS * size - 1).bit_length())
        if len(tables) == MOST_TABLES or 64 * len(words) + bits > FILTER_BITS:
            good = known.filter("good").select("_h1", "_h2")
            return rows.select("*", *key_hashes(*keys)).join(good, ["_h1", "_h2"], "left_semi").drop("_h1", "_h2")
        i = F.col("i")
        set_bits = these.select(place(len(tables), bits).alias("i")).groupBy(F.shiftright(i, 6).alias("at")).agg(F.bit_or(bit(i)).alias("word")).toArrow()
        own = np.zeros(bits // 64, np.int64)
        own[set_bits["at"].to_numpy()] = set_bits["word"].to_numpy()
        tables.append((len(words), bits))
        words, side = np.r_[words, own], not side
    # a key that misses a table is not of its kind; one that misses none is of the kind of the last
    last = not side
    kind = [last == ((len(tables) - 1 - level) % 2 == 0) for level in range(len(tables))]
    good = F.lit(last)
    for level in reversed(range(len(tables))):
        good = F.when(hits(level), good).otherwise(not kind[level])
    return beside(rows.select("*", *key_hashes(*keys))).filter(good).drop("_words", "_h1", "_h2")

"""Greedy selections over element hits of an insert, and junction chaining.

Hits that repeat an interval cannot change a selection, so they are reduced to the first one before the shuffle and a hot
insert costs one row per distinct interval.  Everything is column code; an insert with many hits is thinned in rounds that
are spread over its positions.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from sitewright.operators.core import TILE, before, carry, islands, tile_of
from sitewright.operators.sites import site_ids
from sitewright.session import checkpoint

#: Open hits of one insert that are folded as one array; inserts with more are thinned first.
FOLD_ROWS = 5000


def distinct_intervals(hits: DataFrame, keys: list[str], start: str, end: str, order: list) -> DataFrame:
    rest = [c for c in hits.columns if c not in (*keys, start, end)]
    first = F.min_by(F.struct(*rest), F.struct(*order))
    return hits.groupBy(*keys, start, end).agg(first.alias("_h")).select(*keys, start, end, "_h.*")


def _pieces(lo: Column, hi: Column, levels: int) -> Column:
    """The aligned stretches of 1, 2, 4, ... positions that make up ``lo..hi - 1``, as (level, at): two of a level at most."""
    out = []
    for k in range(levels):
        a, b = F.ceil(lo / (1 << k)).cast("bigint"), F.floor(hi / (1 << k)).cast("bigint")
        piece = lambda odd, at: F.when((a < b) & (F.pmod(odd, F.lit(2)) == 1), F.struct(F.lit(k).alias("level"), at.alias("at")))  # noqa: B023, E731
        out += [piece(a, a), piece(b, b - 1)]
    return F.array_compact(F.array(*out))


def _around(at: Column, levels: int) -> Column:
    """The aligned stretch of every level that holds a position."""
    return F.array(*[F.struct(F.lit(k).alias("level"), F.floor(at / (1 << k)).cast("bigint").alias("at")) for k in range(levels)])


def best_first(rows: DataFrame, keys: list[str], order: list, max_overlap: float, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Rows (keys, ``_lo``, ``_hi`` half-open, ``_row`` payload) that are taken best first within their group.

    In ``order``, which must leave no ties, a row is dropped when more than ``max_overlap`` (half or more) of it lies inside one row
    taken before it.  Such a row holds the dropped one's middle, which makes the choice local: a row that is the best of all open
    rows over its own middle is taken whatever the others do, and rows it covers go.  Groups of over ``fold_rows`` open
    rows run rounds of that, all at once.  The best row over a middle comes from the minimum of each aligned stretch of positions, so
    no pair of rows is ever listed; at most two rows per doubling of length are taken over one position in a round.  What remains of a
    group is folded as one array.  A round takes the best row of each group at least; there are as many rounds as the longest chain of
    rows that wait for each other.  Rows without length are all taken; an empty table gives an empty result.
    """
    assert 0.5 <= max_overlap <= 1
    size = F.col("_hi") - F.col("_lo")
    middle = F.floor((F.col("_lo") + F.col("_hi")) / 2).cast("bigint")
    work = checkpoint(rows.select(*keys, "_lo", "_hi", F.struct(*[c.alias(f"k{i}") for i, c in enumerate(order)]).alias("_ord"), "_row"))

    def large(df: DataFrame) -> DataFrame:
        return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > fold_rows).drop("_n")

    def covers(k, lo, hi) -> Column:
        return F.least(hi, k["_hi"]) - F.greatest(lo, k["_lo"]) > F.greatest(F.lit(max_overlap) * (hi - lo), F.lit(0))

    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in keys]
    whole = work.filter("_hi > _lo")
    big = checkpoint(large(whole))
    if big.isEmpty():
        taken, rest = None, work
    else:
        is_big = lambda how: work.alias("w").join(big.alias("b"), same("w", "b"), how)
        taken, rest = is_big("left_semi").filter("NOT coalesce(_hi > _lo, false)"), is_big("left_anti")
        active = checkpoint(is_big("left_semi").filter("_hi > _lo").withColumn("_mid", middle))
        while not active.isEmpty():
            levels = active.agg(F.max(size)).first()[0].bit_length()
            bare = F.struct("_ord", "_lo", "_hi").alias("_best")
            pieces = lambda df: df.select(*keys, bare, F.explode(_pieces(F.col("_lo"), F.col("_hi"), levels)).alias("_at"))  # noqa: B023, E731
            points = active.select(*keys, "_mid").distinct().select(*keys, "_mid", F.explode(_around(F.col("_mid"), levels)).alias("_at"))
            on = [*same("p", "n"), F.col("p._at") == F.col("n._at")]
            over = lambda n: points.alias("p").join(n.alias("n"), on).select(*[f"p.{c}" for c in keys], "p._mid", "n._best")  # noqa: B023, E731
            best = over(pieces(active).groupBy(*keys, "_at").agg(F.min("_best").alias("_best"))).groupBy(*keys, "_mid").agg(F.min("_best").alias("_best"))
            tops = checkpoint(best.select(*keys, "_mid", "_best.*").filter(middle == F.col("_mid")))
            here = over(pieces(tops)).groupBy(*keys, "_mid").agg(F.collect_list("_best").alias("_tops"))
            gone = F.exists("_tops", lambda k: (k["_ord"] == F.col("_ord")) | ((k["_ord"] < F.col("_ord")) & covers(k, F.col("_lo"), F.col("_hi"))))
            new = active.alias("a").join(tops.alias("t"), [*same("a", "t"), F.col("a._mid") == F.col("t._mid"), F.col("a._ord") == F.col("t._ord")], "left_semi")
            new = new.drop("_mid")
            taken = taken.unionByName(new)
            met = active.alias("a").join(here.alias("h"), [*same("a", "h"), F.col("a._mid") == F.col("h._mid")], "left")
            left = checkpoint(met.filter(~F.coalesce(gone, F.lit(False))).select("a.*"))
            still = checkpoint(large(left))
            small = left.alias("w").join(still.alias("b"), same("w", "b"), "left_anti").drop("_mid")
            rest = rest.unionByName(small)
            active = left.alias("w").join(still.alias("b"), same("w", "b"), "left_semi")
    # a row without a known interval is never inside another
    need = F.coalesce(F.greatest(F.lit(max_overlap) * size, F.lit(0)), F.lit(float("inf"))).alias("_need")
    item = F.struct("_ord", "_lo", "_hi", need, "_row")
    per = rest.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_all"))
    none = F.filter("_all", lambda x: F.lit(False))
    fold = F.aggregate("_all", none, lambda acc, x: F.when(F.exists(acc, lambda k: (
        F.least(x["_hi"], k["_hi"]) - F.greatest(x["_lo"], k["_lo"])) > x["_need"]), acc).otherwise(F.array_append(acc, x)))
    out = per.select(*keys, F.explode(fold).alias("_x")).select(*keys, "_x._lo", "_x._hi", "_x._row")
    return out if taken is None else out.unionByName(taken.select(*keys, "_lo", "_hi", "_row"))


def _choose(hits: DataFrame, keys: list[str], lo: str, hi: str, closed: int, order: list, max_overlap: float, fold_rows: int) -> DataFrame:
    """``hits`` of distinct intervals ``lo``..``hi`` taken by ``best_first``."""
    rows = hits.select(*keys, F.col(lo).cast("bigint").alias("_lo"), (F.col(hi) + closed).cast("bigint").alias("_hi"),
                       F.struct(*[c for c in hits.columns if c not in keys]).alias("_row"), *[c.alias(f"_o{i}") for i, c in enumerate(order)])
    return best_first(rows, keys, [F.col(f"_o{i}") for i in range(len(order))], max_overlap, fold_rows).select(*keys, "_row.*").select(*hits.columns)


def merge_annotations(local: DataFrame, remote: DataFrame, max_overlap: float = 0.80, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Best hits per insert region: by bit score (catalogue first on ties), dropped when more than ``max_overlap`` of the
    hit lies in one kept hit."""
    rows = local.withColumn("source", F.lit("element_db")).unionByName(remote.withColumn("source", F.lit("ncbi_nt")))
    rows = rows.withColumns({"lo": F.least("q_start", "q_end"), "hi": F.greatest("q_start", "q_end"), "_src": F.when(F.col("source") == "element_db", 0).otherwise(1)})
    keys = ["sample", "query"]
    order = [-F.col("bitscore"), F.col("_src"), F.col("line_no")]
    rows = distinct_intervals(rows, keys, "lo", "hi", order)
    return _choose(rows, keys, "lo", "hi", 1, order, max_overlap, fold_rows).drop("_src")


def dedupe_elements(hits: DataFrame) -> DataFrame:
    """By start: a hit that overlaps kept ones replaces the first of them if longer, else it is dropped.

    Of the hits of one start only the longest can matter, so an insert has at most as many rows as positions.  By start, a hit can
    overlap only the hit kept last, so the fold holds one open hit.  A hit without length comes after the others of its
    start; it is dropped inside the open hit and kept elsewhere.
    """
    keys = ["sample", "query"]
    size = F.col("q_end") - F.col("q_start")
    rest = [c for c in hits.columns if c not in (*keys, "q_start", "q_end")]
    rows = hits.groupBy(*keys, "q_start", (size <= 0).alias("_flat")).agg(
        F.min_by(F.struct(F.col("q_end"), *rest), F.struct((-size).alias("n"), F.col("line_no").alias("l"))).alias("_h"))
    item = F.struct(F.col("q_start").alias("lo"), F.col("_flat").alias("flat"), F.col("_h.q_end").alias("hi"), F.col("_h").alias("row"))
    per = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("_all"))
    head = F.get("_all", F.lit(0))
    seed = F.struct(F.when(F.lit(False), head).alias("open"), F.filter("_all", lambda x: F.lit(False)).alias("out"))

    def step(acc, x):
        o = acc["open"]
        over = F.coalesce((x["lo"] < o["hi"]) & (x["hi"] > o["lo"]), F.lit(False))
        state = lambda now, out: F.struct(now.alias("open"), out.alias("out"))
        closed = F.when(o.isNull(), acc["out"]).otherwise(F.array_append(acc["out"], o))
        return F.when(over & (x["hi"] - x["lo"] > o["hi"] - o["lo"]), state(x, acc["out"])).when(over, acc).when(
            x["flat"], state(o, F.array_append(acc["out"], x))).otherwise(state(x, closed))

    kept = F.aggregate("_all", seed, step, lambda a: F.when(a["open"].isNull(), a["out"]).otherwise(F.array_append(a["out"], a["open"])))
    out = per.select(*keys, F.explode(kept).alias("_x")).select(*keys, F.col("_x.lo").alias("q_start"), "_x.row.*")
    return out.select(*hits.columns)


def filter_overlaps(hits: DataFrame, max_overlap: float = 0.5, skip_empty: bool = False, fold_rows: int = FOLD_ROWS) -> DataFrame:
    """Longest first: a hit with more than ``max_overlap`` of itself inside a kept hit is dropped."""
    keys = ["sample", "query"]
    if skip_empty:
        hits = hits.filter("q_end > q_start")
    rows = distinct_intervals(hits, keys, "q_start", "q_end", [F.col("line_no")])
    return _choose(rows, keys, "q_start", "q_end", 0, [F.col("q_start") - F.col("q_end"), F.col("line_no")], max_overlap, fold_rows)


def cassettes(hits: DataFrame) -> DataFrame:
    """Promoter-terminator cassettes: each promoter by start takes the nearest unused terminator downstream.

    ``hits`` are overlap-filtered, so an insert holds few of them; columns sample, query, q_start, q_end, category, short_name.
    """
    item = F.struct(F.col("q_start").alias("s"), F.col("q_end").alias("e"), F.col("short_name").alias("n"))
    of = lambda c: F.array_sort(F.collect_list(F.when(F.col("category") == c, item)))
    per = hits.groupBy("sample", "query").agg(of("promoter").alias("_p"), of("terminator").alias("_t"), of("coding").alias("_c"))
    per = per.filter((F.size("_p") > 0) & (F.size("_t") > 0)).withColumn(
        "_t", F.transform("_t", lambda x, i: F.struct(i.alias("i"), x["s"].alias("s"), x["e"].alias("e"), x["n"].alias("n"))))
    kind = "array<struct<promoter:string,terminator:string,q_start:bigint,q_end:bigint>>"
    seed = F.struct(F.array().cast("array<int>").alias("used"), F.array().cast(kind).alias("out"))

    def step(acc, p):
        free = F.filter("_t", lambda t: (t["s"] > p["e"]) & ~F.array_contains(acc["used"], t["i"]))
        best = F.array_min(F.transform(free, lambda t: F.struct((t["s"] - p["e"]).alias("d"), t["i"].alias("i"), t["e"].alias("e"), t["n"].alias("n"))))
        row = F.struct(p["n"].alias("promoter"), best["n"].alias("terminator"), p["s"].cast("bigint").alias("q_start"), best["e"].cast("bigint").alias("q_end"))
        return F.when(best.isNull(), acc).otherwise(F.struct(F.array_append(acc["used"], best["i"]).alias("used"), F.array_append(acc["out"], row).alias("out")))

    rows = per.select("sample", "query", "_c", F.explode(F.aggregate("_p", seed, step, lambda a: a["out"])).alias("k")).select("sample", "query", "_c", "k.*")
    inside = F.filter("_c", lambda c: (c["s"] >= F.col("q_start")) & (c["e"] <= F.col("q_end")))
    return rows.withColumn("cds", F.transform(inside, lambda c: c["n"])).drop("_c")


def pair_junctions(j: DataFrame, reach: int = 50_000, tile: int = TILE) -> DataFrame:
    """Sites from sorted junctions: each unused junction takes the next one within ``reach``.

    In position order the next junction is always still free, so pairs are (1st, 2nd), (3rd, 4th), ... inside every run of
    junctions whose neighbours are within ``reach`` of each other; ranks come from tile counts, not from one window.
    """
    keys = ["sample", "chrom"]
    rows = islands(j.select(*keys, "pos", "line_no"), keys, "pos", reach).withColumn("_tile", tile_of("pos", tile))
    local = Window.partitionBy(*keys, "_tile").orderBy("pos", "line_no")
    rows = rows.withColumn("_n", F.row_number().over(local))
    rows = carry(rows, keys, {"_count": F.count(F.lit(1))}, {"_below": lambda o: F.coalesce(F.sum("_count").over(before(o)), F.lit(0))})
    rows = rows.withColumn("_rank", F.col("_n") + F.col("_below"))
    first = rows.groupBy(*keys, "island").agg(F.min("_rank").alias("_first"))
    rows = rows.join(first, [*keys, "island"]).withColumn("_pair", F.floor((F.col("_rank") - F.col("_first")) / 2))
    sites = rows.groupBy(*keys, "island", "_pair").agg(F.min("pos").alias("pos_5p"), F.max("pos").alias("_hi"), F.count(F.lit(1)).alias("_k"), F.min("_rank").alias("_at"))
    sites = sites.select(*keys, "pos_5p", F.when(F.col("_k") > 1, F.col("_hi")).otherwise(0).alias("pos_3p"), "_at")
    return site_ids(sites, "pos_5p", [F.col("_at")]).drop("_at")

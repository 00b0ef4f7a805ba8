"""From clipped reads to ranked, masked and tiered insertion sites."""
from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from sitewright.functions import clip_left_len, clip_right_len, left_clip_seq, right_clip_seq, src_tag, src_tier, strip_src_tag
from sitewright.functions.names import SRC_TIERS
from sitewright.operators.core import TILE, anchored_clusters, bin_join, islands, scope, tile_of
from sitewright.operators.reads import primary
from sitewright.session import checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MASKED = "FALSE_NEGATIVE_MASKED"
SIDE = ["sample", "chrom", "side"]


def soft_clips(alignments: DataFrame, min_clip: int = 20) -> DataFrame:
    """One row per clipped read end: side, clip position (0-based reference end or start) and clipped bases."""
    end = lambda side, pos, clip: F.struct(F.lit(side).alias("side"), F.col(pos).cast("bigint").alias("pos"), clip.alias("clip"))
    right = F.when(clip_right_len("cigar") >= min_clip, end("right", "ref_end", right_clip_seq("cigar", "seq")))
    left = F.when(clip_left_len("cigar") >= min_clip, end("left", "ref_start", left_clip_seq("cigar", "seq")))
    clipped = primary(alignments).filter(F.contains("cigar", F.lit("S")))
    return clipped.select("sample", "qname", "chrom", F.explode(F.array_compact(F.array(right, left))).alias("c")).select(
        "sample", "qname", "chrom", "c.*")


def _weighted_upper_median(pairs: Column) -> Column:
    """Upper median of a short sorted array of (pos, n)."""
    half = F.floor(F.aggregate(pairs, F.lit(0).cast("bigint"), lambda a, x: a + x["n"]) / 2)
    seed = F.struct(F.lit(0).cast("bigint").alias("cum"), F.lit(None).cast("bigint").alias("at"))
    return F.aggregate(pairs, seed, lambda a, x: F.struct(
        (a["cum"] + x["n"]).alias("cum"),
        F.coalesce(a["at"], F.when(a["cum"] + x["n"] > half, x["pos"])).alias("at")), lambda a: a["at"])


def softclip_clusters(clips: DataFrame, window: int = 50, min_depth: int = 3) -> DataFrame:
    """Anchored clusters per chromosome and side.

    Reads are reduced to (position, count) before the fold, so a pile-up costs one row per position.
    """
    counts = clips.groupBy(*SIDE, "pos").agg(F.count(F.lit(1)).alias("n"))
    tagged = anchored_clusters(counts, SIDE, "pos", window)
    pairs = F.sort_array(F.collect_list(F.struct("pos", "n")))  # at most window + 1 entries
    out = tagged.groupBy(*SIDE, "anchor").agg(F.sum("n").alias("n_reads"), pairs.alias("_pairs"))
    return out.filter(F.col("n_reads") >= min_depth).select(
        *SIDE, "anchor", _weighted_upper_median(F.col("_pairs")).alias("position"), "n_reads", F.col("_pairs.pos").alias("positions"))


def base_votes(seqs: DataFrame, keys: list[str], seq: str, from_end: Column | None = None, weight: str | None = None) -> DataFrame:
    """Counts per offset and base; ``from_end`` marks rows whose offsets run from the right, a row counts ``weight`` times.

    Identical texts of a group collapse to one weighted row before their bases are spread out.
    """
    rev = from_end if from_end is not None else F.lit(False)
    texts = seqs.groupBy(*keys, rev.alias("_rev"), F.upper(F.col(seq)).alias("_t")).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("_w"))
    rows = texts.select(*keys, F.length("_t").alias("_len"), "_rev", "_w", F.posexplode(F.split("_t", "")).alias("_i", "base"))
    off = F.when(F.col("_rev"), F.col("_len") - 1 - F.col("_i")).otherwise(F.col("_i"))
    return rows.filter(F.col("base") != "").select(*keys, off.alias("off"), "base", "_w").groupBy(*keys, "off", "base").agg(
        F.sum("_w").alias("n"))


def vote(votes: DataFrame, keys: list[str], min_share: float, min_total: int = 2) -> DataFrame:
    """Winning base per offset as an ordered array; NULL base where support or share is too low."""
    per = votes.groupBy(*keys, "off", "base").agg(F.sum("n").alias("n")).groupBy(*keys, "off").agg(
        F.sum("n").alias("total"), F.max("n").alias("top"), F.max_by("base", "n").alias("best"))
    ok = (F.col("total") >= min_total) & (F.col("top") / F.col("total") >= min_share)
    return per.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("off", F.when(ok, F.col("best")).alias("b")))).alias("_v"))


def _prefix(v: str = "_v") -> Column:
    text = F.array_join(F.transform(v, lambda x: F.coalesce(x["b"], F.lit("."))), "")
    return F.regexp_extract(text, r"^([^.]*)", 1)


def _right_aligned(v: str = "_v") -> Column:
    text = F.reverse(F.array_join(F.transform(v, lambda x: F.coalesce(x["b"], F.lit("N"))), ""))
    return F.regexp_replace(F.regexp_replace(text, "^N+", ""), "N+$", "")


def cluster_consensus(clips: DataFrame, clusters: DataFrame, min_share: float = 0.51, salts: int = 8) -> DataFrame:
    """Consensus of each kept cluster.

    Clips outside kept clusters go first, by a semi-join against the few kept positions (replicated over ``salts``, so that a
    pile-up at one position is shared); votes are then counted per position before they meet their cluster.
    """
    member = clusters.select(*SIDE, "anchor", F.explode("positions").alias("pos"))
    spots = member.select(*SIDE, "pos", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    kept = clips.withColumn("_salt", F.pmod(F.xxhash64("qname"), F.lit(salts)).cast("int")).join(spots, [*SIDE, "pos", "_salt"], "left_semi")
    votes = base_votes(kept, [*SIDE, "pos"], "clip", F.col("side") == "left")
    joined = votes.join(member, [*SIDE, "pos"]).drop("pos")
    seqs = vote(joined, [*SIDE, "anchor"], min_share)
    cons = F.when(F.col("side") == "right", _prefix()).otherwise(_right_aligned())
    return clusters.drop("positions").join(seqs.select(*SIDE, "anchor", cons.alias("consensus")), [*SIDE, "anchor"])


def vote_extension(tails: DataFrame, keys: list[str], seq: str, min_depth: int = 2, min_share: float = 0.6) -> DataFrame:
    """Consensus of tails that all start at the extension boundary."""
    out = vote(base_votes(tails, keys, seq), keys, min_share, min_depth)
    return out.select(*keys, _prefix().alias("extension"))


PAIR_SCHEMA = ("sample string, chrom string, r_anchor long, r_pos long, r_reads long, r_seed string, "
               "l_anchor long, l_pos long, l_reads long, l_seed string")


def _pair_rows(pos: np.ndarray, left: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(right rows, their left rows or -1): each right row in order takes the nearest left row that is still free, of two the lower one."""
    lefts, rights = np.flatnonzero(left), np.flatnonzero(~left)
    at, own = pos[lefts], pos[rights]
    first, last = np.searchsorted(at, own - window).tolist(), np.searchsorted(at, own + window, "right").tolist()
    at, own = at.tolist(), own.tolist()
    mate, used = np.full(len(rights), -1), bytearray(len(at))
    for k, x in enumerate(own):
        best, least = -1, window + 1
        for i in range(first[k], last[k]):
            if used[i]:
                continue
            if abs(at[i] - x) < least:
                best, least = i, abs(at[i] - x)
            elif at[i] > x:
                break
        if best >= 0:
            used[best] = 1
            mate[k] = lefts[best]
    return rights, mate


def _pair_pass(window: int, width: int | None):
    """Rows (sample, chrom, side, anchor, position, n_reads, consensus) ordered by chromosome and position to pairs.  With ``width``, rows
    come in tiles of that width, and islands that may go on in the next tile come out unpaired and open."""

    def step(b, name):
        code = b.column(name).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        return code[1:] != code[:-1]

    def starts(b, before):
        """Whether a row begins an island; ``before`` is the last row ahead of the batch."""
        pos = b.column("position").to_numpy()
        jump = (np.diff(pos) > window) | step(b, "sample") | step(b, "chrom")
        head = before is None or (b.column("sample")[0].as_py(), b.column("chrom")[0].as_py()) != before[:2] or pos[0] - before[2] > window
        if width:
            jump |= np.diff(pos // width) != 0
            head = head or pos[0] // width != before[2] // width
        return np.concatenate([[head], jump])

    def settle(held):
        b = pa.concat_batches(held)
        new, pos = starts(b, None), b.column("position").to_numpy()
        left = pc.equal(b.column("side"), "left").to_numpy(zero_copy_only=False)
        island = np.cumsum(new) - 1
        low = np.flatnonzero(new)
        opened = np.zeros(len(low), bool)
        if width:
            opened = (pos[low] % width < window) | (width - pos[np.append(low[1:], len(pos)) - 1] % width <= window)
        opened = opened[island]
        # distances inside an island stay as they are, islands are out of reach of each other
        axis = np.cumsum(np.where(new, window + 1, np.diff(pos, prepend=pos[0])))
        shut = np.flatnonzero(~opened)
        rights, mate = _pair_rows(axis[shut], left[shut], window)
        mate = np.where(mate >= 0, shut[mate] if len(shut) else mate, -1)
        alone = np.setdiff1d(shut[left[shut]], mate)
        some = np.flatnonzero(opened)
        r = np.concatenate([shut[rights], np.full(len(alone), -1), np.where(left[some], -1, some)])
        l = np.concatenate([mate, alone, np.where(left[some], some, -1)])
        row = b.take(pa.array(np.where(r >= 0, r, l)))
        half = lambda at: [b.column(c).take(pa.array(at, mask=at < 0)) for c in ("anchor", "position", "n_reads", "consensus")]
        is_open = np.arange(len(r)) >= len(r) - len(some)
        return pa.RecordBatch.from_arrays([row.column("sample"), row.column("chrom"), *half(r), *half(l), pa.array(is_open)],
                                          [*(c.split()[0] for c in PAIR_SCHEMA.split(", ")), "open"])

    def run(batches):
        held, before = [], None
        for b in batches:
            if not b.num_rows:
                continue
            cut = np.flatnonzero(starts(b, before))
            if len(cut):
                if held or cut[-1]:
                    yield settle([*held, b.slice(0, cut[-1])])
                held, b = [], b.slice(cut[-1])
            held.append(b)
            before = tuple(b.column(c)[b.num_rows - 1].as_py() for c in ("sample", "chrom", "position"))
        if held:
            yield settle(held)

    return run


def pair_clusters(clusters: DataFrame, window: int = 50) -> DataFrame:
    """Each right cluster, in position order, takes the nearest unused left cluster within ``window``.

    Clusters more than ``window`` apart cannot compete, so islands are independent.  Tiles of a chromosome are read in order, and each
    island is paired as it ends; only islands at the edge of a tile are put together first.  Every cluster leaves once, paired (both halves filled) or alone.
    """
    keys, schema = ["sample", "chrom"], PAIR_SCHEMA + ", open boolean"
    if "consensus" not in clusters.columns:
        clusters = clusters.withColumn("consensus", F.lit(None).cast("string"))
    rows = clusters.select(*keys, "side", *[F.col(c).cast("bigint").alias(c) for c in ("anchor", "position", "n_reads")], "consensus")
    dealt = rows.withColumn("_tile", tile_of("position", TILE)).repartition(*keys, "_tile").sortWithinPartitions(*keys, "position", "anchor")
    found = checkpoint(dealt.drop("_tile").mapInArrow(_pair_pass(window, TILE), schema))
    whole, edge = found.filter("NOT open").drop("open"), found.filter("open")
    if not edge.head(1):
        return whole
    side = F.when(F.col("r_pos").isNotNull(), "right").otherwise("left").alias("side")
    either = {"anchor": "anchor", "position": "pos", "n_reads": "reads", "consensus": "seed"}
    again = edge.select(*keys, side, *[F.coalesce(f"r_{c}", f"l_{c}").alias(n) for n, c in either.items()])
    # as a struct, a null sample or chromosome equals itself
    again = islands(again.withColumn("_key", F.struct(*keys)), ["_key"], "position", window).repartition(*keys, "island").sortWithinPartitions(*keys, "position", "anchor")
    return whole.unionByName(again.select(*rows.columns).mapInArrow(_pair_pass(window, None), schema).drop("open"))


def insertion_sites(pairs: DataFrame, min_clip: int = 20, single_depth: int = 5) -> DataFrame:
    """Paired sites, then unpaired clusters of at least ``single_depth`` reads, with unique ids.

    A pair whose consensus is too short is dropped together with both clusters.  A lone left cluster keeps its
    position in ``pos_5p``.
    """
    has_r, has_l = F.col("r_pos").isNotNull(), F.col("l_pos").isNotNull()
    long_r, long_l = F.length("r_seed") >= min_clip, F.length("l_seed") >= min_clip
    keep = F.when(has_r & has_l, long_r & long_l).when(has_r, long_r & (F.col("r_reads") >= single_depth)).otherwise(
        long_l & (F.col("l_reads") >= single_depth))
    base = F.least("r_pos", "l_pos")
    sites = pairs.filter(keep).select(
        "sample", "chrom", base.alias("base_pos"), has_r.alias("has_r"), has_l.alias("has_l"), "r_pos", "l_pos",
        F.col("r_seed").alias("seed_5p"), F.col("l_seed").alias("seed_3p"), F.coalesce("r_reads", F.lit(0)).alias("reads_5p"),
        F.coalesce("l_reads", F.lit(0)).alias("reads_3p"), base.alias("pos_5p"),
        F.when(has_r & has_l, F.greatest("r_pos", "l_pos")).alias("pos_3p"))
    return site_ids(sites, "base_pos", [(~F.col("has_r")).cast("int"), F.col("r_pos"), F.col("l_pos")]).drop("base_pos", "r_pos", "l_pos")


def site_ids(sites: DataFrame, pos: str, order: list[Column]) -> DataFrame:
    """``insertion_<chrom>_<pos>``; further sites at the same place get ``_2``, ``_3``, ..."""
    from pyspark.sql import Window

    n = F.row_number().over(Window.partitionBy("sample", "chrom", pos).orderBy(*order))
    suffix = F.when(n > 1, F.concat(F.lit("_"), n.cast("string"))).otherwise("")
    return sites.withColumn("site_id", F.concat(F.lit("insertion_"), "chrom", F.lit("_"), F.col(pos).cast("string"), suffix))


def find_clusters(alignments: DataFrame, min_clip: int = 20, window: int = 50, min_depth: int = 3) -> DataFrame:
    """Clusters with consensus.  The alignment table is scanned once: its clipped ends are written out as a stage."""
    clips = checkpoint(soft_clips(alignments, min_clip))
    return cluster_consensus(clips, checkpoint(softclip_clusters(clips, window, min_depth)))


def find_sites(alignments: DataFrame, min_clip: int = 20, window: int = 50, min_depth: int = 3) -> DataFrame:
    """Clips to candidate sites; the cluster and site tables are small stages of their own."""
    clusters = checkpoint(find_clusters(alignments, min_clip, window, min_depth))
    return checkpoint(insertion_sites(pair_clusters(clusters, window), min_clip))


def validate_sites(sites: DataFrame, host_clips: DataFrame, element_clips: DataFrame) -> DataFrame:
    """Keep pairs of different clips that are absent from the host (high) and lone clips with an element hit (medium).

    ``host_clips`` and ``element_clips`` hold (sample, qname) of clip queries named ``<site>_5p``, ``_3p`` or ``_clip``.
    """
    def flags(names: DataFrame, tag: str) -> DataFrame:
        site = F.regexp_replace("qname", "_(5p|3p|clip)$", "")
        return names.groupBy("sample", site.alias("site_id")).agg(F.lit(True).alias(f"any_{tag}"), *[
            F.max(F.endswith("qname", F.lit(f"_{e}"))).alias(f"{tag}_{e}") for e in ("5p", "3p", "clip")])

    paired = F.col("has_r") & F.col("has_l")
    n = F.least(F.lit(20), F.length("seed_5p"), F.length("seed_3p"))
    differ = F.substring("seed_5p", F.lit(1), n) != F.substring("seed_3p", F.lit(1), n)
    off = lambda c: F.coalesce(F.col(c), F.lit(False))
    rows = sites.filter(~paired | differ).join(flags(host_clips, "host"), ["sample", "site_id"], "left").join(
        flags(element_clips, "el"), ["sample", "site_id"], "left")
    hit = F.when(paired, off("el_5p") | off("el_3p")).otherwise(off("el_clip"))
    keep = F.when(paired, ~(off("host_5p") | off("host_3p"))).otherwise(hit)
    return rows.filter(keep).select(*sites.columns, hit.alias("has_element_hits"),
                                    F.when(paired, "high").otherwise("medium").alias("confidence"))


def rank_keys() -> list[Column]:
    conf = F.when(F.col("confidence") == "high", 0).when(F.col("confidence") == "medium", 1).otherwise(2)
    return [F.when(F.col("has_element_hits"), 0).otherwise(1), conf, -(F.col("reads_5p") + F.col("reads_3p"))]


def rank_sites(sites: DataFrame) -> DataFrame:
    """Rank per sample: element hits first, then confidence, then read support (ties by id).

    The sites are written in ranges of (sample, keys, id) drawn from a sample of them, equal keys in one range.  Rank = sites of the
    sample in earlier ranges + place inside the range, so no window holds a whole sample, nor all sites of equal support.
    """
    from pyspark.sql import Window

    names = ["_el", "_conf", "_support"]
    ranges = int(sites.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sites.withColumns(dict(zip(names, rank_keys()))).repartitionByRange(ranges, "sample", *names, "site_id")
    # the number of a range is fixed once it is written
    rows = checkpoint(rows.withColumn("_range", F.spark_partition_id()))
    w = Window.partitionBy("sample").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    earlier = rows.groupBy("sample", "_range").agg(F.count(F.lit(1)).alias("_n")).select(
        "sample", "_range", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_above"))
    place = F.row_number().over(Window.partitionBy("sample", "_range").orderBy(*names, "site_id"))
    return rows.withColumn("_place", place).join(earlier, ["sample", "_range"]).withColumn(
        "site_rank", F.col("_above") + F.col("_place")).drop(*names, "_range", "_place", "_above")


def apply_mask(sites: DataFrame, bed: DataFrame, keys=("sample", "site_id")) -> DataFrame:
    """Tag sites inside a half-open mask interval with the name of the interval that starts last.

    Distinct positions meet distinct intervals, so neither many sites of one position nor copies of an interval multiply.
    """
    rows = sites.withColumn("_pos", F.coalesce(F.nullif("pos_5p", F.lit(0)), F.col("pos_3p")))
    p, own = F.col("_pos"), [*scope(rows, bed), "chrom"]
    iv = bed.select(*own, F.col("start_pos").alias("_s"), F.col("end_pos").alias("_e"), F.col("name").alias("_name"), F.col("line_no").alias("_line"))
    iv = iv.groupBy(*own, "_s", "_e").agg(F.max_by("_name", "_line").alias("_name"), F.max("_line").alias("_line"))
    spots = rows.select(*own, "_pos").distinct()
    hits = bin_join(spots, iv, own, (p, p), (F.col("_s"), F.col("_e") - 1), (F.col("_s") <= p) & (p < F.col("_e")), width=4096)
    last = F.struct("_s", "_line")
    there = hits.groupBy(*own, "_pos").agg(F.max_by("_name", last).alias("_name"), F.max(last).alias("_last"))
    near = rows.select(*dict.fromkeys([*keys, *own, "_pos"])).join(there, [*own, "_pos"])
    best = near.groupBy(*keys).agg(F.max_by("_name", "_last").alias("mask_element"))
    out = rows.drop("_pos").join(best, list(keys), "left")
    return out.withColumn("mask_tier", F.when(F.col("mask_element").isNotNull(), MASKED))


def best_hit(hits: DataFrame, min_identity: float = 80, min_len: int = 20, tiers: dict | None = None, default_src: str = "element_db") -> DataFrame:
    """Best hit per clip: source tier, then bit score, then the earlier row."""
    ok = (F.col("pident") >= min_identity) & (F.col("length") >= min_len)
    src = src_tag("sseqid", default_src)
    order = F.struct((-src_tier(src, tiers)).alias("t"), (-F.col("bitscore")).alias("b"), "db_idx", "line_no")
    best = F.min_by(F.struct(strip_src_tag("sseqid").alias("element"), "pident", "length", src.alias("source"), "bitscore"), order)
    return hits.filter(ok).groupBy("sample", "qseqid").agg(best.alias("b")).select("sample", "qseqid", "b.*")


def host_endogenous(hits: DataFrame) -> DataFrame:
    """Catalogue ids that match the host (T1: 90/50, T2: 75/30 identity/coverage), label of the last such hit."""
    t1 = (F.col("pident") >= 90) & (F.col("qcov") >= 50)
    t2 = (F.col("pident") >= 75) & (F.col("qcov") >= 30)
    return hits.filter(t1 | t2).groupBy(*(["host"] if "host" in hits.columns else []), "qseqid").agg(F.max_by(F.when(t1, "T1").otherwise("T2"), "line_no").alias("label"))


def drop_endogenous(elements: DataFrame, endogenous: DataFrame, name: str = "qseqid") -> DataFrame:
    own = scope(elements, endogenous)
    return elements.join(endogenous.select(*own, F.col("qseqid").alias(name)), [*own, name], "left_anti")


def drop_host_clips(best: DataFrame, host_hits: DataFrame, min_identity: float = 95, min_len: int = 30) -> DataFrame:
    """Best hits of clips that do not also match the host."""
    bad = host_hits.filter((F.col("pident") >= min_identity) & (F.col("length") >= min_len)).select("sample", "qseqid").distinct()
    return best.join(bad, ["sample", "qseqid"], "left_anti")


def site_tiers(sites: DataFrame, best: DataFrame, tiers: dict | None = None) -> DataFrame:
    """Tier table: positive when either end's best hit comes from a tier-2 source; masked sites keep their tag instead."""
    strong = [k for k, v in (tiers or SRC_TIERS).items() if v >= 2]
    end = F.substring("qseqid", -2, 2)
    ends = best.filter(F.col("qseqid").rlike("_(5p|3p)$")).groupBy(
        "sample", F.expr("substring(qseqid, 1, length(qseqid) - 3)").alias("site_id")).agg(*[
            F.max(F.when(end == e, F.struct("element", "pident", "length", "source"))).alias(f"h{e}") for e in ("5p", "3p")])
    rows = sites.join(ends, ["sample", "site_id"], "left")
    masked = F.col("mask_tier").isNotNull()
    shown = {"element": F.col("mask_element"), "source": F.col("mask_tier")}
    hit = lambda e, f, default: F.when(masked, shown.get(f, F.lit(default))).otherwise(F.coalesce(F.col(f"h{e}.{f}"), F.lit(default)))
    cols = []
    for e in ("5p", "3p"):
        cols += [hit(e, "element", "").alias(f"hit_{e}"), hit(e, "pident", 0.0).alias(f"hit_{e}_identity"),
                 hit(e, "length", 0).cast("bigint").alias(f"hit_{e}_aln_len"), hit(e, "source", "").alias(f"hit_{e}_source")]
    out = rows.select(
        "sample", "site_id", "chrom", F.coalesce(F.nullif("pos_5p", F.lit(0)), F.col("pos_3p"), F.lit(0)).alias("pos"),
        F.coalesce(F.length("seed_5p"), F.lit(0)).alias("clip_5p_len"), F.coalesce(F.length("seed_3p"), F.lit(0)).alias("clip_3p_len"),
        *cols, "mask_tier", "mask_element")
    positive = F.col("hit_5p_source").isin(strong) | F.col("hit_3p_source").isin(strong)
    return out.withColumn("transgene_positive", positive)


def seeds_at(alignments: DataFrame, sites: DataFrame, window: int = 10, min_clip: int = 15, flank: int = 200, salts: int = 8) -> DataFrame:
    """Longest consensus seed per site and side over the site's positions (``sites``: sample, site_id, chrom, pos_idx, pos)."""
    clips = soft_clips(alignments, min_clip).withColumnRenamed("pos", "clip_pos")
    at = F.col("clip_pos")
    near = bin_join(clips, sites.select("sample", "chrom", "site_id", "pos_idx", "pos"), ["sample", "chrom"], (at, at),
                    (F.col("pos") - window, F.col("pos") + window), F.abs(at - F.col("pos")) <= window, width=1024,
                    salts=salts, salt_on=["qname"])
    keys = ["sample", "site_id", "side", "pos_idx"]
    n = near.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_reads")).filter("n_reads >= 2")
    seqs = vote(base_votes(near, keys, "clip", F.col("side") == "left"), keys, 0.51)
    seed = F.when(F.col("side") == "right", _prefix()).otherwise(_right_aligned())
    rows = seqs.select(*keys, seed.alias("seed")).join(n, keys).filter(F.length("seed") >= min_clip)
    order = F.struct(F.length("seed").alias("l"), (-F.col("pos_idx")).alias("i"))
    return rows.groupBy("sample", "site_id", "side").agg(F.max_by("seed", order).alias("seed"), F.max_by("n_reads", "pos_idx").alias("n_reads"))

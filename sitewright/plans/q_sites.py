"""Insertion-site discovery: AG1, AG7-9, AG40, RJ4, RJ10, RJ20, RJ21, WN1, WN4, WN12, DT4, DT5 and the flagship."""
from __future__ import annotations

from pyspark.sql import functions as F

from sitewright.operators import core, sites as st
from sitewright.operators.similarity import kmer_hits
from sitewright.plans.q_annotations import hits_sql
from sitewright.plans.q_reads import lines
from sitewright.plans.registry import fragment, query
from sitewright.session import checkpoint

_LC = r"coalesce(TRY_CAST(regexp_extract(cigar,'^(\d+)S',1) AS INTEGER),0)"
_RC = r"coalesce(TRY_CAST(regexp_extract(cigar,'(\d+)S$',1) AS INTEGER),0)"


def clips_sql(min_clip):
    return f"""SELECT sample, qname, chrom, 'right' AS side, ref_end AS pos, right(seq,{_RC}) AS clip FROM {{v_alignments}} WHERE (flag & 2308) = 0 AND {_RC} >= {min_clip}
    UNION ALL SELECT sample, qname, chrom, 'left', ref_start, left(seq,{_LC}) FROM {{v_alignments}} WHERE (flag & 2308) = 0 AND {_LC} >= {min_clip}"""


fragment("o_clips", clips_sql(20))
fragment("o_anchors", """SELECT sample, chrom, side, list_reduce(list_sort(list(DISTINCT pos)), lambda a, x: CASE WHEN len(a) = 0 OR x - a[-1] > 50 THEN list_append(a, x) ELSE a END, []::BIGINT[]) AS anchors
    FROM {o_clips} GROUP BY 1,2,3""")
fragment("o_tagged", "SELECT c.*, list_max(list_filter(anchors, lambda a: a <= pos)) AS anchor FROM {o_clips} c JOIN {o_anchors} USING (sample, chrom, side)")
fragment("o_clusters", "SELECT sample, chrom, side, anchor, list_sort(list(pos))[count(*)//2 + 1] AS position, count(*) AS n_reads FROM {o_tagged} GROUP BY 1,2,3,4 HAVING count(*) >= 3")


def consensus_sql(rows, keys, share, total=2):
    """Independent vote: longest good prefix for right clips, N-padded from the end for left ones."""
    return f"""SELECT {keys}, CASE WHEN max(side) = 'right' THEN string_agg(CASE WHEN okrun THEN best ELSE '' END, '' ORDER BY off) ELSE trim(string_agg(CASE WHEN ok THEN best ELSE 'N' END, '' ORDER BY off DESC), 'N') END AS consensus FROM (
      SELECT *, bool_and(ok) OVER (PARTITION BY {keys} ORDER BY off) AS okrun FROM (
        SELECT {keys}, off, max(side) AS side, arg_max(base, n) AS best, sum(n) >= {total} AND max(n) / sum(n) >= {share} AS ok FROM (
          SELECT {keys}, side, off, upper(base) AS base, count(*) AS n FROM (
            SELECT r.*, CASE WHEN side='right' THEN i ELSE length(clip)-1-i END AS off, substr(clip, i+1, 1) AS base FROM ({rows}) r, unnest(range(length(clip))) u(i)) a GROUP BY ALL) b GROUP BY {keys}, off) c) d GROUP BY {keys}"""


fragment("o_consensus", "SELECT k.*, consensus FROM {o_clusters} k JOIN (" + consensus_sql(
    "SELECT * FROM {o_tagged} SEMI JOIN {o_clusters} USING (sample, chrom, side, anchor)", "sample, chrom, side, anchor", 0.51) + ") v USING (sample, chrom, side, anchor)")


def pairs_sql(clusters):
    return f"""SELECT sample, chrom, (p).r AS r_pos, (p).l AS l_pos FROM (SELECT sample, chrom, unnest(list_reduce(rs, lambda acc, x: CASE WHEN len(list_filter(ls, lambda l: abs(l - x) <= 50 AND NOT list_contains(list_transform(acc, lambda a: a.l), l))) > 0
      THEN list_append(acc, {{'r': x, 'l': list_sort(list_transform(list_filter(ls, lambda l: abs(l - x) <= 50 AND NOT list_contains(list_transform(acc, lambda a: a.l), l)), lambda l: {{'d': abs(l - x), 'l': l}}))[1].l}}) ELSE acc END, []::STRUCT(r BIGINT, l BIGINT)[])) AS p
      FROM (SELECT sample, chrom, list_sort(list(position) FILTER (side='right')) AS rs, coalesce(list_sort(list(position) FILTER (side='left')), []) AS ls FROM ({clusters}) c GROUP BY 1,2) g WHERE rs IS NOT NULL) h"""


fragment("o_pairs", pairs_sql("SELECT * FROM {o_clusters}"))
fragment("o_sites", """SELECT *, concat('insertion_', chrom, '_', base, CASE WHEN k > 1 THEN concat('_', k) ELSE '' END) AS site_id FROM (
    SELECT *, row_number() OVER (PARTITION BY sample, chrom, base ORDER BY has_r DESC, r_pos, l_pos) AS k FROM (
      SELECT sample, chrom, r_pos IS NOT NULL AS has_r, l_pos IS NOT NULL AS has_l, r_pos, l_pos, r_seed AS seed_5p, l_seed AS seed_3p, coalesce(r_n,0) AS reads_5p, coalesce(l_n,0) AS reads_3p,
        least(coalesce(r_pos,l_pos), coalesce(l_pos,r_pos)) AS base, CASE WHEN r_pos IS NOT NULL AND l_pos IS NOT NULL THEN greatest(r_pos,l_pos) END AS pos_3p FROM (
        SELECT p.sample, p.chrom, p.r_pos, p.l_pos, r.consensus AS r_seed, l.consensus AS l_seed, r.n_reads AS r_n, l.n_reads AS l_n FROM {o_pairs} p
          JOIN {o_consensus} r ON r.side='right' AND r.sample=p.sample AND r.chrom=p.chrom AND r.position=p.r_pos JOIN {o_consensus} l ON l.side='left' AND l.sample=p.sample AND l.chrom=p.chrom AND l.position=p.l_pos
          WHERE length(r.consensus) >= 20 AND length(l.consensus) >= 20
        UNION ALL SELECT sample, chrom, position, NULL, consensus, NULL, n_reads, NULL FROM {o_consensus} c WHERE side='right' AND n_reads >= 5 AND length(consensus) >= 20 AND NOT EXISTS (SELECT 1 FROM {o_pairs} p WHERE p.sample=c.sample AND p.chrom=c.chrom AND p.r_pos=c.position)
        UNION ALL SELECT sample, chrom, NULL, position, NULL, consensus, NULL, n_reads FROM {o_consensus} c WHERE side='left' AND n_reads >= 5 AND length(consensus) >= 20 AND NOT EXISTS (SELECT 1 FROM {o_pairs} p WHERE p.sample=c.sample AND p.chrom=c.chrom AND p.l_pos=c.position)) u) v) w""")


@query("ag1_soft_clips", "SELECT sample, qname, chrom, side, pos, clip FROM {o_clips}")
def ag1a(t):
    return st.soft_clips(t.v_alignments)


@query("ag1_softclip_clusters", "SELECT sample, chrom, side, anchor, position, n_reads FROM {o_clusters}")
def ag1(t):
    return st.softclip_clusters(st.soft_clips(t.v_alignments)).drop("positions")


@query("ag1_anchored_chain", """SELECT grp, anchor, count(*) AS n_pos, CAST(sum(n) AS BIGINT) AS n_reads FROM (SELECT grp, pos, n, list_max(list_filter(anchors, lambda a: a <= pos)) AS anchor FROM {v_positions} JOIN (
    SELECT grp, list_reduce(list_sort(list(pos)), lambda a, x: CASE WHEN len(a) = 0 OR x - a[-1] > 50 THEN list_append(a, x) ELSE a END, []::BIGINT[]) AS anchors FROM {v_positions} GROUP BY grp) f USING (grp)) g GROUP BY 1,2""")
def ag1c(t):
    tagged = core.anchored_clusters(t.v_positions, ["grp"], "pos", 50)
    return tagged.groupBy("grp", "anchor").agg(F.count(F.lit(1)).alias("n_pos"), F.sum("n").alias("n_reads"))


@query("ag1_upper_median", "SELECT grp, list_sort(list(pos))[count(*)//2+1] AS median, count(*) AS n FROM {v_positions} GROUP BY grp")
def ag1d(t):
    return core.upper_median(t.v_positions, ["grp"], "pos")


def _clusters(t):
    return st.find_clusters(t.v_alignments)


@query("ag7_consensus_right", "SELECT sample, chrom, position, n_reads, consensus FROM {o_consensus} WHERE side='right'")
def ag7(t):
    return _clusters(t).filter("side = 'right'").select("sample", "chrom", "position", "n_reads", "consensus")


@query("ag8_consensus_left", "SELECT sample, chrom, position, n_reads, consensus FROM {o_consensus} WHERE side='left'")
def ag8(t):
    return _clusters(t).filter("side = 'left'").select("sample", "chrom", "position", "n_reads", "consensus")


TAILS = "SELECT sample, chrom, ref_start AS start_key, seq AS tail FROM {v_alignments}"


@query("ag9_vote_extension", "SELECT sample, chrom, start_key, consensus AS extension FROM (" + consensus_sql(
    f"SELECT sample, chrom, start_key, 'right' AS side, tail AS clip FROM ({TAILS}) t", "sample, chrom, start_key", 0.6) + ") e")
def ag9(t):
    return st.vote_extension(lines(t, TAILS), ["sample", "chrom", "start_key"], "tail")


@query("rj10_pair_clusters", "SELECT sample, chrom, r_pos, l_pos FROM {o_pairs}")
def rj10(t):
    clips = checkpoint(st.soft_clips(t.v_alignments))
    return _pair_positions(st.softclip_clusters(clips).drop("positions"))


def _pair_positions(k):
    return st.pair_clusters(k).filter("r_pos IS NOT NULL AND l_pos IS NOT NULL").select("sample", "chrom", "r_pos", "l_pos")


CHAIN = "SELECT DISTINCT 's0' AS sample, concat('chr',CAST(grp AS STRING)) AS chrom, CASE WHEN pos % 3 = 0 THEN 'left' ELSE 'right' END AS side, pos AS anchor, pos AS position, 1 AS n_reads FROM {v_positions}"


@query("rj10_pair_chain", pairs_sql(CHAIN))
def rj10b(t):
    return _pair_positions(lines(t, CHAIN))


SITE_COLS = ["sample", "site_id", "chrom", "seed_5p", "seed_3p", "reads_5p", "reads_3p", "pos_5p", "pos_3p"]


@query("wn12_site_ids", "SELECT sample, site_id, chrom, seed_5p, seed_3p, reads_5p, reads_3p, base AS pos_5p, pos_3p FROM {o_sites}")
def wn12(t):
    return st.find_sites(t.v_alignments).select(*SITE_COLS)


@query("wn12_id_suffixes", f"""SELECT sample, chrom, "at", seed, concat('insertion_',chrom,'_',"at",CASE WHEN k>1 THEN concat('_',k) ELSE '' END) AS site_id FROM (SELECT *, row_number() OVER (PARTITION BY sample, chrom, "at" ORDER BY seed) AS k FROM (SELECT sample, chrom, pos // 900 AS "at", site_id AS seed FROM {{v_sites}}) c) d""")
def wn12b(t):
    rows = t.v_sites.select("sample", "chrom", F.floor(F.col("pos") / 900).alias("at"), F.col("site_id").alias("seed"))
    return st.site_ids(rows, "at", [F.col("seed")])


# clip queries of the sites: a third of the seeds map to the host, half have element hits
fragment("o_host_clips", "SELECT sample, concat(site_id,'_5p') AS qname FROM {o_sites} WHERE base % 11 = 0 UNION ALL SELECT sample, concat(site_id,'_3p') FROM {o_sites} WHERE base % 13 = 0")
fragment("o_element_clips", """SELECT sample, concat(site_id, CASE WHEN has_r AND has_l THEN '_5p' ELSE '_clip' END) AS qname FROM {o_sites} WHERE base % 2 = 0
    UNION ALL SELECT sample, concat(site_id,'_3p') FROM {o_sites} WHERE has_r AND has_l AND base % 5 = 0""")
fragment("o_valid", """SELECT * FROM (SELECT s.*, has_r AND has_l AS paired, CASE WHEN has_r AND has_l THEN concat(site_id,'_5p') IN (SELECT qname FROM {o_element_clips} e WHERE e.sample=s.sample) OR concat(site_id,'_3p') IN (SELECT qname FROM {o_element_clips} e WHERE e.sample=s.sample)
      ELSE concat(site_id,'_clip') IN (SELECT qname FROM {o_element_clips} e WHERE e.sample=s.sample) END AS has_element_hits,
      concat(site_id,'_5p') IN (SELECT qname FROM {o_host_clips} e WHERE e.sample=s.sample) OR concat(site_id,'_3p') IN (SELECT qname FROM {o_host_clips} e WHERE e.sample=s.sample) AS in_host FROM {o_sites} s) x
    WHERE CASE WHEN paired THEN NOT in_host AND left(seed_5p, least(20,length(seed_5p),length(seed_3p))) <> left(seed_3p, least(20,length(seed_5p),length(seed_3p))) ELSE has_element_hits END""")


def _clip_names(sites):
    pos = F.col("pos_5p")
    name = lambda e: F.concat("site_id", F.lit(e)).alias("qname")
    paired = F.col("has_r") & F.col("has_l")
    host = sites.filter(pos % 11 == 0).select("sample", name("_5p")).unionByName(sites.filter(pos % 13 == 0).select("sample", name("_3p")))
    first = F.concat("site_id", F.when(paired, "_5p").otherwise("_clip")).alias("qname")
    element = sites.filter(pos % 2 == 0).select("sample", first).unionByName(sites.filter(paired & (pos % 5 == 0)).select("sample", name("_3p")))
    return host, element


def _valid(t):
    sites = st.find_sites(t.v_alignments)
    return st.validate_sites(sites, *_clip_names(sites))


@query("dt4_validate_sites", "SELECT sample, site_id, CASE WHEN paired THEN 'high' ELSE 'medium' END AS confidence, has_element_hits FROM {o_valid}")
def dt4(t):
    return _valid(t).select("sample", "site_id", "confidence", "has_element_hits")


@query("wn4_rank_sites", """SELECT sample, site_id, row_number() OVER (PARTITION BY sample ORDER BY CASE WHEN has_element_hits THEN 0 ELSE 1 END, CASE WHEN paired THEN 0 ELSE 1 END, reads_5p + reads_3p DESC, site_id) AS site_rank FROM {o_valid}""")
def wn4(t):
    return st.rank_sites(_valid(t)).select("sample", "site_id", "site_rank")


MASKSITES = "SELECT sample, site_id, site_chr AS chrom, CASE WHEN insert_len % 5 = 0 THEN 0 ELSE site_pos END AS pos_5p, site_pos + 13 AS pos_3p FROM {v_inserts}"


@query("rj4_apply_mask", f"""SELECT s.sample, s.site_id, s.chrom, s.pos_5p, s.pos_3p, m.mask_element, CASE WHEN m.mask_element IS NOT NULL THEN 'FALSE_NEGATIVE_MASKED' END AS mask_tier FROM ({MASKSITES}) s LEFT JOIN (
    SELECT s.sample, s.site_id, arg_max(name, (start_pos, line_no)) AS mask_element FROM ({MASKSITES}) s JOIN {{v_mask}} b ON b.chrom = s.chrom AND start_pos <= CASE WHEN pos_5p = 0 THEN pos_3p ELSE pos_5p END AND CASE WHEN pos_5p = 0 THEN pos_3p ELSE pos_5p END < end_pos GROUP BY 1,2) m USING (sample, site_id)""")
def rj4(t):
    return st.apply_mask(lines(t, MASKSITES), t.v_mask)


_TIER = "CASE WHEN sseqid LIKE '%|src=univec' THEN 1 ELSE 2 END"
fragment("o_best", f"SELECT sample, qseqid, split_part(sseqid,'|src=',1) AS element, pident, length, CASE WHEN contains(sseqid,'|src=') THEN split_part(sseqid,'|src=',2) ELSE 'element_db' END AS source, bitscore FROM {{v_hits}} WHERE pident >= 80 AND length >= 20 QUALIFY row_number() OVER (PARTITION BY sample, qseqid ORDER BY {_TIER} DESC, bitscore DESC, db_idx, line_no, sseqid) = 1")


def _hits(t):
    return t.v_hits.withColumn("line_no", F.struct("line_no", "sseqid"))


@query("wn1_best_hit", "SELECT sample, qseqid, element, source, bitscore FROM {o_best}")
def wn1(t):
    return st.best_hit(_hits(t)).select("sample", "qseqid", "element", "source", "bitscore")


COV = "SELECT header AS qseqid, pident, qcov, line_no FROM (SELECT concat('el',CAST(l_partkey AS STRING)) AS header, CAST(60 + l_suppkey % 41 AS DOUBLE) AS pident, CAST(l_orderkey % 60 AS DOUBLE) * (l_partkey % 7) / 6 AS qcov, l_orderkey*100000 + l_linenumber*10000 + l_suppkey AS line_no FROM {lineitem}) h"


@query("rj20_host_endogenous", f"SELECT qseqid, arg_max(CASE WHEN pident >= 90 AND qcov >= 50 THEN 'T1' ELSE 'T2' END, line_no) AS label FROM ({COV}) c WHERE (pident >= 90 AND qcov >= 50) OR (pident >= 75 AND qcov >= 30) GROUP BY 1")
def rj20(t):
    return st.host_endogenous(lines(t, COV))


@query("rj20_clean_catalogue", f"SELECT concat('el',p_partkey) AS qseqid, p_name FROM {{part}} WHERE concat('el',p_partkey) NOT IN (SELECT qseqid FROM ({COV}) c WHERE (pident >= 90 AND qcov >= 50) OR (pident >= 75 AND qcov >= 30))")
def rj20b(t):
    elements = t.part.select(F.concat(F.lit("el"), "p_partkey").alias("qseqid"), "p_name")
    return st.drop_endogenous(elements, st.host_endogenous(lines(t, COV)))


CLIPHOST = "SELECT sample, qseqid, pident, length FROM {v_hits} WHERE db_idx = 1"
fragment("o_clean_best", f"SELECT * FROM {{o_best}} b WHERE NOT EXISTS (SELECT 1 FROM ({CLIPHOST}) h WHERE h.sample=b.sample AND h.qseqid=b.qseqid AND h.pident >= 95 AND h.length >= 30)")


@query("rj21_drop_host_clips", "SELECT sample, qseqid, element, source FROM {o_clean_best}")
def rj21(t):
    return st.drop_host_clips(st.best_hit(_hits(t)), lines(t, CLIPHOST)).select("sample", "qseqid", "element", "source")


TIERSITES = """SELECT sample, concat('s', CAST(n AS STRING)) AS site_id, concat('chr', CAST(n % 5 + 1 AS STRING)) AS chrom, n*37 AS pos_5p, n*37+9 AS pos_3p, repeat('A', CAST(20 + n % 9 AS INT)) AS seed_5p, CASE WHEN n % 4 = 0 THEN NULL ELSE repeat('C', CAST(20 + n % 7 AS INT)) END AS seed_3p,
    CASE WHEN n % 10 = 0 THEN 'mask1' END AS mask_element, CASE WHEN n % 10 = 0 THEN 'FALSE_NEGATIVE_MASKED' END AS mask_tier FROM (SELECT DISTINCT sample, l_orderkey % 2000 AS n FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN 's1' ELSE 's0' END AS sample FROM {lineitem}) l) d"""


def _end(e):
    m = "mask_tier IS NOT NULL"
    return f"""CASE WHEN {m} THEN mask_element ELSE coalesce(h{e}.element,'') END AS hit_{e}, CASE WHEN {m} THEN 0.0::DOUBLE ELSE coalesce(h{e}.pident,0.0) END AS hit_{e}_identity,
    CASE WHEN {m} THEN 0 ELSE coalesce(h{e}.length,0) END AS hit_{e}_aln_len, CASE WHEN {m} THEN mask_tier ELSE coalesce(h{e}.source,'') END AS hit_{e}_source"""


fragment("o_tiers", f"""SELECT s.sample, s.site_id, chrom, pos_5p + CASE WHEN pos_5p = 0 THEN 9 ELSE 0 END AS pos, CAST(coalesce(length(seed_5p),0) AS INTEGER) AS clip_5p_len, CAST(coalesce(length(seed_3p),0) AS INTEGER) AS clip_3p_len, {_end('5p')}, {_end('3p')}, mask_tier, mask_element,
    mask_tier IS NULL AND (coalesce(h5p.source,'') IN ('element_db','payload','sample_contig') OR coalesce(h3p.source,'') IN ('element_db','payload','sample_contig')) AS transgene_positive
    FROM ({TIERSITES}) s LEFT JOIN {{o_best}} h5p ON h5p.sample=s.sample AND h5p.qseqid = concat(s.site_id,'_5p') LEFT JOIN {{o_best}} h3p ON h3p.sample=s.sample AND h3p.qseqid = concat(s.site_id,'_3p')""")


def tiers(t):
    return st.site_tiers(lines(t, TIERSITES), st.best_hit(_hits(t)))


@query("dt5_site_tiers", "SELECT * FROM {o_tiers}")
def dt5(t):
    return tiers(t)


@query("io13_tier_rows", "SELECT sample, site_id, chrom, pos, CASE WHEN transgene_positive THEN 'True' ELSE 'False' END AS transgene_positive, clip_5p_len, clip_3p_len, hit_5p, hit_5p_identity, hit_5p_aln_len, hit_5p_source, hit_3p, hit_3p_identity, hit_3p_aln_len, hit_3p_source FROM {o_tiers}")
def io13(t):
    from sitewright.sources import tier_rows
    return tier_rows(tiers(t))


SEEDSITES = "SELECT sample, site_id, chrom, 0 AS pos_idx, pos FROM {v_sites} UNION ALL SELECT sample, site_id, chrom, 1 AS pos_idx, pos + 3 AS pos FROM {v_sites}"
fragment("o_clips15", clips_sql(15))
fragment("o_near", f"SELECT c.sample, s.site_id, c.side, s.pos_idx, c.clip FROM {{o_clips15}} c JOIN ({SEEDSITES}) s ON c.sample=s.sample AND c.chrom=s.chrom AND abs(c.pos - s.pos) <= 10")


@query("ag40_seeds_at", """SELECT sample, site_id, side, arg_max(consensus, (length(consensus), -pos_idx)) AS seed, arg_max(n, pos_idx) AS n_reads FROM (SELECT * FROM (
    """ + consensus_sql("SELECT * FROM {o_near}", "sample, site_id, side, pos_idx", 0.51).replace("max(side)", "any_value(side)") + """) v JOIN (SELECT sample, site_id, side, pos_idx, count(*) AS n FROM {o_near} GROUP BY ALL) k USING (sample, site_id, side, pos_idx) WHERE n >= 2 AND length(consensus) >= 15) z GROUP BY 1,2,3""")
def ag40(t):
    return st.seeds_at(t.v_alignments, lines(t, SEEDSITES))


# flagship: alignments -> clips -> clusters -> sites -> mask -> hits of whole seeds in the catalogue without host sequence -> host re-check -> tier
FLAG_MASK = "SELECT chrom, start_pos, start_pos + 40 AS end_pos, name, line_no FROM {v_mask}"
fragment("o_flag_sites", f"""SELECT s.*, m.mask_element FROM {{o_sites}} s LEFT JOIN (SELECT s.sample, s.site_id, arg_max(name, (start_pos, line_no)) AS mask_element FROM {{o_sites}} s JOIN ({FLAG_MASK}) b ON b.chrom=s.chrom AND start_pos <= base AND base < end_pos GROUP BY 1,2) m USING (sample, site_id)""")
# every locus gives its element and a stretch of the host, which must not pass for one
FLAG_CATALOGUE = "SELECT concat('E', CAST(loc AS STRING), '|src=element_db') AS sseqid, elem AS seq FROM {v_loci} UNION ALL SELECT concat('H', CAST(loc AS STRING), '|src=element_db') AS sseqid, substr(host, 31, 64) AS seq FROM {v_loci}"
FLAG_HOST = "SELECT concat(chrom, ':', CAST(start_pos AS STRING)) AS sseqid, seq FROM {v_ref}"
fragment("o_flag_catalogue", FLAG_CATALOGUE)
fragment("o_flag_seeds", "SELECT sample, concat(site_id, '_5p') AS qseqid, seed_5p AS seq FROM {o_flag_sites} WHERE seed_5p IS NOT NULL UNION ALL SELECT sample, concat(site_id, '_3p'), seed_3p FROM {o_flag_sites} WHERE seed_3p IS NOT NULL")
fragment("o_flag_foreign", "SELECT c.* FROM {o_flag_catalogue} c WHERE sseqid NOT IN (SELECT h.qseqid FROM ("
         + hits_sql("SELECT '' AS sample, sseqid AS qseqid, seq FROM {o_flag_catalogue}", FLAG_HOST)
         + ") h JOIN {o_flag_catalogue} e ON e.sseqid = h.qseqid WHERE (pident >= 90 AND h.length * 100.0 / length(e.seq) >= 50) OR (pident >= 75 AND h.length * 100.0 / length(e.seq) >= 30))")
fragment("o_flag_best", "SELECT sample, qseqid, replace(sseqid, '|src=element_db', '') AS element FROM (" + hits_sql("SELECT * FROM {o_flag_seeds}", "SELECT * FROM {o_flag_foreign}")
         + ") h WHERE hit_rank = 1 AND (sample, qseqid) NOT IN (SELECT (sample, qseqid) FROM (" + hits_sql("SELECT * FROM {o_flag_seeds}", FLAG_HOST) + ") c WHERE pident >= 95 AND length >= 30)")


@query("flagship_insertion_sites", """SELECT s.sample, site_id, chrom, base AS pos, CAST(coalesce(length(seed_5p),0) AS INTEGER) AS clip_5p_len, CAST(coalesce(length(seed_3p),0) AS INTEGER) AS clip_3p_len, reads_5p + reads_3p AS n_reads, mask_element,
    CASE WHEN mask_element IS NOT NULL THEN mask_element ELSE coalesce(e5.element,'') END AS hit_5p, CASE WHEN mask_element IS NOT NULL THEN mask_element ELSE coalesce(e3.element,'') END AS hit_3p,
    mask_element IS NULL AND (e5.element IS NOT NULL OR e3.element IS NOT NULL) AS transgene_positive
    FROM {o_flag_sites} s LEFT JOIN {o_flag_best} e5 ON e5.sample = s.sample AND e5.qseqid = concat(site_id, '_5p') LEFT JOIN {o_flag_best} e3 ON e3.sample = s.sample AND e3.qseqid = concat(site_id, '_3p')""")
def flagship(t):
    sites = checkpoint(st.apply_mask(st.find_sites(t.v_alignments), lines(t, FLAG_MASK)))
    end = lambda e: sites.filter(f"seed_{e} IS NOT NULL").select("sample", F.concat("site_id", F.lit(f"_{e}")).alias("qseqid"), F.col(f"seed_{e}").alias("seq"))
    seeds, host = end("5p").unionByName(end("3p")), lines(t, FLAG_HOST)
    catalogue = lines(t, FLAG_CATALOGUE).withColumnRenamed("sseqid", "qseqid")
    own = kmer_hits(catalogue.withColumn("sample", F.lit("")), host).join(catalogue.select("qseqid", F.length("seq").alias("_n")), "qseqid")
    own = own.select("qseqid", "pident", (F.col("length") * 100.0 / F.col("_n")).alias("qcov"), F.col("hit_rank").alias("line_no"))
    foreign = st.drop_endogenous(catalogue, st.host_endogenous(own)).withColumnRenamed("qseqid", "sseqid")
    hits = kmer_hits(seeds, foreign).select("sample", "qseqid", "sseqid", "pident", "length", F.col("score").alias("bitscore"), F.lit(0).alias("db_idx"), F.col("hit_rank").alias("line_no"))
    best = st.drop_host_clips(st.best_hit(hits), kmer_hits(seeds, host).select("sample", "qseqid", "pident", "length"))
    reads = sites.select("sample", "site_id", (F.col("reads_5p") + F.col("reads_3p")).alias("n_reads"))
    return st.site_tiers(sites, best).join(reads, ["sample", "site_id"]).select(
        "sample", "site_id", "chrom", "pos", "clip_5p_len", "clip_3p_len", "n_reads", "mask_element", "hit_5p", "hit_3p", "transgene_positive")

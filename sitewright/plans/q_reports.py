"""Report tables: AG24, AG26-28, AG30-35, AG39, RJ17."""
from __future__ import annotations

from pyspark.sql import functions as F

from sitewright.operators import reports as rp
from sitewright.plans.q_annotations import ELEMENTS  # noqa: F401  (same hit columns)
from sitewright.plans.q_depth import HOSTDEPTH, STATS
from sitewright.plans.q_edits import calls
from sitewright.plans.q_evidence import verdicts
from sitewright.plans.q_junctions import junction_verdicts
from sitewright.plans.q_reads import lines
from sitewright.plans.q_sites import tiers
from sitewright.plans.registry import fragment, query

CONTIGS = "SELECT sample, CAST(insert_len AS BIGINT) AS length FROM {v_inserts}"


@query("ag24_contig_stats", f"""SELECT sample, num_contigs, total_bases, n50 FROM (SELECT sample, count(*) AS num_contigs, CAST(sum(length) AS BIGINT) AS total_bases FROM ({CONTIGS}) c GROUP BY 1) t JOIN (SELECT sample, max(length) AS n50 FROM (
    SELECT sample, length, sum(length) OVER (PARTITION BY sample ORDER BY length DESC ROWS UNBOUNDED PRECEDING) AS cum, sum(length) OVER (PARTITION BY sample) AS total FROM ({CONTIGS}) c) x WHERE cum >= total/2 GROUP BY 1) n USING (sample)""")
def ag24(t):
    return rp.contig_stats(lines(t, CONTIGS), tile=64)


_LC = r"coalesce(TRY_CAST(regexp_extract(cigar,'^(\d+)S',1) AS INTEGER),0)"
_RC = r"coalesce(TRY_CAST(regexp_extract(cigar,'(\d+)S$',1) AS INTEGER),0)"
TRUTH = "SELECT sample, chrom, pos + 3 AS position, site_id AS description FROM {v_sites}"


def _side(n, text, name):
    return f"""count({n}) AS {name}_clip_count, coalesce(max({n}),0) AS {name}_clip_max_len, coalesce(list_sort(list({n}) FILTER ({n} IS NOT NULL))[count({n})//2+1],0) AS {name}_clip_median_len, coalesce(max({{'l': {n}, 't': {text}}}) FILTER ({n} IS NOT NULL), {{'l': 0, 't': ''}}).t AS {name}_consensus"""


fragment("o_truth_base", f"""SELECT t.sample, t.chrom, t.position, t.description, count(x.qname) AS total_reads, {_side('rl', 'rs', 'right')}, {_side('ll', 'ls', 'left')}, count(rl) + count(ll) > 0 AS found FROM ({TRUTH}) t LEFT JOIN (
    SELECT a.sample, a.chrom, t.position, qname, CASE WHEN rc >= 10 AND abs(ref_end - t.position) <= 100 THEN rc END AS rl, CASE WHEN lc >= 10 AND ref_start > 0 AND abs(ref_start - t.position) <= 100 THEN lc END AS ll, right(seq, rc) AS rs, left(seq, lc) AS ls
    FROM (SELECT *, {_LC} AS lc, {_RC} AS rc FROM {{v_alignments}} WHERE (flag & 2308) = 0) a JOIN (SELECT DISTINCT sample, chrom, position FROM ({TRUTH}) t) t ON a.sample=t.sample AND a.chrom=t.chrom AND ref_start < t.position + 100 AND ref_end > greatest(0, t.position - 100)) x ON x.sample=t.sample AND x.chrom=t.chrom AND x.position=t.position GROUP BY 1,2,3,4""")


@query("ag26_truth_baseline", "SELECT * FROM {o_truth_base}")
def ag26(t):
    return rp.truth_baseline(t.v_alignments, lines(t, TRUTH))


KEYED = "SELECT sample, chrom, pos + 3 AS position, CASE WHEN pos % 2 = 0 THEN '5p' ELSE '3p' END AS end_tag, site_id AS element, CAST(90 + pos % 10 AS DOUBLE) AS identity, pos % 60 AS aln_len FROM {v_sites}"


@query("ag26_baseline_flags", f"""SELECT b.sample, b.chrom, b.position, e5.element IS NOT NULL AS element_hit_5p, coalesce(e5.element,'-') AS element_id_5p, coalesce(e5.identity,0) AS element_identity_5p, coalesce(e5.aln_len,0) AS element_aln_len_5p, e3.element IS NOT NULL AS element_hit_3p, coalesce(e3.element,'-') AS element_id_3p,
    coalesce(e3.identity,0) AS element_identity_3p, coalesce(e3.aln_len,0) AS element_aln_len_3p, e5.element IS NOT NULL AS maps_to_host_5p, e3.element IS NOT NULL AS maps_to_host_3p FROM ({TRUTH}) b LEFT JOIN ({KEYED}) e5 ON e5.sample=b.sample AND e5.chrom=b.chrom AND e5.position=b.position AND e5.end_tag='5p' LEFT JOIN ({KEYED}) e3 ON e3.sample=b.sample AND e3.chrom=b.chrom AND e3.position=b.position AND e3.end_tag='3p'""")
def ag26b(t):
    hits = lines(t, KEYED).withColumnRenamed("end_tag", "end")
    return rp.baseline_flags(lines(t, TRUTH).drop("description"), hits, hits.select("sample", "chrom", "position", "end"))


SITES = "SELECT sample, concat(CAST(5 * (1 + n_borders % 3) AS STRING),'x') AS coverage_tag, concat(site_chr,'.1') AS chrom, site_pos AS pos, CASE n_elements WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'CANDIDATE' WHEN 2 THEN 'TRUE_INSERTION' ELSE 'FALSE_POSITIVE' END AS verdict, site_id AS report_idx FROM {v_evidence}"
ANCHORS = "SELECT CASE WHEN s_suppkey % 2 = 0 THEN 's0' ELSE 's1' END AS sample, concat('chr',CAST(s_suppkey % 5 + 1 AS STRING)) AS chrom, s_suppkey*7*13 % 100000 AS position, s_suppkey*37 % 1009 AS truth_idx FROM {supplier}"
RUNS = "SELECT DISTINCT sample, concat(CAST(5 * (1 + n_borders % 3) AS STRING),'x') AS coverage_tag, true AS has_output FROM {v_evidence} UNION ALL SELECT DISTINCT CASE WHEN s_suppkey % 2 = 0 THEN 's0' ELSE 's9' END AS sample, '20x' AS coverage_tag, s_suppkey % 2 = 0 AS has_output FROM {supplier}"
fragment("o_truth_match", f"""SELECT r.sample, r.coverage_tag, CASE WHEN r.sample NOT IN (SELECT sample FROM ({ANCHORS}) a) THEN 'no_gt' WHEN v IS NULL THEN 'MISS' ELSE concat('HIT:',v) END AS gt_anchor_hit FROM ({RUNS}) r LEFT JOIN (SELECT s.sample, s.coverage_tag, arg_min(s.verdict, (truth_idx, report_idx)) AS v FROM ({SITES}) s JOIN ({ANCHORS}) a ON a.sample=s.sample AND a.chrom = regexp_replace(s.chrom,'\\.\\d+$','') AND abs(a.position - s.pos) <= 5 GROUP BY 1,2) m USING (sample, coverage_tag)""")


@query("rj17_match_truth", "SELECT * FROM {o_truth_match}")
def rj17(t):
    return rp.match_truth(lines(t, SITES), lines(t, ANCHORS), lines(t, RUNS), tol=5)


@query("ag27_verdict_matrix", f"""SELECT r.sample, r.coverage_tag, coalesce(n,0) AS n_sites_total, coalesce(c,0) AS n_candidate, coalesce(ti,0) AS n_true, coalesce(u,0) AS n_unknown, gt_anchor_hit, CASE WHEN coalesce(n,0) > 0 THEN '' WHEN has_output THEN 'pipeline complete, 0 insertion reports' ELSE 'no s05 output (pipeline incomplete?)' END AS notes
    FROM ({RUNS}) r JOIN {{o_truth_match}} USING (sample, coverage_tag) LEFT JOIN (SELECT sample, coverage_tag, count(*) AS n, count(*) FILTER (verdict='CANDIDATE') AS c, count(*) FILTER (verdict='TRUE_INSERTION') AS ti, count(*) FILTER (verdict='UNKNOWN') AS u FROM ({SITES}) s GROUP BY 1,2) k USING (sample, coverage_tag)""")
def ag27(t):
    return rp.verdict_matrix(lines(t, SITES), lines(t, ANCHORS), lines(t, RUNS), tol=5)


@query("ag28_summarize_verdicts", "SELECT verdict, count(*) AS n_sites FROM {o_verdicts} GROUP BY 1")
def ag28(t):
    return rp.summarize_verdicts(verdicts(t))


@query("ag28_junction_verdicts", "SELECT verdict, count(*) AS n_sites FROM {o_jv} GROUP BY 1")
def ag28b(t):
    return rp.summarize_verdicts(junction_verdicts(t))


ROLL = STATS + " UNION ALL SELECT DISTINCT sample, 'insertion_sites' AS key, '37' AS value FROM {v_evidence}"


@query("ag30_rollup_sites", f"SELECT sample, CAST(max(CASE WHEN key='insertion_sites' THEN value END) AS BIGINT) AS sites, count(*) FILTER (suffix(key,'_verdict') AND value='CANDIDATE') AS candidates, count(*) FILTER (suffix(key,'_verdict') AND value='FALSE_POSITIVE') AS false_positives FROM ({ROLL}) s GROUP BY 1")
def ag30(t):
    return rp.rollup_sites(lines(t, ROLL))


@query("ag30_rollup_edits", "SELECT grp AS sample, chrom, pos AS position, indel_type AS type, CAST(size AS INTEGER) AS size, indel_seq, concat(printf('%.1f', round(freq*100,1)),'%') AS frequency, dp AS depth, cnt AS count, zygosity, CAST(pos % 5 AS BIGINT) AS grna, 'on-target' AS site_type FROM {o_calls}")
def ag30b(t):
    return rp.rollup_edits(calls(t).withColumns({"sample": F.col("grp"), "grna_idx": F.col("pos") % 5, "site_type": F.lit("on-target")}))


@query("ag30_rollup_copies", "SELECT sample, construct_median * 2 AS copy_number, construct_median AS construct_depth, host_median AS host_depth, marker, 'High' AS confidence FROM {o_construct} JOIN {o_host} USING (sample)")
def ag30c(t):
    from sitewright.operators import depth as dp
    rows = dp.construct_median(t.v_depth).join(dp.host_median(lines(t, HOSTDEPTH)).drop("n"), "sample")
    return rp.rollup_copies(rows.withColumns({"estimated_copies": F.col("construct_median") * 2, "confidence": F.lit("High")}))


@query("ag30_rollup_effects", "SELECT 's0' AS sample, concat(chrom,':',pos) AS position, concat(indel_type,' ',size,'bp') AS variant, coalesce(loc,'intergenic') AS effect, CASE WHEN loc IS NULL THEN '' ELSE concat('gene',p) END AS gene, '' AS aa_change FROM {o_vgene}")
def ag30d(t):
    from sitewright.operators import edits as ed
    rows = ed.cds_context(t.v_variants, t.v_features)
    return rp.rollup_effects(rows.select(F.lit("s0").alias("sample"), "chrom", "pos", "indel_type", "size", F.coalesce("location", F.lit("intergenic")).alias("effect"),
                                         F.coalesce("gene_id", F.lit("")).alias("gene_id"), F.lit("").alias("aa_change")))


LOG = """SELECT concat('f',CAST(log_id % 20 AS STRING),'.err') AS file, line_no, CASE event WHEN 'start' THEN concat('[x] === Processing insertion_',CAST(line_no AS STRING),': go') WHEN 'error' THEN 'noise' ELSE concat('[x]  Round ',CAST(line_no % 8 + 1 AS STRING),' growth: kmer=',CAST(line_no % 300 AS STRING),', mm2=',CAST(line_no % 7 AS STRING),', pilon=0, ssake=',CAST(line_no % 3 AS STRING)) END AS value FROM {v_custody}"""
fragment("o_growth", """SELECT file, coalesce(site,'unknown') AS site_id, CAST(r AS INTEGER) AS round, g AS growth FROM (SELECT *, last_value(s IGNORE NULLS) OVER (PARTITION BY file ORDER BY line_no ROWS UNBOUNDED PRECEDING) AS site FROM (SELECT concat('f',log_id % 20,'.err') AS file, line_no, CASE WHEN event='start' THEN concat('insertion_',line_no) END AS s, CASE WHEN event NOT IN ('start','error') THEN line_no % 8 + 1 END AS r, line_no % 300 + line_no % 7 + line_no % 3 AS g FROM {v_custody}) a) b WHERE r IS NOT NULL""")


@query("ag31_growth_rows", "SELECT * FROM {o_growth}")
def ag31(t):
    return rp.growth_rows(lines(t, LOG), tile=256)


@query("ag31_round_growth", "SELECT round, n AS n_site_rounds, g AS growth_bp, g/sum(g) OVER () AS fraction, sum(g) OVER (ORDER BY round)/sum(g) OVER () AS cumulative_fraction FROM (SELECT round, count(*) AS n, CAST(sum(growth) AS BIGINT) AS g FROM {o_growth} GROUP BY 1) x")
def ag31b(t):
    return rp.round_growth(rp.growth_rows(lines(t, LOG)))


FINALS = "SELECT sample, CASE WHEN n_elements = 3 THEN concat('insertion_',site_id,'_status',chr(9),'ok') ELSE concat('insertion_',site_id,'_assembly_rounds',chr(9),CAST(n_borders + 1 AS STRING)) END AS value FROM {v_evidence}"
fragment("o_finals", "SELECT sample, CAST(n_borders + 1 AS INTEGER) AS final_round FROM {v_evidence} WHERE n_elements <> 3")


@query("ag31_final_rounds", "SELECT final_round, n AS n_sites, n/sum(n) OVER () AS fraction, sum(n) OVER (ORDER BY final_round)/sum(n) OVER () AS cumulative_fraction FROM (SELECT final_round, count(*) AS n FROM {o_finals} GROUP BY 1) x")
def ag31c(t):
    return rp.final_round_histogram(rp.final_rounds(lines(t, FINALS)))


@query("ag31_final_round_samples", "SELECT sample, count(*) AS n_sites, max(final_round) AS max_final_round FROM {o_finals} GROUP BY 1")
def ag31d(t):
    return rp.final_round_samples(rp.final_rounds(lines(t, FINALS)))


CHITS = "SELECT sample, split_part(qseqid,'_',1) AS site_id, CASE db_idx WHEN 0 THEN 'promoter' WHEN 1 THEN 'cds' ELSE 'marker' END AS category, length, qstart AS q_start, qend AS q_end, line_no FROM {v_hits}"
CSITES = "SELECT DISTINCT sample, concat('s',CAST(l_orderkey % 2000 AS STRING)) AS site_id, CASE WHEN l_orderkey % 2000 % 3 = 0 THEN 'CANDIDATE' ELSE 'UNKNOWN' END AS verdict, 900 + l_orderkey % 2000 % 700 AS insert_len FROM (SELECT l_orderkey, CASE WHEN l_orderkey % 3 = 0 THEN 's1' ELSE 's0' END AS sample FROM {lineitem}) l"
CSITES_BIG = CSITES.replace("900 + l_orderkey", "9000 + l_orderkey")


@query("ag32_composition", f"""SELECT sample, category, CAST(sum(length) AS BIGINT) AS bp FROM ({CHITS}) h SEMI JOIN (SELECT * FROM ({CSITES_BIG}) s WHERE verdict='CANDIDATE') c USING (sample, site_id) GROUP BY 1,2
    UNION ALL SELECT sample, 'unannotated', CAST(t - a AS BIGINT) FROM (SELECT sample, sum(insert_len) AS t FROM ({CSITES_BIG}) s WHERE verdict='CANDIDATE' GROUP BY 1) x JOIN (SELECT sample, sum(length) AS a FROM ({CHITS}) h SEMI JOIN (SELECT * FROM ({CSITES_BIG}) s WHERE verdict='CANDIDATE') c USING (sample, site_id) GROUP BY 1) y USING (sample) WHERE t > a""")
def ag32(t):
    return rp.composition(lines(t, CHITS), lines(t, CSITES_BIG))


@query("ag33_site_composition", f"""SELECT sample, site_id, category, CAST(sum(hi-lo) AS BIGINT) AS bp FROM (SELECT sample, site_id, (k).c AS category, (k).lo AS lo, (k).hi AS hi FROM (SELECT sample, site_id, unnest(list_reduce(list({{'lo': q_start, 'hi': q_end, 'c': category}} ORDER BY q_end - q_start DESC, line_no), lambda acc, x: CASE WHEN len(list_filter(acc, lambda c: least(x.hi,c.hi) > greatest(x.lo,c.lo) AND least(x.hi,c.hi)-greatest(x.lo,c.lo) > 0.5*(x.hi-x.lo))) > 0 THEN acc ELSE list_append(acc, x) END, []::STRUCT(lo BIGINT, hi BIGINT, c VARCHAR)[])) AS k FROM {{o_cand_hits}} GROUP BY 1,2) f) g GROUP BY 1,2,3
    UNION ALL SELECT s.sample, s.site_id, 'unannotated', CAST(greatest(0, insert_len - coalesce(a,0)) AS BIGINT) FROM ({CSITES}) s LEFT JOIN (SELECT sample, site_id, sum(hi-lo) AS a FROM (SELECT sample, site_id, (k).lo AS lo, (k).hi AS hi FROM (SELECT sample, site_id, unnest(list_reduce(list({{'lo': q_start, 'hi': q_end}} ORDER BY q_end - q_start DESC, line_no), lambda acc, x: CASE WHEN len(list_filter(acc, lambda c: least(x.hi,c.hi) > greatest(x.lo,c.lo) AND least(x.hi,c.hi)-greatest(x.lo,c.lo) > 0.5*(x.hi-x.lo))) > 0 THEN acc ELSE list_append(acc, x) END, []::STRUCT(lo BIGINT, hi BIGINT)[])) AS k FROM {{o_cand_hits}} GROUP BY 1,2) f) g GROUP BY 1,2) z USING (sample, site_id) WHERE verdict='CANDIDATE'""")
def ag33(t):
    return rp.site_composition(lines(t, CHITS), lines(t, CSITES))


fragment("o_cand_hits", f"SELECT * FROM ({CHITS}) h SEMI JOIN (SELECT * FROM ({CSITES}) s WHERE verdict='CANDIDATE') c USING (sample, site_id)")


@query("ag34_clip_mapq_ratio", "SELECT sample, count(*) FILTER (mapq < 20) AS low, count(*) FILTER (mapq >= 20) AS high, count(*) FILTER (mapq < 20)/count(*) AS ratio FROM {v_alignments} WHERE (flag & 256) = 0 AND (flag & 2) <> 0 AND contains(cigar,'S') GROUP BY 1")
def ag34(t):
    return rp.clip_mapq_ratio(t.v_alignments)


@query("ag34_compare_runs", "SELECT sample, n_new, n_old, n_new/n_old AS ratio, n_old > 0 AND n_new/n_old BETWEEN 0.80 AND 1.20 AS pass FROM (SELECT sample, count(*) FILTER (transgene_positive AND pos % 8 <> 0) AS n_new, count(*) FILTER (transgene_positive) AS n_old FROM {o_tiers} GROUP BY 1) x")
def ag34b(t):
    old = tiers(t)
    return rp.compare_runs(old.filter("pos % 8 <> 0"), old)


RSITES = "SELECT sample, concat('insertion_',site_chr,'_',CAST(site_pos AS STRING)) AS site_id, CASE n_elements WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'CANDIDATE' WHEN 2 THEN 'CANDIDATE_LOW_CONF' ELSE 'FALSE_POSITIVE' END AS verdict FROM {v_evidence}"
RTRUTH = "SELECT CASE WHEN s_suppkey % 2 = 0 THEN 's0' ELSE 's1' END AS sample, concat('chr',CAST(s_suppkey % 5 + 1 AS STRING),'_',CAST(s_suppkey*7 AS STRING)) AS anchor FROM {supplier}"
fragment("o_recall", f"SELECT t.sample, t.anchor, min(site_id) AS site_id, coalesce(contains(arg_min(verdict, (site_id, verdict)),'CANDIDATE'), false) AS pass FROM ({RTRUTH}) t LEFT JOIN ({RSITES}) s ON s.sample = t.sample AND starts_with(s.site_id, concat('insertion_', t.anchor)) GROUP BY 1,2")


@query("ag35_anchor_recall", "SELECT * FROM {o_recall}")
def ag35(t):
    return rp.anchor_recall(lines(t, RSITES), lines(t, RTRUTH))


@query("ag35_recall_total", "SELECT count(*) FILTER (pass) AS passed, count(*) AS total FROM {o_recall}")
def ag35b(t):
    return rp.recall_total(rp.anchor_recall(lines(t, RSITES), lines(t, RTRUTH)))


@query("ag35_candidate_budget", f"SELECT sample, count(*) FILTER (starts_with(verdict,'CANDIDATE')) AS candidates, count(*) FILTER (starts_with(verdict,'CANDIDATE')) <= 5 AS within_budget FROM ({RSITES}) s GROUP BY 1")
def ag35c(t):
    return rp.candidate_budget(lines(t, RSITES))


@query("ag39_tier_counts", "SELECT sample, count(*) FILTER (transgene_positive) AS positive, count(*) FILTER (NOT transgene_positive) AS negative FROM {o_tiers} GROUP BY 1")
def ag39(t):
    return rp.tier_counts(tiers(t))


@query("ag39_tier_counts_by_chrom", "SELECT sample, chrom, count(*) FILTER (transgene_positive) AS positive, count(*) FILTER (NOT transgene_positive) AS negative FROM {o_tiers} GROUP BY 1,2")
def ag39b(t):
    return rp.tier_counts(tiers(t), ("sample", "chrom"))

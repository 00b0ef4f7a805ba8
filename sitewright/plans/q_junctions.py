"""Junctions: RJ12, RJ13, WN10, WN11, WN14, AG18, AG19, AG25, DT7-9."""
from __future__ import annotations

from pyspark.sql import functions as F

from sitewright.operators import junctions as jn
from sitewright.plans.q_evidence import union_sql
from sitewright.plans.q_reads import lines
from sitewright.plans.registry import fragment, query
from sitewright.sources.readers import paf_ratios


def _paf(t, kind):
    return paf_ratios(t.v_paf.filter(F.col("kind") == kind))


_OK = "matches/block_len >= 0.9 AND qend-qstart >= 50 AND (qend-qstart)/qlen >= 0.05"
fragment("o_h", f"SELECT * FROM {{v_paf}} WHERE kind='h' AND mapq >= 10 AND {_OK}")
fragment("o_c", f"SELECT * FROM {{v_paf}} WHERE kind='c' AND {_OK}")
fragment("o_cu", union_sql("SELECT sample, qname, qstart AS lo, qend AS hi FROM {o_c}", "sample, qname"))
fragment("o_junctions", """SELECT h.sample, h.qname AS contig, h.qlen AS contig_len, h.tname AS host_chr, h.tstart AS host_start, h.tend AS host_end, h.strand AS host_strand, c.tname AS construct_element, c.tstart AS construct_start, c.tend AS construct_end,
    CASE WHEN h.qstart < c.qstart THEN CASE WHEN h.strand='+' THEN h.tend ELSE h.tstart END ELSE CASE WHEN h.strand='+' THEN h.tstart ELSE h.tend END END AS junction_pos,
    CASE WHEN h.qstart < c.qstart THEN CASE WHEN (CASE WHEN c.strand='+' THEN c.tstart ELSE c.tend END) < c.tlen*0.3::DOUBLE THEN 'LB' WHEN (CASE WHEN c.strand='+' THEN c.tstart ELSE c.tend END) > c.tlen*0.7::DOUBLE THEN 'RB' ELSE 'LB' END
      ELSE CASE WHEN (CASE WHEN c.strand='+' THEN c.tend ELSE c.tstart END) > c.tlen*0.7::DOUBLE THEN 'RB' WHEN (CASE WHEN c.strand='+' THEN c.tend ELSE c.tstart END) < c.tlen*0.3::DOUBLE THEN 'LB' ELSE 'RB' END END AS junction_type,
    h.mapq AS host_mapq, h.line_no AS h_line, c.line_no AS c_line
    FROM {o_h} h JOIN {o_c} c USING (sample, qname) WHERE least(h.qend,c.qend) - greatest(h.qstart,c.qstart) <= 50
    AND (h.qend - h.qstart + (SELECT sum(hi-lo) FROM {o_cu} u WHERE u.sample=h.sample AND u.qname=h.qname) - (SELECT sum(greatest(0, least(h.qend,hi) - greatest(h.qstart,lo))) FROM {o_cu} u WHERE u.sample=h.sample AND u.qname=h.qname)) / h.qlen >= 0.5""")


def junction_rows(t):
    return jn.chimeric_junctions(_paf(t, "h"), _paf(t, "c"))


@query("rj12_chimeric_junctions", "SELECT sample, contig, contig_len, host_chr, host_start, host_end, host_strand, construct_element, construct_start, construct_end, host_mapq, h_line, c_line FROM {o_junctions}")
def rj12(t):
    return junction_rows(t).drop("junction_pos", "junction_type")


@query("rj13_junction_geometry", "SELECT sample, h_line, c_line, junction_pos, junction_type FROM {o_junctions}")
def rj13(t):
    return junction_rows(t).select("sample", "h_line", "c_line", "junction_pos", "junction_type")


@query("wn11_junction_confidence", """SELECT j.sample, h_line, c_line, CASE WHEN n = 2 THEN 'High' WHEN n = 1 THEN 'Medium' ELSE 'Low' END AS confidence FROM {o_junctions} j JOIN (SELECT sample, count(DISTINCT junction_type) AS n FROM {o_junctions} GROUP BY 1) k USING (sample)""")
def wn11(t):
    return jn.junction_confidence(junction_rows(t)).select("sample", "h_line", "c_line", "confidence")


WIDE = "SELECT sample, concat('contig',CAST(line_no % 700 AS STRING)) AS contig, concat('chr',CAST(tstart % 2 AS STRING)) AS host_chr, tstart*100 AS junction_pos, mapq AS host_mapq, line_no FROM {v_paf}"


@query("wn10_rearrangements", f"""WITH_J SELECT sample, contig, 'multi_chromosome' AS warning, count(DISTINCT host_chr) AS detail FROM j GROUP BY 1,2 HAVING count(*) >= 2 AND count(DISTINCT host_chr) > 1
    UNION ALL SELECT a.sample, a.contig, 'distant_pairs', count(*) FROM j a JOIN j b ON a.sample=b.sample AND a.contig=b.contig AND a.host_chr=b.host_chr AND a.line_no < b.line_no AND abs(a.junction_pos-b.junction_pos) > 100000 GROUP BY 1,2
    UNION ALL SELECT sample, NULL, 'low_mapq', count(*) FROM j WHERE host_mapq < 10 GROUP BY 1 HAVING count(*) >= 2""".replace("WITH_J ", "").replace("FROM j", "FROM {o_wide_j}").replace("JOIN j b", "JOIN {o_wide_j} b"))
def wn10(t):
    return jn.rearrangements(lines(t, WIDE))


fragment("o_wide_j", WIDE)


@query("ag25_paf_stats", "SELECT sample, count(*) AS total_alignments, count(DISTINCT qname) AS mapped_contigs, count(DISTINCT tname) AS target_sequences, CAST(sum(matches) AS BIGINT) AS total_aligned_bases FROM {v_paf} GROUP BY sample")
def ag25(t):
    return jn.paf_stats(t.v_paf)


@query("wn14_amplicon_partners", """SELECT sample, contig, host_chr, junction_pos, h_start, h_end, c_start, c_end FROM (SELECT j.*, c.qstart AS c_start, c.qend AS c_end, row_number() OVER (PARTITION BY j.sample, contig, host_chr, junction_pos ORDER BY c.qend-c.qstart-greatest(0, least(h_end,c.qend)-greatest(h_start,c.qstart)) DESC, c.line_no) AS k FROM (
      SELECT j.sample, j.contig, j.host_chr, j.junction_pos, h.qstart AS h_start, h.qend AS h_end FROM (SELECT DISTINCT sample, contig, host_chr, junction_pos FROM {o_junctions}) j JOIN {v_paf} h ON h.kind='h' AND h.sample=j.sample AND h.qname=j.contig
      QUALIFY row_number() OVER (PARTITION BY j.sample, j.contig, j.host_chr, j.junction_pos ORDER BY h.tname <> j.host_chr, h.qend-h.qstart DESC, h.line_no) = 1) j JOIN {v_paf} c ON c.kind='c' AND c.sample=j.sample AND c.qname=j.contig) x WHERE k = 1""")
def wn14(t):
    return jn.amplicon_partners(junction_rows(t), _paf(t, "h"), _paf(t, "c"))


_CLIP = r"greatest(coalesce(TRY_CAST(regexp_extract(cigar,'^(\d+)S',1) AS INTEGER),0), coalesce(TRY_CAST(regexp_extract(cigar,'(\d+)S$',1) AS INTEGER),0))"
fragment("o_evid", f"""SELECT s.sample, s.site_id, s.chrom, s.pos, count(*) FILTER (s.pos BETWEEN ref_start AND ref_end) AS depth, count(*) FILTER ({_CLIP} >= 20 AND (abs(ref_start-s.pos) < 50 OR abs(ref_end-s.pos) < 50)) AS soft_clipped, count(*) FILTER (has_sa) AS split_reads,
    count(*) FILTER ((flag & 1) <> 0 AND (flag & 2) = 0 AND (flag & 8) = 0) AS discordant_pairs FROM {{v_sites}} s LEFT JOIN (SELECT * FROM {{v_alignments}} WHERE (flag & 260) = 0) a ON a.sample=s.sample AND a.chrom=s.chrom AND ref_start < s.pos + 500 AND ref_end > greatest(0, s.pos - 500) GROUP BY 1,2,3,4""")


@query("ag18_junction_evidence", "SELECT * FROM {o_evid}")
def ag18(t):
    return jn.junction_evidence(t.v_alignments, t.v_sites)


_L, _R = r"coalesce(TRY_CAST(regexp_extract(cigar,'^(\d+)S',1) AS INTEGER),0)", r"coalesce(TRY_CAST(regexp_extract(cigar,'(\d+)S$',1) AS INTEGER),0)"
_near = f"(({_L} >= 15 AND abs(s1-p) < 30) OR ({_R} >= 15 AND abs(e1-p) < 30))"
fragment("o_zyg", f"""SELECT *, CASE WHEN spanning+clipped > 0 THEN clipped/(spanning+clipped) ELSE 0.0 END AS allele_fraction FROM (SELECT s.sample, s.site_id, count(*) FILTER (spans AND NOT near) AS spanning, count(*) FILTER (CASE WHEN spans THEN near ELSE edge END) AS clipped, count(*) FILTER (mate_near) AS discordant FROM {{v_sites}} s LEFT JOIN (
    SELECT *, s1 < p-10 AND e1 > p+10 AS spans, {_near} AS near, (abs(s1-p) < 30 OR abs(e1-p) < 30) AND ({_L} >= 15 OR {_R} >= 15) AS edge, (flag & 1) <> 0 AND (flag & 2) = 0 AND (flag & 8) = 0 AND (rnext='=' OR rnext=chrom) AND abs(pnext-p) < 200 AS mate_near FROM (
      SELECT a.*, s.site_id, s.pos AS p, ref_start+1 AS s1, ref_end+1 AS e1 FROM {{v_alignments}} a JOIN {{v_sites}} s ON a.sample=s.sample AND a.chrom=s.chrom AND ref_start+1 <= s.pos+200 AND ref_end >= s.pos-200 WHERE (flag & 4) = 0 AND mapq >= 10) x) r USING (sample, site_id) GROUP BY 1,2) g""")


@query("ag19_zygosity_counts", "SELECT * FROM {o_zyg}")
def ag19(t):
    return jn.zygosity_counts(t.v_alignments, t.v_sites)


@query("dt9_zygosity", """SELECT sample, site_id, CASE WHEN spanning+clipped < 5 THEN 'uncertain' WHEN allele_fraction >= 0.8 THEN 'homozygous' WHEN allele_fraction BETWEEN 0.3 AND 0.65 THEN 'heterozygous' WHEN allele_fraction > 0.65 THEN 'likely_homozygous'
    WHEN allele_fraction > 0.1 THEN 'likely_heterozygous' ELSE 'uncertain' END AS zygosity FROM {o_zyg}""")
def dt9(t):
    return jn.call_zygosity(jn.zygosity_counts(t.v_alignments, t.v_sites)).select("sample", "site_id", "zygosity")


def _control(t):
    return t.v_alignments.filter("mapq >= 55")


@query("dt8_control_reads", "SELECT sample, site_id, wt_reads FROM {v_sites} JOIN (SELECT sample, count(DISTINCT qname) AS wt_reads FROM {v_alignments} WHERE mapq >= 55 GROUP BY 1) w USING (sample)")
def dt8(t):
    return jn.control_reads(t.v_sites, _control(t)).select("sample", "site_id", "wt_reads")


@query("dt8_control_reads_local", "SELECT s.sample, s.site_id, count(DISTINCT qname) AS wt_reads FROM {v_sites} s LEFT JOIN {v_alignments} a ON a.sample=s.sample AND a.chrom=s.chrom AND a.mapq >= 55 AND abs(ref_start - s.pos) <= 60 GROUP BY 1,2")
def dt8b(t):
    return jn.control_reads(t.v_sites, _control(t), slop=60).select("sample", "site_id", "wt_reads")


EVROWS = """SELECT sample, site_id, CAST(n_borders*7 AS INT) AS host_mapq, n_elements AS split_reads, n_off_target*2 AS soft_clipped, n_elements + n_off_target AS discordant_pairs, construct_frac AS depth_ratio, CAST(largest_gap % 13 AS BIGINT) - 1 AS wt_reads FROM {v_evidence}"""
_SCORE = """(CASE WHEN host_mapq >= 30 THEN 2 WHEN host_mapq >= 10 THEN 1 ELSE 0 END + CASE WHEN split_reads >= 3 THEN 2 WHEN split_reads >= 1 THEN 1 ELSE 0 END + CASE WHEN soft_clipped >= 3 THEN 2 WHEN soft_clipped >= 1 THEN 1 ELSE 0 END
    + CASE WHEN discordant_pairs >= 3 THEN 1 ELSE 0 END + CASE WHEN depth_ratio > 0 AND depth_ratio < 0.3 THEN 1 ELSE 0 END + CASE WHEN wt_reads = 0 THEN 1 ELSE 0 END)"""
fragment("o_jv", f"SELECT *, {_SCORE} AS score, CASE WHEN host_mapq < 5 OR wt_reads > 10 THEN 'FALSE_POSITIVE' WHEN {_SCORE} >= 4 THEN 'TRUE' ELSE 'UNCERTAIN' END AS verdict FROM ({EVROWS}) e")


def junction_verdicts(t):
    return jn.junction_verdict(lines(t, EVROWS))


@query("dt7_junction_verdict", "SELECT sample, site_id, score, verdict FROM {o_jv}")
def dt7(t):
    return junction_verdicts(t).select("sample", "site_id", "score", "verdict")

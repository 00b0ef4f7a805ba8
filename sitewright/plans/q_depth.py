"""Depth and copy number: AG10-17, DT10-12, AG29."""
from __future__ import annotations

from pyspark.sql import functions as F

from sitewright.functions import copies_rounded, copy_class
from sitewright.operators import depth as dp
from sitewright.plans.q_reads import lines
from sitewright.plans.registry import fragment, query

REFS = "SELECT sample, chrom, max(site_pos) + 1000 AS length FROM {v_alignments} GROUP BY sample, chrom"
_BLOCKS = """SELECT sample, chrom, ref_start AS s, CASE WHEN cigar='50M2D50M' THEN ref_start+50 WHEN cigar='48M3I49M' THEN ref_start+48 ELSE ref_end END AS e FROM {v_alignments} WHERE (flag & 1796) = 0
    UNION ALL SELECT sample, chrom, CASE WHEN cigar='50M2D50M' THEN ref_start+52 ELSE ref_start+48 END, ref_end FROM {v_alignments} WHERE (flag & 1796) = 0 AND cigar IN ('50M2D50M','48M3I49M')"""
fragment("o_depth", f"""SELECT sample, chrom, pos, coalesce(n,0) AS depth FROM (SELECT sample, chrom, unnest(range(length)) AS pos FROM ({REFS}) r) g LEFT JOIN (
    SELECT sample, chrom, pos, count(*) AS n FROM (SELECT sample, chrom, unnest(range(s, e)) AS pos FROM ({_BLOCKS}) b) x GROUP BY 1,2,3) d USING (sample, chrom, pos)""")


def _runs(t):
    return dp.depth_runs(t.v_alignments, lines(t, REFS))


@query("ag10_depth", "SELECT sample, chrom, pos, depth FROM {o_depth}")
def ag10(t):
    return dp.expand_depth(_runs(t))


_SUMMARY = "count(*) AS positions, count(*) FILTER (depth > 0) AS covered, count(*) FILTER (depth > 0) * 100.0::DOUBLE / count(*) AS covered_pct, sum(depth) / count(*) AS mean_depth, list_sort(list(depth))[count(*)//2+1] AS median_depth, min(depth) AS min_depth, max(depth) AS max_depth"


@query("ag11_depth_summary", f"SELECT sample, {_SUMMARY} FROM {{o_depth}} GROUP BY sample")
def ag11(t):
    return dp.depth_summary(_runs(t))


@query("ag11_depth_summary_by_reference", f"SELECT sample, ref_name, {_SUMMARY} FROM {{v_depth}} GROUP BY 1,2")
def ag11b(t):
    return dp.depth_summary(t.v_depth, ("sample", "ref_name"))


@query("ag12_flagstat", "SELECT sample, count(*) AS total, count(*) FILTER ((flag & 4) = 0) AS mapped, count(*) FILTER ((flag & 4) = 0) / count(*) AS mapping_rate FROM {v_alignments} GROUP BY sample")
def ag12(t):
    return dp.flagstat(t.v_alignments)


fragment("o_el_median", "SELECT sample, ref_name, list_sort(list(depth))[count(*)//2+1] AS median FROM {v_depth} GROUP BY 1,2 HAVING count(*) FILTER (depth > 0) >= count(*)*0.5")
fragment("o_construct", """SELECT sample, CAST(coalesce(best, fallback, 0) AS DOUBLE) AS construct_median, marker FROM (SELECT DISTINCT sample FROM {v_depth}) s LEFT JOIN (SELECT sample, max(median) AS best, arg_min(ref_name, (-median, ref_name)) AS marker FROM {o_el_median} WHERE median > 0 GROUP BY 1) b USING (sample)
    LEFT JOIN (SELECT sample, list_sort(list(depth))[count(*)//2+1] AS fallback FROM {v_depth} WHERE depth > 0 GROUP BY 1) f USING (sample)""")
fragment("o_host", "SELECT sample, CAST(list_sort(list(depth))[count(*)//2+1] AS DOUBLE) AS host_median FROM {o_host_depth} GROUP BY 1")
HOSTDEPTH = "SELECT sample, ref_name, pos, depth + CAST(pos % 4 AS BIGINT) AS depth FROM {v_depth}"
fragment("o_host_depth", HOSTDEPTH)


@query("ag13_construct_median", "SELECT * FROM {o_construct}")
def ag13(t):
    return dp.construct_median(t.v_depth)


@query("ag13_construct_median_sparse", "SELECT sample, CAST(list_sort(list(depth))[count(*)//2+1] AS DOUBLE) AS construct_median FROM {v_depth} WHERE depth > 0 AND pos % 5 > 2 GROUP BY 1")
def ag13b(t):
    sparse = t.v_depth.withColumn("depth", F.when(F.col("pos") % 5 > 2, F.col("depth")).otherwise(0))
    return dp.construct_median(sparse).drop("marker")


@query("ag14_host_median", "SELECT sample, host_median, n FROM {o_host} JOIN (SELECT sample, count(*) AS n FROM {v_depth} GROUP BY 1) c USING (sample)")
def ag14(t):
    return dp.host_median(lines(t, HOSTDEPTH))


@query("ag15_flank_depth", """SELECT s.sample, s.site_id, coalesce(avg(depth) FILTER (d.pos BETWEEN greatest(0,s.pos-300) AND s.pos-20),0) AS depth_left, coalesce(avg(depth) FILTER (d.pos BETWEEN s.pos+20 AND s.pos+300),0) AS depth_right
    FROM {v_sites} s LEFT JOIN (SELECT * FROM {o_depth} WHERE depth > 0) d ON d.sample=s.sample AND d.chrom=s.chrom AND d.pos BETWEEN s.pos-300 AND s.pos+300 GROUP BY 1,2""")
def ag15(t):
    return dp.flank_depth(_runs(t), t.v_sites, 300, 20)


@query("ag16_binned_depth", """SELECT sample, ref_name, 100.0 + (CAST(floor((pos-100)*8/850.0) AS INTEGER) + 0.5)*(850.0::DOUBLE/8) AS center, avg(depth) AS mean_depth FROM {v_depth} WHERE pos BETWEEN 100 AND 949 GROUP BY ALL HAVING count(*) > 0""")
def ag16(t):
    return dp.binned_depth(t.v_depth, ["sample", "ref_name"], 100, 950)


@query("ag17_top_references", """SELECT sample, ref_name, mean_depth, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY mean_depth DESC, ref_name) AS rank FROM (SELECT sample, ref_name, sum(depth)/(max(pos)+1) AS mean_depth FROM {v_depth} GROUP BY 1,2) m WHERE mean_depth >= 1) r WHERE rank <= 15""")
def ag17(t):
    return dp.top_references(t.v_depth)


STATS = "SELECT sample, concat('insertion_',site_id,'_verdict') AS key, CASE WHEN largest_gap > 1998 THEN 'CANDIDATE' WHEN n_elements > 1 THEN 'FALSE_POSITIVE' ELSE 'UNKNOWN' END AS value FROM {v_evidence} UNION ALL SELECT sample, concat(site_id,'_status') AS key, 'CANDIDATE' AS value FROM {v_evidence}"
fragment("o_sitecount", f"SELECT sample, count(*) FILTER (suffix(key,'_verdict') AND value='CANDIDATE') AS candidate_sites FROM ({STATS}) s GROUP BY 1")


@query("ag29_candidate_sites", "SELECT * FROM {o_sitecount}")
def ag29(t):
    return dp.candidate_sites(lines(t, STATS))


_COPIES = "CASE WHEN ratio < 0.25 THEN round_even(ratio,2) WHEN ratio < 1.25 THEN 1.0 WHEN ratio < 1.75 THEN 2.0 ELSE round_even(ratio,1) END"
_CLASS = "CASE WHEN ratio < 0.25 THEN 'low-level / mosaic' WHEN ratio < 0.75 THEN 'hemizygous single-copy' WHEN ratio < 1.25 THEN 'homozygous single-copy (or 2 hemizygous copies)' WHEN ratio < 1.75 THEN 'likely 2-3 copies' ELSE concat('multi-copy (~',printf('%.1f',round_even(ratio,1)),'x)') END"
RATIO_CAST = "SELECT sample, site_id, CAST(host_fraction*3 AS DOUBLE) AS ratio, CAST(n_elements AS BIGINT) AS n, CAST(construct_frac*2 AS DOUBLE) AS cm, CAST(n_borders AS DOUBLE)/2 AS hm FROM {v_evidence}"


@query("dt10_copy_class", f"SELECT sample, site_id, {_CLASS} AS copy_class, CAST({_COPIES} AS DOUBLE) AS copies FROM ({RATIO_CAST}) r")
def dt10(t):
    return lines(t, RATIO_CAST).select("sample", "site_id", copy_class("ratio").alias("copy_class"), copies_rounded("ratio").alias("copies"))


_VALID = """CASE WHEN n = 0 THEN 'no_candidate_sites' WHEN n = 1 THEN CASE WHEN ratio <= 1.5 THEN 'consistent_single_locus' ELSE 'depth_suggests_multicopy_single_locus' END WHEN ratio > 1.5 THEN 'consistent_multi_locus' ELSE 'multiple_sites_but_low_depth' END"""


@query("dt11_copy_confidence", f"SELECT sample, site_id, {_VALID} AS site_validation, CASE WHEN hm < 1 OR cm < 1 THEN 'Low' WHEN n >= 1 AND contains({_VALID},'consistent') THEN 'High' WHEN n >= 1 THEN 'Medium' ELSE 'Low' END AS confidence FROM ({RATIO_CAST}) r")
def dt11(t):
    rows = lines(t, RATIO_CAST).withColumn("site_validation", dp.site_validation("n", "ratio"))
    return rows.select("sample", "site_id", "site_validation", dp.copy_confidence("cm", "hm", "n", "site_validation").alias("confidence"))


@query("dt12_copy_number", f"""SELECT sample, marker, construct_median, host_median, candidate_sites, ratio AS depth_ratio, CAST({_COPIES} AS DOUBLE) AS estimated_copies, {_CLASS} AS copy_description, {_VALID.replace('ratio', 'CAST(' + _COPIES + ' AS DOUBLE)')} AS site_validation,
    CASE WHEN host_median < 1 OR construct_median < 1 THEN 'Low' WHEN n >= 1 AND contains({_VALID.replace('ratio', 'CAST(' + _COPIES + ' AS DOUBLE)')},'consistent') THEN 'High' WHEN n >= 1 THEN 'Medium' ELSE 'Low' END AS confidence
    FROM (SELECT *, candidate_sites AS n, CASE WHEN host_median > 0 THEN construct_median/host_median ELSE 0 END AS ratio FROM {{o_construct}} JOIN {{o_host}} USING (sample) JOIN {{o_sitecount}} USING (sample)) c""")
def dt12(t):
    return dp.copy_number(t.v_depth, lines(t, HOSTDEPTH), lines(t, STATS))

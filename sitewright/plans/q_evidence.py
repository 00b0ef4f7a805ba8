"""Evidence and verdict: AG2-6, AG36, WN9, RJ8, RJ9, DT1-3, DT6, DT16, CU12."""
from __future__ import annotations

from pyspark.sql import functions as F

from sitewright.operators import core, evidence as ev
from sitewright.plans.q_reads import lines
from sitewright.plans.registry import fragment, query


def union_sql(rows, keys, slack=0):
    """Merged intervals by running maximum of the end."""
    return f"""SELECT {keys}, min(lo) AS lo, max(hi) AS hi FROM (SELECT *, sum(cut) OVER (PARTITION BY {keys} ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS island_no FROM (
      SELECT *, CASE WHEN lo <= max(hi) OVER (PARTITION BY {keys} ORDER BY lo, hi ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + {slack} THEN 0 ELSE 1 END AS cut FROM ({rows}) r) c) g GROUP BY {keys}, island_no"""


SPANS = "SELECT grp, pos AS lo, pos + n*60 + pos % 90 AS hi FROM {v_positions}"


@query("ag2_interval_union", "SELECT grp, count(*) AS n, CAST(sum(hi-lo) AS BIGINT) AS bp, CAST(sum(hi-lo+1) AS BIGINT) AS bp_closed FROM (" + union_sql(SPANS, "grp") + ") u GROUP BY grp")
def ag2(t):
    u = core.interval_union(lines(t, SPANS), ["grp"])
    return u.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), core.covered_bp(False).alias("bp"), core.covered_bp(True).alias("bp_closed"))


@query("ag2_interval_union_adjacent", union_sql(SPANS, "grp", 1))
def ag2b(t):
    return core.interval_union(lines(t, SPANS), ["grp"], adjacent=True)


MASKHITS = """SELECT concat('chr',CAST(l_suppkey % 5 + 1 AS STRING)) AS chrom, concat('el',CAST(l_partkey % 50 AS STRING)) AS element, CAST(90 + l_partkey % 11 AS DOUBLE) AS pident, 150 + l_orderkey % 200 AS length,
    CASE WHEN l_linenumber % 2 = 0 THEN 1 + l_orderkey*37 % 900000 ELSE l_orderkey*37 % 900000 + 150 + l_orderkey % 200 END AS sstart, CASE WHEN l_linenumber % 2 = 1 THEN 1 + l_orderkey*37 % 900000 ELSE l_orderkey*37 % 900000 + 150 + l_orderkey % 200 END AS send FROM {lineitem}"""
fragment("o_mask_rows", f"SELECT chrom, least(sstart,send)-1 AS lo, greatest(sstart,send) AS hi, element, pident FROM ({MASKHITS}) h WHERE pident >= 98 AND length >= 200")
fragment("o_mask", "SELECT u.chrom, u.lo AS start_pos, u.hi AS end_pos, array_to_string(list_sort(list(DISTINCT element)),';') AS name, max(pident) AS identity FROM (" + union_sql("SELECT * FROM {o_mask_rows}", "chrom") + ") u JOIN {o_mask_rows} r ON r.chrom = u.chrom AND r.lo >= u.lo AND r.hi <= u.hi GROUP BY 1,2,3")


@query("ag3_build_mask", "SELECT * FROM {o_mask}")
def ag3(t):
    return ev.build_mask(lines(t, MASKHITS))


@query("cu12_mask_rationale", "SELECT 'host1' AS host, chrom AS region_chr, start_pos AS region_start, end_pos AS region_end, name AS element_name, identity, end_pos - start_pos AS length, 'X-01' AS rationale_code, 'other >=98% identity endogenous (manual curation)' AS rationale_note FROM {o_mask}")
def cu12(t):
    return ev.mask_rationale(ev.build_mask(lines(t, MASKHITS)), "host1")


def _db(t, db):
    return t.v_insert_hits.filter(F.col("db") == db)


_HOSTROWS = "SELECT sample, site_id, least(qstart,qend) AS lo, greatest(qstart,qend) AS hi FROM {v_insert_hits} WHERE db='host' AND pident >= 90"
_CONROWS = "SELECT sample, site_id, least(qstart,qend) AS lo, greatest(qstart,qend) AS hi FROM {v_insert_hits} WHERE db='construct' AND pident >= 80"
fragment("o_host_union", union_sql(_HOSTROWS, "sample, site_id"))
fragment("o_host_frac", """SELECT i.sample, i.site_id, coalesce(bp,0) AS host_bp, CASE WHEN insert_len - n_count > 0 THEN coalesce(bp,0) / (insert_len - n_count) ELSE 0.0 END AS host_fraction, coalesce(greatest(gap, insert_len - last_hi), insert_len) AS largest_gap
    FROM {v_inserts} i LEFT JOIN (SELECT sample, site_id, CAST(sum(hi-lo+1) AS BIGINT) AS bp, max(lo - coalesce(prev,0) - 1) AS gap, max(hi) AS last_hi FROM (SELECT *, lag(hi) OVER (PARTITION BY sample, site_id ORDER BY lo) AS prev FROM {o_host_union}) p GROUP BY 1,2) h USING (sample, site_id)""")
fragment("o_off", """SELECT sample, site_id, chrom, bp FROM (SELECT h.sample, h.site_id, subject AS chrom, CAST(sum(length) AS BIGINT) AS bp FROM {v_insert_hits} h WHERE db='host' AND pident >= 98 GROUP BY 1,2,3) b JOIN {v_inserts} i USING (sample, site_id) WHERE chrom <> site_chr AND bp >= 150""")
fragment("o_con", """SELECT i.sample, i.site_id, CASE WHEN insert_len - n_count <= 0 OR bp IS NULL THEN 0.0 ELSE bp / (insert_len - n_count) END AS construct_frac,
    CASE WHEN insert_len - n_count <= 0 THEN 0.0 WHEN bp IS NULL THEN host_fraction ELSE least(1.0, (bp + host_bp) / (insert_len - n_count)) END AS combined_frac FROM {v_inserts} i JOIN {o_host_frac} USING (sample, site_id)
    LEFT JOIN (SELECT sample, site_id, CAST(sum(hi-lo+1) AS BIGINT) AS bp FROM (""" + union_sql(_CONROWS, "sample, site_id", 1) + ") u GROUP BY 1,2) c USING (sample, site_id)")


@query("ag4_host_fraction", "SELECT sample, site_id, host_bp, host_fraction, largest_gap FROM {o_host_frac}")
def ag4(t):
    return ev.host_fraction(t.v_inserts, _db(t, "host")).select("sample", "site_id", "host_bp", "host_fraction", "largest_gap")


@query("ag5_off_target", "SELECT sample, site_id, count(*) AS n, string_agg(concat(chrom,':',bp),'|' ORDER BY bp DESC, chrom) AS off_target FROM {o_off} GROUP BY 1,2")
def ag5(t):
    o = ev.off_target(t.v_inserts, _db(t, "host"))
    text = F.array_join(F.transform("off_target", lambda x: F.concat(x["chrom"], F.lit(":"), x["bp"].cast("string"))), "|")
    return o.select("sample", "site_id", F.size("off_target").cast("bigint").alias("n"), text.alias("off_target"))


@query("ag6_construct_coverage", "SELECT sample, site_id, construct_frac, combined_frac FROM {o_con}")
def ag6(t):
    return ev.construct_coverage(ev.host_fraction(t.v_inserts, _db(t, "host")), _db(t, "construct")).select("sample", "site_id", "construct_frac", "combined_frac")


FLANK = """SELECT concat('chr',CAST(s_suppkey % 5 + 1 AS STRING)) AS chrom, CAST(90 + s_suppkey % 11 AS DOUBLE) AS pident, 30 + s_suppkey % 60 AS length, 4000 AS qlen, s_suppkey*41 % 4000 AS qstart, s_suppkey*41 % 4000 + 80 AS qend,
    CASE WHEN s_suppkey % 2 = 0 THEN s_suppkey*977 % 100000 ELSE s_suppkey*977 % 100000 + 80 END AS sstart, CASE WHEN s_suppkey % 2 = 1 THEN s_suppkey*977 % 100000 ELSE s_suppkey*977 % 100000 + 80 END AS send, s_suppkey AS region_idx FROM {supplier}"""
fragment("o_flank", f"SELECT chrom, least(sstart,send) AS lo, greatest(sstart,send) AS hi, region_idx FROM ({FLANK}) f WHERE pident >= 95 AND length >= 50 AND (qstart <= 100 OR qend >= qlen - 100)")
FLANK_WIDE = FLANK.replace("qend,", "qend,").replace("s_suppkey*41 % 4000 AS qstart", "s_suppkey*41 % 190 AS qstart")
fragment("o_flank_wide", f"SELECT chrom, least(sstart,send) AS lo, greatest(sstart,send) AS hi, region_idx FROM ({FLANK_WIDE}) f WHERE pident >= 95 AND length >= 50 AND (qstart <= 100 OR qend >= qlen - 100)")
fragment("o_flank_hit", "SELECT sample, site_id, arg_min({'c': f.chrom, 'lo': lo-500, 'hi': hi+500}, region_idx) AS f FROM {v_inserts} i JOIN {o_flank_wide} f ON f.chrom = i.site_chr AND site_pos BETWEEN lo-500 AND hi+500 GROUP BY 1,2")


@query("rj8_flanking_regions", "SELECT chrom, CAST(lo AS BIGINT) AS lo, CAST(hi AS BIGINT) AS hi, region_idx FROM {o_flank}")
def rj8(t):
    return ev.flanking_regions(lines(t, FLANK))


@query("rj9_site_flanking", "SELECT sample, site_id, f.c AS chrom, f.lo AS lo, f.hi AS hi FROM {o_flank_hit}")
def rj9(t):
    return ev.site_flanking(t.v_inserts, ev.flanking_regions(lines(t, FLANK_WIDE))).select("sample", "site_id", "flanking_hit.*")


COPIES = """SELECT sample, site_id, CASE WHEN qstart % 3 = 0 THEN concat(subject,'_a_long_element_name_over_thirty') ELSE subject END AS element, qstart AS sstart, qend AS send FROM {v_insert_hits} WHERE db='construct' AND pident >= 80"""
fragment("o_copies", f"SELECT sample, site_id, element, count(*) AS copies, array_to_string(list_sort(list(DISTINCT CASE WHEN sstart < send THEN '+' ELSE '-' END)),'') AS strands FROM ({COPIES}) c GROUP BY 1,2,3")


@query("ag36_element_copies", "SELECT * FROM {o_copies}")
def ag36(t):
    return ev.element_copies(lines(t, COPIES))


@query("wn9_structure", """SELECT sample, site_id, CASE WHEN bool_or(strands='+-' AND length(element) > 30) THEN 'head-to-head 2-copy T-DNA' WHEN sum(copies) > 3 AND max(copies) >= 2 THEN concat('multi-copy (≥',max(copies),' copies)') ELSE 'single-copy' END AS structure FROM {o_copies} GROUP BY 1,2""")
def wn9(t):
    return ev.structure(ev.element_copies(lines(t, COPIES)))


ENDO = "SELECT DISTINCT concat('P-el',CAST(p_partkey % 50 AS STRING)) AS qseqid FROM {part} WHERE p_partkey % 50 < 12"
fragment("o_elems", f"SELECT sample, site_id, count(*) AS n, count(*) FILTER (element IN (SELECT qseqid FROM ({ENDO}) e)) AS n_endo, list(element) AS elements FROM {{o_copies}} GROUP BY 1,2")
_live = "NOT (coalesce(n,0) > 0 AND n = n_endo)"
fragment("o_evidence", f"""SELECT i.sample, i.site_id, i.site_chr, i.site_pos, coalesce(n,0) AS n_elements, coalesce(n_endo,0) AS n_endo, coalesce(elements, []) AS elements, CASE WHEN {_live} THEN host_fraction ELSE 0.0 END AS host_fraction,
    CASE WHEN {_live} THEN host_bp ELSE 0 END AS host_bp, CASE WHEN {_live} THEN largest_gap ELSE 0 END AS largest_gap, CASE WHEN {_live} THEN construct_frac ELSE 0.0 END AS construct_frac, CASE WHEN {_live} THEN combined_frac ELSE 0.0 END AS combined_frac,
    CASE WHEN {_live} THEN coalesce(n_off,0) ELSE 0 END AS n_off_target, {_live} AND f IS NOT NULL AS in_flank FROM {{v_inserts}} i LEFT JOIN {{o_elems}} e USING (sample, site_id) JOIN {{o_host_frac}} USING (sample, site_id) JOIN {{o_con}} USING (sample, site_id)
    LEFT JOIN (SELECT sample, site_id, count(*) AS n_off FROM {{o_off}} GROUP BY 1,2) o USING (sample, site_id) LEFT JOIN {{o_flank_hit}} fh USING (sample, site_id)""")


def _evidence(t):
    endo = lines(t, ENDO)
    return ev.build_evidence(t.v_inserts, ev.element_copies(lines(t, COPIES)), endo, _db(t, "host"), _db(t, "construct"), ev.flanking_regions(lines(t, FLANK_WIDE)))


EVCOLS = ["sample", "site_id", "site_chr", "site_pos", "host_fraction", "host_bp", "largest_gap", "construct_frac", "combined_frac"]


@query("dt3_build_evidence", f"SELECT {', '.join(EVCOLS)}, n_elements, n_endo, n_off_target, in_flank FROM {{o_evidence}}")
def dt3(t):
    e = _evidence(t)
    return e.select(*EVCOLS, F.size("elements").cast("bigint").alias("n_elements"), F.size("host_endogenous_elements").cast("bigint").alias("n_endo"),
                    F.col("n_off_target").cast("bigint").alias("n_off_target"), F.col("flanking_hit").isNotNull().alias("in_flank"))


RULES = ev.VerdictRules(canonical_triplets={"a": {"P-el1", "P-el14"}, "b": {"P-el20", "P-el21_a_long_element_name_over_thirty"}})
TRIPLET = "(list_has_all(elements, ['P-el1','P-el14']) OR list_has_all(elements, ['P-el20','P-el21_a_long_element_name_over_thirty']))"


def verdict_sql(triplet, endo, flank, off, comb, n):
    return f"""CASE WHEN {triplet} AND host_fraction < 0.80 THEN '1' WHEN {endo} THEN '1.5' WHEN {flank} THEN '2' WHEN {off} >= 2 THEN '3' WHEN construct_frac >= 0.25 AND {comb} >= 0.85 THEN '4'
    WHEN host_fraction >= 0.80 AND largest_gap < 500 THEN '5' WHEN {n} > 0 THEN '6' WHEN host_fraction >= 0.85 AND construct_frac <= 0.05 THEN '7' ELSE '8' END"""


_label = "CASE WHEN rule IN ('1','6') THEN 'CANDIDATE' WHEN rule = '8' THEN 'UNKNOWN' ELSE 'FALSE_POSITIVE' END"


@query("dt1_verdict_pipeline", f"SELECT sample, site_id, rule, {_label} AS verdict FROM (SELECT *, {verdict_sql(TRIPLET, 'n_elements > 0 AND n_elements = n_endo', 'in_flank', 'n_off_target', 'combined_frac', 'n_elements')} AS rule FROM {{o_evidence}}) e")
def dt1b(t):
    return ev.verdict(_evidence(t), RULES).select("sample", "site_id", "rule", "verdict")


VEV = "SELECT *, least(CAST(1 AS DOUBLE), host_fraction + construct_frac) AS combined_frac FROM {v_evidence}"
fragment("o_verdicts", f"""SELECT *, {_label} AS verdict FROM (SELECT *, {verdict_sql('triplet AND n_elements >= 3', 'all_endogenous AND n_elements > 0', 'in_flank', 'n_off_target', 'least(1.0::DOUBLE, host_fraction + construct_frac)', 'n_elements')} AS rule FROM {{v_evidence}}) e""")
TRIPLE_RULES = ev.VerdictRules(canonical_triplets={"default": {"e0", "e1", "e2"}})


def evidence_rows(t):
    names = F.transform(F.slice(F.array(F.lit("e0"), F.lit("e1"), F.lit("e2")), F.lit(1), F.col("n_elements").cast("int")), lambda x: x)
    base = lines(t, VEV)
    elements = F.when(F.col("triplet") | (F.col("n_elements") < 3), names).otherwise(F.array(F.lit("e0"), F.lit("e1"), F.lit("x")))
    hit = F.when(F.col("in_flank"), F.struct(F.col("site_chr").alias("chrom"), (F.col("site_pos") - 5).alias("lo"), F.col("site_pos").alias("hi")))
    return base.withColumns({"elements": elements, "matched_canonical": elements, "flanking_hit": hit,
                             "host_endogenous_elements": F.when(F.col("all_endogenous"), elements).otherwise(F.array().cast("array<string>"))})


def verdicts(t):
    return ev.verdict(evidence_rows(t), TRIPLE_RULES)


@query("dt1_verdict", "SELECT sample, site_id, rule, verdict FROM {o_verdicts}")
def dt1(t):
    return verdicts(t).select("sample", "site_id", "rule", "verdict")


@query("dt2_canonical_override", "SELECT sample, site_id, CASE WHEN triplet AND n_elements >= 3 AND host_fraction < 0.80 THEN 'CANDIDATE' ELSE verdict END AS verdict FROM (SELECT *, CASE WHEN n_borders > 3 THEN 'UNKNOWN' ELSE 'FALSE_POSITIVE' END AS verdict FROM {v_evidence}) e")
def dt2(t):
    rows = evidence_rows(t).withColumn("verdict", F.when(F.col("n_borders") > 3, "UNKNOWN").otherwise("FALSE_POSITIVE"))
    return ev.canonical_override(rows, TRIPLE_RULES).select("sample", "site_id", "verdict")


@query("dt6_promote_unknown", "SELECT sample, site_id, CASE WHEN verdict='UNKNOWN' AND n_borders >= 4 AND largest_gap >= 1000 THEN 'CANDIDATE_LOW_CONF' ELSE verdict END AS verdict FROM {o_verdicts}")
def dt6(t):
    return ev.promote_unknown(verdicts(t)).select("sample", "site_id", "verdict")


TOPHITS = """SELECT sample, qseqid, CASE db_idx + CAST(length % 3 AS INT)*3 WHEN 0 THEN 'Oryza sativa chromosome' WHEN 1 THEN 'Binary vector pX' WHEN 2 THEN 'Cloning plasmid' WHEN 3 THEN 'oryza vector' WHEN 4 THEN 'Agrobacterium T-DNA' ELSE 'other' END AS title, pident, bitscore, line_no, sseqid FROM {v_hits}"""


@query("dt16_classify_top_hit", f"""SELECT sample, qseqid, title, pident, CASE WHEN pident < 85 THEN 'CANDIDATE' WHEN contains(lower(title),'oryza') THEN 'FALSE_POSITIVE' WHEN regexp_matches(lower(title),'agrobacterium|t-dna|vector|plasmid') THEN 'TRUE_INSERTION' ELSE 'CANDIDATE' END AS classification
    FROM ({TOPHITS}) h QUALIFY row_number() OVER (PARTITION BY sample, qseqid ORDER BY bitscore DESC, line_no, sseqid) = 1""")
def dt16(t):
    return ev.classify_top_hit(lines(t, TOPHITS).withColumn("line_no", F.struct("line_no", "sseqid")), ["Oryza"])

"""Greedy folds, similarity, primers: WN2, WN3, WN5, WN8, WN15, WN16, RJ11, RJ22, RJ23, IT2, IT3, DT17, DT19."""
from __future__ import annotations

from pyspark.sql import functions as F

from sitewright.functions import sequence as sq
from sitewright.operators import annotations as an, primers as pr, similarity as sm
from sitewright.plans.q_functions import _nn
from sitewright.plans.q_reads import lines, lines_once
from sitewright.plans.registry import fragment, query
from sitewright.plans.views import dna, _tagged

ELEMENTS = "SELECT sample, qseqid AS query, split_part(sseqid,'|',1) AS short_name, qstart AS q_start, qend AS q_end, bitscore, line_no, CASE db_idx WHEN 0 THEN 'promoter' WHEN 1 THEN 'terminator' ELSE 'coding' END AS category, db_idx FROM {v_hits}"
_S = "STRUCT(lo BIGINT, hi BIGINT, line BIGINT)[]"


def fold_sql(order, body):
    return f"""SELECT sample, query, (k).line AS line_no FROM (SELECT sample, qseqid AS query, unnest(list_reduce(list({{'lo': qstart, 'hi': qend, 'line': line_no}} ORDER BY {order}), lambda acc, x: {body}, []::{_S})) AS k FROM {{v_hits}} GROUP BY 1,2) f"""


@query("wn2_merge_annotations", fold_sql("bitscore DESC, CASE WHEN db_idx < 2 THEN 0 ELSE 1 END, line_no",
       "CASE WHEN len(list_filter(acc, lambda c: least(x.hi,c.hi)-greatest(x.lo,c.lo)+1 > 0.80*(x.hi-x.lo+1))) > 0 THEN acc ELSE list_append(acc, x) END"))
def wn2(t):
    h = lines(t, ELEMENTS)
    return an.merge_annotations(h.filter("db_idx < 2"), h.filter("db_idx = 2")).select("sample", "query", "line_no")


@query("wn3_dedupe_elements", fold_sql("qstart, line_no", """CASE WHEN coalesce(list_position(list_transform(acc, lambda c: x.lo < c.hi AND x.hi > c.lo), true), 0) = 0 THEN list_append(acc, x)
    ELSE list_transform(acc, lambda c, i: CASE WHEN i = list_position(list_transform(acc, lambda e: x.lo < e.hi AND x.hi > e.lo), true) AND x.hi - x.lo > c.hi - c.lo THEN x ELSE c END) END"""))
def wn3(t):
    return an.dedupe_elements(lines(t, ELEMENTS)).select("sample", "query", "line_no")


fragment("o_kept", fold_sql("qend - qstart DESC, line_no", "CASE WHEN len(list_filter(acc, lambda c: least(x.hi,c.hi) > greatest(x.lo,c.lo) AND (least(x.hi,c.hi)-greatest(x.lo,c.lo)) > 0.5*(x.hi-x.lo))) > 0 THEN acc ELSE list_append(acc, x) END"))


@query("wn5_filter_overlaps", "SELECT * FROM {o_kept}")
def wn5(t):
    return an.filter_overlaps(lines(t, ELEMENTS)).select("sample", "query", "line_no")


fragment("o_items", f"SELECT e.* FROM ({ELEMENTS}) e JOIN {{o_kept}} k USING (sample, query, line_no)")
_pick = lambda c: f"list_sort(list({{'s': q_start, 'e': q_end, 'n': short_name}}) FILTER (category='{c}'))"
_free = "list_filter(range(1, len(ts)+1), lambda i: ts[i].s > p.e AND NOT list_contains(list_transform(acc, lambda a: a.i), i))"


@query("wn8_cassettes", f"""SELECT sample, query, (k).p AS promoter, ts[(k).i].n AS terminator, (k).s AS q_start, ts[(k).i].e AS q_end, coalesce(array_to_string(list_transform(list_filter(cs, lambda c: c.s >= (k).s AND c.e <= ts[(k).i].e), lambda c: c.n), ','),'') AS cds FROM (
    SELECT sample, query, ts, cs, unnest(list_reduce(ps, lambda acc, p: CASE WHEN len({_free}) = 0 THEN acc ELSE list_append(acc, {{'p': p.n, 's': p.s, 'i': list_sort(list_transform({_free}, lambda i: {{'d': ts[i].s - p.e, 'i': i}}))[1].i}}) END, []::STRUCT(p VARCHAR, s BIGINT, i BIGINT)[])) AS k
    FROM (SELECT sample, query, {_pick('promoter')} AS ps, {_pick('terminator')} AS ts, {_pick('coding')} AS cs FROM {{o_items}} GROUP BY 1,2) g WHERE ps IS NOT NULL AND ts IS NOT NULL) h""")
def wn8(t):
    return an.cassettes(an.filter_overlaps(lines(t, ELEMENTS))).withColumn("cds", F.array_join("cds", ","))


JUNC = "SELECT sample, tname AS chrom, tstart*150 AS pos, line_no FROM {v_paf} WHERE tp = 'P'"


# sites of one position are numbered in the order in which the fold makes them
@query("rj11_pair_junctions", f"""SELECT sample, chrom, a AS pos_5p, b AS pos_3p, concat('insertion_',chrom,'_',a,CASE WHEN k > 1 THEN concat('_',k) ELSE '' END) AS site_id FROM (SELECT *, row_number() OVER (PARTITION BY sample, chrom, a ORDER BY i) AS k FROM (
    SELECT sample, chrom, r[i].a AS a, r[i].b AS b, i FROM (SELECT sample, chrom, CASE WHEN s.o IS NULL THEN s.r ELSE list_append(s.r, {{'a': s.o, 'b': 0}}) END AS r FROM (SELECT sample, chrom, list_reduce(list(pos ORDER BY pos, line_no),
      lambda a, x: CASE WHEN a.o IS NULL THEN {{'o': x, 'r': a.r}} WHEN x - a.o <= 50000 THEN {{'o': NULL::BIGINT, 'r': list_append(a.r, {{'a': a.o, 'b': x}})}} ELSE {{'o': x, 'r': list_append(a.r, {{'a': a.o, 'b': 0::BIGINT}})}} END, {{'o': NULL::BIGINT, 'r': []::STRUCT(a BIGINT, b BIGINT)[]}}) AS s FROM ({JUNC}) j GROUP BY 1,2) f) g, unnest(range(1, len(r) + 1)) u(i)) h) q""")
def rj11(t):
    return an.pair_junctions(lines(t, JUNC))


# ---- similarity ----

_BASE = dna(*[_tagged(p, "s_suppkey % 499") for p in "ABCD"])
CONTIGS = f"SELECT s.sample, {_BASE} AS seq FROM {{supplier}} CROSS JOIN (SELECT 's0' AS sample UNION ALL SELECT 's1' AS sample) s"
PAIRS = "SELECT a.sample, a.qname, a.seq AS r1, b.seq AS r2 FROM {v_reads} a JOIN {v_reads} b ON a.sample = b.sample AND a.qname = b.qname AND a.mate = 1 AND b.mate = 2"
_RC = "reverse(translate({c},'ACGT','TGCA'))"


@query("rj22_recruit_pairs", f"""SELECT DISTINCT sample, qname FROM (SELECT sample, qname, substr(s, i*12+1, 25) AS m FROM (SELECT sample, qname, r1 AS s FROM ({PAIRS}) p WHERE NOT contains(r1,'N') AND NOT contains(r2,'N') UNION ALL SELECT sample, qname, {_RC.format(c='r2')} FROM ({PAIRS}) p WHERE NOT contains(r1,'N') AND NOT contains(r2,'N')) x, unnest(range((length(s)-25)//12+1)) u(i) WHERE length(s) >= 25) k
    SEMI JOIN (SELECT DISTINCT sample, substr(s, i+1, 25) AS m FROM (SELECT sample, seq AS s FROM ({CONTIGS}) c UNION ALL SELECT sample, {_RC.format(c='seq')} FROM ({CONTIGS}) c) y, unnest(range(length(s)-24)) u(i)) z USING (sample, m)""")
def rj22(t):
    return sm.recruit_pairs(lines(t, CONTIGS), lines_once(t, PAIRS))


QUERIES = "SELECT sample, concat(qname, '/', CAST(mate AS STRING)) AS qseqid, CASE WHEN length(seq) % 2 = 0 THEN concat(substr(seq,1,18),'A',substr(seq,20)) ELSE reverse(translate(seq,'ACGT','TGCA')) END AS seq FROM {v_reads}"
SUBJECTS = f"SELECT concat('e',CAST(s_suppkey AS STRING)) AS sseqid, {_BASE} AS seq FROM {{supplier}}"


def hits_sql(queries: str, subjects: str) -> str:
    """Seeded hits of ``queries`` (sample, qseqid, seq) in ``subjects`` (sseqid, seq)."""
    return f"""SELECT sample, qseqid, sseqid, strand, length, pident, score, CAST(CASE WHEN strand='+' THEN a+1 ELSE n-b+1 END AS INTEGER) AS qstart, CAST(CASE WHEN strand='+' THEN a+d+1 ELSE b+d END AS INTEGER) AS sstart, CAST(hit_rank AS INTEGER) AS hit_rank FROM (
    SELECT h.*, q.sample, q.qseqid, s.sseqid, row_number() OVER (PARTITION BY q.sample, q.qseqid ORDER BY score DESC, s.sseqid, strand, CASE WHEN strand='+' THEN a+d+1 ELSE b+d END, CASE WHEN strand='+' THEN a+1 ELSE n-b+1 END) AS hit_rank FROM (
      SELECT *, (length - hm) * 100.0::DOUBLE / length AS pident, CAST((length - hm)*4 - length*3 AS INTEGER) AS score FROM (SELECT qt, st, strand, d, a, b, CAST(b-a AS INTEGER) AS length, length(qt) AS n, hamming(substr(o, a+1, b-a), substr(st, a+d+1, b-a)) AS hm FROM (
        SELECT qt, o, strand, st, d, min(i) AS a, max(i)+11 AS b FROM (SELECT *, sum(cut) OVER (PARTITION BY qt, o, strand, st, d ORDER BY i) AS island FROM (SELECT *, CASE WHEN i - lag(i) OVER (PARTITION BY qt, o, strand, st, d ORDER BY i) <= 22 THEN 0 ELSE 1 END AS cut FROM (SELECT DISTINCT qt, o, strand, st, i, j-i AS d FROM (SELECT qt, o, strand, i, substr(o, i+1, 11) AS m FROM (SELECT seq AS qt, seq AS o, '+' AS strand FROM (SELECT DISTINCT seq FROM ({queries}) q) d UNION ALL SELECT seq, {_RC.format(c='seq')}, '-' FROM (SELECT DISTINCT seq FROM ({queries}) q) d) x, unnest(range(length(o)-10)) u(i) WHERE length(o) >= 11) qk
        JOIN (SELECT st, j, substr(st, j+1, 11) AS m FROM (SELECT DISTINCT seq AS st FROM ({subjects}) s) y, unnest(range(length(st)-10)) v(j)) sk USING (m)) e) f) f2 GROUP BY qt, o, strand, st, d, island) g WHERE b-a >= 20) k WHERE (length - hm) * 100.0::DOUBLE / length >= 80) h
      JOIN ({queries}) q ON q.seq = h.qt JOIN ({subjects}) s ON s.seq = h.st) r"""


@query("rj23_kmer_hits", hits_sql(QUERIES, SUBJECTS))
def rj23(t):
    return sm.kmer_hits(lines_once(t, QUERIES), lines(t, SUBJECTS)).drop("qend", "send")


INSERTS = "SELECT p_partkey AS insert_id, concat(host, CASE WHEN p_partkey % 3 = 0 THEN 'TGGCAGGATATATTGTGGTGTAAAC' WHEN p_partkey % 3 = 1 THEN 'GTTTACACCACTTTATATCCAGCCA' ELSE '' END, elem, CASE WHEN p_partkey % 5 = 0 THEN 'TGGCAGGATATTTTGTGCTGTAAAC' ELSE '' END) AS seq FROM {part} JOIN {v_loci} ON loc = p_partkey % 997"
_M = sm.BORDER_MOTIF


@query("it3_border_hits", f"SELECT insert_id, 2 * count(*) FILTER (hamming(substr(seq,i+1,25), '{_M}') <= 4) + 2 * count(*) FILTER (hamming(substr(seq,i+1,25), reverse(translate('{_M}','ACGT','TGCA'))) <= 4) AS n_borders FROM ({INSERTS}) s, unnest(range(length(seq)-24)) u(i) GROUP BY 1")
def it3(t):
    return sm.border_hits(lines(t, INSERTS), ["insert_id"])


MERGE = "SELECT p_partkey, host AS c5, CASE WHEN p_partkey % 3 = 0 THEN elem ELSE concat(right(host, CAST(20 + p_partkey % 60 AS INT)), elem) END AS c3 FROM {part} JOIN {v_loci} ON loc = p_partkey % 997"


@query("dt17_merge_contigs", f"SELECT p_partkey, CAST(coalesce(o,0) AS INTEGER) AS overlap, CASE WHEN o > 0 THEN concat(c5, substr(c3, o+1)) END AS merged FROM (SELECT *, list_max(list_filter(range(30, least(length(c5),length(c3),500)+1), lambda o: right(c5,o) = left(c3,o))) AS o FROM ({MERGE}) m) x")
def dt17(t):
    return sm.merge_contigs(lines(t, MERGE)).select("p_partkey", "overlap", "merged")


TERM = "SELECT sample, qname AS site_id, CASE kind WHEN 'h' THEN '5p' ELSE '3p' END AS end, matches - 250 AS matches, CAST(line_no % 40 + 45 AS BIGINT) AS block_len FROM {v_paf}"


@query("dt19_host_terminated", "SELECT sample, site_id, bool_or(ok AND e = '5p') AS reached_5p, bool_or(ok AND e = '3p') AS reached_3p FROM (SELECT sample, qname AS site_id, CASE kind WHEN 'h' THEN '5p' ELSE '3p' END AS e, matches - 250 >= 50 AND line_no % 40 + 45 >= 50 AND (matches-250)/(line_no % 40 + 45) >= 0.95 AS ok FROM {v_paf}) x GROUP BY 1,2")
def dt19(t):
    rows = t.v_paf.select("sample", F.col("qname").alias("site_id"), F.when(F.col("kind") == "h", "5p").otherwise("3p").alias("end"),
                          (F.col("matches") - 250).alias("matches"), (F.col("line_no") % 40 + 45).alias("block_len"))
    return sm.host_terminated(rows)


SEEDS = f"SELECT s.sample, concat('seed',CAST(s_suppkey AS STRING)) AS site_id, substr({_BASE},1,30) AS seq FROM {{supplier}} CROSS JOIN (SELECT 's0' AS sample UNION ALL SELECT 's1' AS sample) s"


@query("it2_extend_seeds")
def it2(t):
    from sitewright.operators.reads import read_pool
    pool = read_pool(t.once("v_reads")).select("sample", F.concat("qname", F.lit("/"), F.col("mate").cast("string")).alias("read_id"), "seq")
    return sm.extend_seeds(lines(t, SEEDS), pool)


# ---- primers ----

_prs = "list_transform(range(1, length(p)), lambda i: substr(p, i, 2))"
_TM = f"""((list_sum(list_transform({_prs}, lambda z: {_nn(sq.NN_ENTHALPY, -7.5, 'z')})) + 0.2) * 1000.0::DOUBLE / (list_sum(list_transform({_prs}, lambda z: {_nn(sq.NN_ENTROPY, -21.0, 'z')})) - 5.7 + 0.368::DOUBLE * (length(p)-1) * ln(0.05::DOUBLE) + 1.987::DOUBLE * ln(250e-9::DOUBLE/4)) - 273.15)"""
fragment("o_frame", f"""SELECT *, substr(seq, a+1, b-a) AS amp, at_ - a AS off FROM (SELECT *, CASE WHEN b0 - a < 150 THEN least(n, a+150) ELSE b0 END AS b FROM (SELECT *, CASE WHEN b0-a0 < 150 AND a0 > 0 THEN greatest(0, a0 - (150-(b0-a0))) ELSE a0 END AS a FROM (
    SELECT *, greatest(0, at_-100) AS a0, least(n, at_+100) AS b0 FROM (SELECT *, length(seq) AS n, CASE WHEN h_end <= c_start THEN (h_end+c_start)//2 WHEN c_end <= h_start THEN (c_end+h_start)//2 ELSE (greatest(h_start,c_start)+least(h_end,c_end))//2 END AS at_,
      CASE WHEN h_end <= c_start THEN 'left' WHEN c_end <= h_start THEN 'right' WHEN h_start < c_start THEN 'left' ELSE 'right' END AS host_region FROM {{v_contig_pairs}} x) q) w) e) r WHERE b - a >= 150""")


def _pick_sql(which):
    limit = "off" if which == "f" else "(length(amp)-off)"
    region = "substr(amp, w+1, 30)" if which == "f" else "substr(amp, greatest(length(amp)-w-30,0)+1, least(30, length(amp)-w))"
    text = "substr(r,1,l)" if which == "f" else _RC.format(c="right(r,l)")
    pos = "w" if which == "f" else "length(amp)-w"
    return f"""SELECT sample, contig, arg_min({{'p': p, 'tm': tm, 'gc': gc, 'pos': {pos}}}, (w, band, abs(tm-60), l)) AS x FROM (SELECT *, {_TM} AS tm, CASE WHEN gc BETWEEN 0.35 AND 0.65 THEN 0 WHEN gc BETWEEN 0.25 AND 0.75 THEN 1 END AS band FROM (
      SELECT *, (length(p)-length(translate(p,'GC','')))::DOUBLE/length(p) AS gc FROM (SELECT *, {text} AS p FROM (SELECT sample, contig, amp, w, {region} AS r FROM {{o_frame}}, unnest(range(0, least({limit}, length(amp)-25), 5)) u(w)) a, unnest(range(18,26)) v(l)) b WHERE NOT (contains(p,'AAAA') OR contains(p,'CCCC') OR contains(p,'GGGG') OR contains(p,'TTTT') OR contains(p,'N'))) c) d WHERE band IS NOT NULL GROUP BY 1,2"""


fragment("o_fwd", _pick_sql("f"))
fragment("o_rev", _pick_sql("r"))


@query("wn15_pick_primers", "SELECT sample, contig, f.x.p AS fwd_primer, round(f.x.tm,4) AS fwd_tm, f.x.gc AS fwd_gc, CAST(f.x.pos AS INTEGER) AS fwd_pos, r.x.p AS rev_primer, round(r.x.tm,4) AS rev_tm, r.x.gc AS rev_gc, CAST(r.x.pos AS INTEGER) AS rev_pos FROM {o_fwd} f JOIN {o_rev} r USING (sample, contig)")
def wn15(t):
    rows = pr.pick_primers(pr.frame_amplicons(t.v_contig_pairs), ["sample", "contig"])
    return rows.withColumns({c: F.round(c, 4) for c in ("fwd_tm", "rev_tm")})


@query("wn16_design_amplicons", """SELECT sample, contig, host_region, substr(seq, CAST(a + f.x.pos + 1 AS BIGINT), CAST(r.x.pos - f.x.pos AS BIGINT)) AS amplicon_seq, CAST(r.x.pos - f.x.pos AS INTEGER) AS amplicon_len, CAST(at_ - a - f.x.pos AS INTEGER) AS junction_offset, f.x.p AS fwd_primer, round(f.x.tm,4) AS fwd_tm, f.x.gc AS fwd_gc, r.x.p AS rev_primer, round(r.x.tm,4) AS rev_tm, r.x.gc AS rev_gc
    FROM {o_frame} JOIN {o_fwd} f USING (sample, contig) JOIN {o_rev} r USING (sample, contig)""")
def wn16(t):
    rows = pr.design_amplicons(t.v_contig_pairs, ["sample", "contig"])
    return rows.withColumns({c: F.round(c, 4) for c in ("fwd_tm", "rev_tm")})

"""Edits, gene models and custody: AG20-23, AG38, RJ5, RJ6, RJ14-16, RJ24, SC30, DT13, DT14, WN13, WN17-20."""
from __future__ import annotations

from pyspark.sql import functions as F

from sitewright.operators import custody as cu, edits as ed, reference as rf
from sitewright.operators.reads import primary
from sitewright.plans.q_functions import _codons
from sitewright.plans.q_reads import lines
from sitewright.plans.registry import fragment, query
from sitewright.session import checkpoint

_READS = "SELECT * FROM {v_alignments} WHERE (flag & 1796) = 0 AND mapq >= 10 AND ((flag & 1) = 0 OR (flag & 2) <> 0)"
# reads of the fixture have four shapes only, so the oracle places their blocks directly
_SEG = """SELECT sample, chrom, ref_start + 1 AS p, 1 + CASE WHEN starts_with(cigar,'100M') THEN 0 WHEN side = 1 THEN clip ELSE 0 END AS q, CASE WHEN cigar='50M2D50M' THEN 50 WHEN cigar='48M3I49M' THEN 48 ELSE ref_end - ref_start END AS n, seq FROM (
      SELECT *, CASE WHEN regexp_matches(cigar,'^\\d+S') THEN 1 ELSE 0 END AS side, coalesce(TRY_CAST(regexp_extract(cigar,'^(\\d+)S',1) AS INTEGER),0) AS clip FROM {o_preads}) a
    UNION ALL SELECT sample, chrom, ref_start + 53, 51, 50, seq FROM {o_preads} WHERE cigar='50M2D50M' UNION ALL SELECT sample, chrom, ref_start + 49, 52, 49, seq FROM {o_preads} WHERE cigar='48M3I49M'"""
fragment("o_preads", _READS)
fragment("o_pbase", f"""SELECT sample, chrom, p + i AS pos, substr(seq, q + i, 1) AS b FROM ({_SEG}) s, unnest(range(n)) u(i) UNION ALL SELECT sample, chrom, ref_start + 51 + i, 'DEL' FROM {{o_preads}}, unnest(range(2)) u(i) WHERE cigar='50M2D50M'""")
fragment("o_ins", "SELECT sample, chrom, ref_start + 48 AS pos, substr(seq,49,3) AS s FROM {o_preads} WHERE cigar='48M3I49M'")
fragment("o_pileup", """SELECT b.*, coalesce(i.n,0) AS "INS" FROM (SELECT sample, chrom, pos, count(*) FILTER (b='A') AS "A", count(*) FILTER (b='T') AS "T", count(*) FILTER (b='G') AS "G", count(*) FILTER (b='C') AS "C", count(*) FILTER (b='N') AS "N", count(*) FILTER (b='DEL') AS "DEL", count(*) AS dp
    FROM {o_pbase} GROUP BY 1,2,3) b LEFT JOIN (SELECT sample, chrom, pos, count(*) AS n FROM {o_ins} GROUP BY 1,2,3) i USING (sample, chrom, pos)""")


@query("ag20_pileup", "SELECT * FROM {o_pileup}")
def ag20(t):
    return ed.pileup(ed.pileup_events(t.once("v_alignments")))


CUTS = "SELECT chrom, site_pos + loc % 7 AS cut_pos, site_pos + loc % 7 - 30 AS lo, site_pos + loc % 7 + 30 AS hi FROM {v_loci}"


@query("ag20_pileup_regions", f"SELECT p.* FROM {{o_pileup}} p JOIN ({CUTS}) c ON c.chrom = p.chrom AND p.pos BETWEEN lo AND hi")
def ag20b(t):
    return ed.pileup(ed.pileup_events(t.once("v_alignments"), lines(t, CUTS)))


fragment("o_icounts", """SELECT x.sample, x.chrom, x.pos, x.indel_type, CASE WHEN indel_type='deletion' THEN substr(r.seq, CAST(x.pos - r.start_pos + 1 AS BIGINT), 2) ELSE s END AS indel_seq, cnt, dp, substr(r.seq, CAST(x.pos - r.start_pos AS BIGINT), 1) AS ref_base FROM (
    SELECT sample, chrom, pos, 'insertion' AS indel_type, s, count(*) AS cnt FROM {o_ins} GROUP BY ALL UNION ALL SELECT sample, chrom, ref_start + 50, 'deletion', '', count(*) FROM {o_preads} WHERE cigar='50M2D50M' GROUP BY ALL) x
    JOIN {o_pileup} USING (sample, chrom, pos) JOIN {v_ref} r ON r.chrom = x.chrom AND x.pos BETWEEN r.start_pos + 1 AND r.start_pos + length(r.seq)""")


@query("ag20_indel_counts", "SELECT * FROM {o_icounts}")
def ag20c(t):
    return ed.indel_counts(ed.pileup_events(t.once("v_alignments")), t.v_ref)


_CALLS = """SELECT *, length(indel_seq) AS size, CASE WHEN indel_type='deletion' THEN concat(ref_base,indel_seq) ELSE ref_base END AS ref, CASE WHEN indel_type='deletion' THEN ref_base ELSE concat(ref_base,indel_seq) END AS alt, least(freq*dp*10, 999) AS qual,
    CASE WHEN freq >= 0.85 THEN '1/1' WHEN freq >= 0.2 THEN '0/1' ELSE '0/0' END AS gt, CASE WHEN freq >= 0.85 THEN 'homozygous' WHEN freq >= 0.2 THEN 'heterozygous' ELSE 'low-frequency' END AS zygosity FROM (SELECT *, cnt/dp AS freq FROM {src}) f WHERE freq >= 0.1"""
fragment("o_calls", _CALLS.replace("{src}", "(SELECT * EXCLUDE (gt) FROM {v_calls})"))
OUT = "grp, chrom, pos, indel_type, indel_seq, CAST(size AS INTEGER) AS size, ref, alt, qual, freq, gt, zygosity"
COLS = ["grp", "chrom", "pos", "indel_type", "indel_seq", "size", "ref", "alt", "qual", "freq", "gt", "zygosity"]


def calls(t):
    return ed.indel_calls(t.v_calls.drop("gt"))


@query("ag22_indel_calls", f"SELECT {OUT} FROM {{o_calls}}")
def ag22(t):
    return calls(t).select(*COLS)


@query("ag22_pileup_calls", "SELECT sample, chrom, pos, indel_type, indel_seq, freq, zygosity FROM (" + _CALLS.replace("{src}", "{o_icounts}") + ") c")
def ag22b(t):
    return ed.indel_calls(ed.indel_counts(ed.pileup_events(t.once("v_alignments")), t.v_ref)).select("sample", "chrom", "pos", "indel_type", "indel_seq", "freq", "zygosity")


PILETEXT = """SELECT grp, chrom, pos, concat('^+.', indel_type_mark, CAST(length(indel_seq) AS STRING), CASE WHEN pos % 2 = 0 THEN lower(indel_seq) ELSE indel_seq END, 'aC^-,$*', CASE WHEN n > 1 THEN concat(indel_type_mark, CAST(length(indel_seq) AS STRING), indel_seq, '.') ELSE ',,' END) AS pile
    FROM (SELECT *, CASE WHEN indel_type='deletion' THEN '-' ELSE '+' END AS indel_type_mark FROM {v_indels}) v"""


@query("ag21_pileup_indels", "SELECT grp, chrom, pos, indel_type, indel_seq, CAST(sum(CASE WHEN n > 1 THEN 2 ELSE 1 END) AS BIGINT) AS cnt FROM {v_indels} GROUP BY 1,2,3,4,5")
def ag21(t):
    rows = lines(t, PILETEXT).select("grp", "chrom", "pos", F.explode(ed.pileup_indels("pile")).alias("i"))
    return rows.groupBy("grp", "chrom", "pos", F.col("i.indel_type").alias("indel_type"), F.upper("i.indel_seq").alias("indel_seq")).agg(F.count(F.lit(1)).alias("cnt"))


# the oracle counts bases of the wanted positions only, for both samples at once
_TAGS = {"t": "s0", "c": "s1"}
fragment("o_wanted", f"""SELECT c.chrom, cut_pos, cut_pos + i AS pos, substr(r.seq, CAST(cut_pos + i - r.start_pos AS BIGINT), 1) AS b FROM ({CUTS}) c JOIN {{v_ref}} r ON r.chrom=c.chrom AND r.start_pos = cut_pos - 100 - (cut_pos + 200) % 400, unnest(range(-30,31)) u(i)""")
fragment("o_at", "SELECT chrom, pos, " + ", ".join(f"count(*) FILTER (sample='{k}' AND b='{b}') AS {t}_{b.lower()}" for t, k in _TAGS.items() for b in ed.BASES)
         + ", " + ", ".join(f"count(*) FILTER (sample='{k}' AND b <> 'INS') AS {t}_dp" for t, k in _TAGS.items()) + " FROM (SELECT sample, chrom, pos, b FROM {o_pbase} UNION ALL SELECT sample, chrom, pos, 'INS' FROM {o_ins}) e SEMI JOIN (SELECT DISTINCT chrom, pos FROM {o_wanted}) w USING (chrom, pos) GROUP BY 1,2")
_frac = lambda t: ", ".join(f"coalesce({t}_{b.lower()},0)/greatest(coalesce({t}_dp,0),1) AS {t}_{b.lower()}" for b in ed.BASES)


@query("ag23_modification_profile", f"""SELECT chrom, cut_pos, pos, {_frac('t')}, {_frac('c')}, 1.0::DOUBLE - coalesce(CASE b WHEN 'A' THEN t_a WHEN 'C' THEN t_c WHEN 'G' THEN t_g WHEN 'T' THEN t_t ELSE 0 END, 0) / greatest(coalesce(t_dp,0),1) AS modified
    FROM {{o_wanted}} LEFT JOIN {{o_at}} USING (chrom, pos)""")
def ag23(t):
    cuts = lines(t, CUTS)
    # both sides of the comparison read it
    p = checkpoint(ed.pileup(ed.pileup_events(t.once("v_alignments"), cuts)))
    return ed.modification_profile(p.filter("sample='s0'"), p.filter("sample='s1'"), t.v_ref, cuts)


def _groups(t):
    c = calls(t)
    return c.filter("grp = 'treatment'"), c.filter("grp = 'control'")


fragment("o_edits", """SELECT t.*, g.grna_idx, g.site_type, g.mismatches, g.cut_pos, abs(t.pos - g.cut_pos) AS distance_to_cut FROM {o_calls} t JOIN {v_targets} g ON g.chrom=t.chrom AND t.pos BETWEEN greatest(1, g.cut_pos-50) AND g.cut_pos+50
    WHERE grp='treatment' AND NOT EXISTS (SELECT 1 FROM {o_calls} c WHERE c.grp='control' AND c.chrom=t.chrom AND c.pos=t.pos AND c.indel_type=t.indel_type AND c.indel_seq=t.indel_seq)""")


@query("rj14_edits_at_targets", "SELECT chrom, pos, indel_type, indel_seq, grna_idx, site_type, mismatches, distance_to_cut, freq FROM {o_edits}")
def rj14(t):
    tr, ct = _groups(t)
    return ed.edits_at_targets(tr, ct, t.v_targets).select("chrom", "pos", "indel_type", "indel_seq", "grna_idx", "site_type", "mismatches", "distance_to_cut", "freq")


@query("ag38_edit_summary", "SELECT count(*) AS total, count(*) FILTER (site_type='on-target') AS on_target, count(*) FILTER (site_type='off-target') AS off_target FROM {o_edits}")
def ag38(t):
    tr, ct = _groups(t)
    return ed.edit_summary(ed.edits_at_targets(tr, ct, t.v_targets))


fragment("o_specific", """SELECT * FROM {o_calls} t WHERE grp='treatment' AND size >= 2 AND NOT EXISTS (SELECT 1 FROM {o_calls} c WHERE c.grp='control' AND c.size >= 2 AND c.chrom=t.chrom AND c.pos=t.pos AND c.ref=t.ref AND c.alt=t.alt)""")


def specific(t):
    return ed.specific_indels(*_groups(t))


@query("rj15_specific_indels", "SELECT chrom, pos, ref, alt, indel_type FROM {o_specific}")
def rj15(t):
    return specific(t).select("chrom", "pos", "ref", "alt", "indel_type")


JUNC = "SELECT concat('chr',CAST(s_suppkey % 4 + 1 AS STRING)) AS chrom, s_suppkey*31 % 400 AS pos, s_suppkey*7 % 1013 AS line_no FROM {supplier}"


@query("rj16_nearest_junction", f"""SELECT i.chrom, i.pos, i.indel_type, i.indel_seq, coalesce(d,-1) AS distance_to_junction, CASE WHEN d IS NULL THEN '' ELSE concat(i.chrom,':',jpos) END AS nearest_junction FROM {{v_indels}} i LEFT JOIN (
    SELECT q.chrom, q.pos, min(abs(q.pos-j.pos)) AS d, arg_min(j.pos, (abs(q.pos-j.pos), line_no)) AS jpos FROM (SELECT DISTINCT chrom, pos FROM {{v_indels}}) q JOIN ({JUNC}) j ON j.chrom=q.chrom GROUP BY 1,2) n ON n.chrom=i.chrom AND n.pos=i.pos WHERE i.grp='treatment'""")
def rj16(t):
    rows = t.v_indels.filter("grp = 'treatment'")
    return ed.nearest_junction(rows, lines(t, JUNC)).select("chrom", "pos", "indel_type", "indel_seq", "distance_to_junction", "nearest_junction")


# de novo annotation against reference blocks under the call positions
CALLREF = "SELECT concat('chr',CAST(c AS STRING)) AS chrom, CAST(b*50 AS BIGINT) AS start_pos, substr(translate(concat(md5(concat(CAST(c AS STRING),'x',CAST(b AS STRING))),md5(concat(CAST(b AS STRING),'y',CAST(c AS STRING)))),'0123456789abcdef','ACGTGGCCACGTGGCC'),1,50) AS seq FROM (SELECT DISTINCT l_suppkey % 5 + 1 AS c, CAST(floor((l_partkey % 450)/50) AS BIGINT) AS b FROM {lineitem}) d"
fragment("o_callref", CALLREF)
fragment("o_annot", """SELECT *, CASE WHEN substr(w,13,2)='GG' THEN concat(substr(w,12,3),'(+)') WHEN substr(w,3,2)='CC' THEN concat(substr(w,3,3),'(-)') ELSE '' END AS pam_motif, (indel_type='deletion' AND size <= 20) OR (indel_type='insertion' AND size <= 5) AS nhej_signature FROM (
    SELECT s.*, substr(concat(coalesce(a.seq, ''),coalesce(b.seq, '')), CAST(greatest(1,pos-8) - a.start_pos AS BIGINT), CAST(pos + 9 - greatest(1,pos-8) AS BIGINT)) AS w FROM {o_specific} s LEFT JOIN {o_callref} a ON a.chrom=s.chrom AND a.start_pos = (greatest(1,pos-8)-1)//50*50 LEFT JOIN {o_callref} b ON b.chrom=s.chrom AND b.start_pos = (greatest(1,pos-8)-1)//50*50+50) x""")


def annotated(t):
    return ed.annotate_indels(specific(t), lines(t, CALLREF))


@query("dt13_annotate_indels", "SELECT chrom, pos, ref, alt, pam_motif, pam_motif <> '' AS has_pam, nhej_signature, pam_motif <> '' AND nhej_signature AND qual >= 20 AS crispr_candidate FROM {o_annot}")
def dt13(t):
    return annotated(t).select("chrom", "pos", "ref", "alt", "pam_motif", "has_pam", "nhej_signature", "crispr_candidate")


@query("ag38_top_candidates", "SELECT chrom, pos, indel_type, indel_seq, qual FROM {o_annot} WHERE pam_motif <> '' AND nhej_signature AND qual >= 20 ORDER BY qual DESC, chrom, pos, indel_type, indel_seq LIMIT 20")
def ag38b(t):
    return ed.top_candidates(annotated(t)).select("chrom", "pos", "indel_type", "indel_seq", "qual")


@query("wn13_rank_targets", "SELECT grna_idx, chrom, cut_pos, site_type, mismatches FROM {v_targets} ORDER BY mismatches, CASE WHEN site_type='on-target' THEN 0 ELSE 1 END")
def wn13(t):
    return rf.rank_targets(t.v_targets)


# fixed guide texts: the first is cut from a reference block so that exact hits exist
GUIDES = ["ACGTGGCCACGTACGTACGT", "GGCCTTAAGGCCTTAAGGCC", "TACGGTACCATTGACCATGG"]


def _sites_sql(guides: str, max_mm: int) -> str:
    return f"""SELECT chrom, grna_idx, strand, t_start, t_start + 20 AS t_end, mismatches, pam_seq, has_pam, CASE WHEN mismatches=0 AND has_pam THEN 'on-target' WHEN mismatches=0 THEN 'on-target-no-PAM' ELSE 'off-target' END AS site_type, CASE WHEN strand='+' THEN t_start+17 ELSE t_start+3 END AS cut_pos FROM (
    SELECT *, length(pam_seq) = 3 AND CASE WHEN strand='+' THEN substr(pam_seq,2,2)='GG' ELSE substr(pam_seq,1,2)='CC' END AS has_pam FROM (
      SELECT chrom, CAST(grna_idx AS INTEGER) AS grna_idx, strand, start_pos + i AS t_start, CAST(hamming(substr(seq, i+1, 20), pat) AS INTEGER) AS mismatches, CASE WHEN strand='+' THEN substr(seq, i+21, 3) ELSE substr(seq, greatest(i-2,1), i - greatest(i-2,1) + 1) END AS pam_seq
      FROM {{v_ref}}, unnest(range(length(seq)-19)) u(i), (SELECT grna_idx, '+' AS strand, guide AS pat FROM ({guides}) g UNION ALL SELECT grna_idx, '-', reverse(translate(guide,'ACGT','TGCA')) FROM ({guides}) g) p
      WHERE hamming(substr(seq, i+1, 20), pat) <= {max_mm}) h) k"""


FEW_GUIDES = " UNION ALL ".join(f"SELECT {i + 1} AS grna_idx, '{g}' AS guide" for i, g in enumerate(GUIDES))
# a guide per supplier, taken from the reference with up to three letters replaced
MANY_GUIDES = """SELECT CAST(s_suppkey AS INT) AS grna_idx, concat(substr(host, o, 4), CASE s_suppkey % 3 WHEN 0 THEN substr(host, o + 4, 1) ELSE 'T' END, substr(host, o + 5, 8),
    CASE s_suppkey % 4 WHEN 0 THEN substr(host, o + 13, 1) ELSE 'C' END, substr(host, o + 14, 5), CASE s_suppkey % 5 WHEN 0 THEN 'G' ELSE substr(host, o + 19, 1) END) AS guide
    FROM (SELECT s_suppkey, host, CAST(10 + s_suppkey % 90 AS INT) AS o FROM {supplier} JOIN {v_loci} ON loc = s_suppkey * 13 % 997) t"""


@query("rj24_grna_sites", _sites_sql(FEW_GUIDES, 7))
def rj24(t):
    return rf.grna_sites(t.v_ref, t.spark.sql(FEW_GUIDES), max_mm=7)


@query("rj24_guide_table", _sites_sql(MANY_GUIDES, 4))
def rj24_table(t):
    return rf.grna_sites(t.v_ref, lines(t, MANY_GUIDES), max_mm=4)


# ---- gene models ----

REGIONS = "SELECT var_id AS point_id, chrom, pos AS r_start, pos + 40 AS r_end, pos FROM {v_variants}"
_iv = lambda k, c: f"coalesce(string_agg(concat(f.start_pos,'-',f.end_pos), ',' ORDER BY f.start_pos) FILTER (f.ftype='{k}'), '') AS {c}"


@query("rj5_gene_context", f"""SELECT p.point_id, g.id AS gene_id, {_iv('CDS', 'cds')}, {_iv('exon', 'exons')} FROM ({REGIONS}) p JOIN {{v_features}} g ON g.ftype='gene' AND g.chrom=p.chrom AND g.end_pos >= r_start-2000 AND g.start_pos <= r_end+2000
    LEFT JOIN {{v_features}} f ON f.chrom=g.chrom AND f.parent = replace(g.id,'gene','mRNA') AND f.end_pos >= r_start-2000 AND f.start_pos <= r_end+2000 GROUP BY 1,2""")
def rj5(t):
    rows = ed.gene_context(lines(t, REGIONS), t.v_features, 2000)
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat(x["s"].cast("string"), F.lit("-"), x["e"].cast("string"))), ",").alias(c)
    return rows.select("point_id", "gene_id", text("cds"), text("exons"))


_o = "(pos - 1 - l.p*1000)"
fragment("o_vgene", """SELECT v.*, v.pos - 1 - p*1000 AS o, p, p % 2 = 0 AS plus, CAST(p % 3 AS INTEGER) AS ph, CASE WHEN v.pos-1-p*1000 BETWEEN 60 AND 299 OR v.pos-1-p*1000 BETWEEN 500 AND 740 THEN 'CDS' WHEN v.pos-1-p*1000 BETWEEN 0 AND 299 OR v.pos-1-p*1000 BETWEEN 500 AND 899 THEN 'UTR' WHEN v.pos-1-p*1000 BETWEEN 0 AND 899 THEN 'intron' END AS loc
    FROM {v_variants} v LEFT JOIN (SELECT p_partkey AS p, concat('chr',p_partkey % 5 + 1) AS chrom FROM {part}) g ON g.chrom = v.chrom AND v.pos-1-p*1000 BETWEEN 0 AND 899""")


@query("sc30_junction_location", "SELECT var_id AS point_id, coalesce(loc,'intergenic') AS location FROM {o_vgene}")
def sc30(t):
    return ed.junction_location(lines(t, REGIONS), t.v_features, 2000).select("point_id", "location")


@query("rj6_cds_context", """SELECT var_id, CASE WHEN loc IS NOT NULL THEN concat('gene',p) END AS gene_id, loc AS location, CASE WHEN loc='CDS' THEN 1 + p*1000 + CASE WHEN o < 400 THEN 60 ELSE 500 END END AS hit_start FROM {o_vgene}""")
def rj6(t):
    return ed.cds_context(t.v_variants, t.v_features).select("var_id", "gene_id", "location", F.col("hit_cds.s").alias("hit_start"))


def _at(k):
    kk = f"({k}+ph)"
    return f"(CASE WHEN plus THEN CASE WHEN {kk} < 240 THEN 60+{kk} ELSE 260+{kk} END ELSE CASE WHEN {kk} < 241 THEN 740-{kk} ELSE 540-{kk} END END)"


def _aa(c):
    return f"CASE {c} {_codons} ELSE '?' END"


_names = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in ed.AA_NAMES.items())
_name = lambda c: f"CASE {c} {_names} ELSE {c} END"
_RCs = "reverse(translate({c},'ACGT','TGCA'))"
fragment("o_eff", f"""SELECT *, CASE WHEN loc IS NULL THEN 'intergenic' WHEN loc <> 'CDS' THEN loc WHEN idx < 0 THEN 'CDS_boundary' WHEN indel_type <> 'snv' AND size % 3 <> 0 THEN 'frameshift' WHEN indel_type='deletion' THEN 'in-frame_deletion' WHEN indel_type='insertion' THEN 'in-frame_insertion'
    WHEN c0 + 3 > n THEN 'CDS_boundary' WHEN {_aa('cref')} = {_aa('calt')} THEN 'synonymous' WHEN {_aa('calt')} = '*' THEN 'stop_gained' WHEN {_aa('cref')} = '*' THEN 'stop_lost' ELSE 'nonsynonymous' END AS effect FROM (
  SELECT *, CASE WHEN snv_ok THEN concat(substr(cref,1,off), CASE WHEN plus THEN alt ELSE translate(alt,'ACGT','TGCA') END, substr(cref,off+2,3)) END AS calt FROM (
    SELECT *, CAST(idx % 3 AS BIGINT) AS off, CASE WHEN snv_ok THEN CASE WHEN plus THEN concat(substr(seq,{_at('c0')}+1,1),substr(seq,{_at('(c0+1)')}+1,1),substr(seq,{_at('(c0+2)')}+1,1)) ELSE {_RCs.format(c="concat(substr(seq," + _at('c0') + "+1,1),substr(seq," + _at('(c0+1)') + "+1,1),substr(seq," + _at('(c0+2)') + "+1,1))")} END END AS cref,
      CASE WHEN indel_type='deletion' AND size % 3 = 0 AND idx >= 0 AND n > idx+size THEN substr(seq, least({_at('idx')},{_at('least(idx+size+2,n-1)')})+1, greatest({_at('idx')},{_at('least(idx+size+2,n-1)')}) - least({_at('idx')},{_at('least(idx+size+2,n-1)')}) + 1) END AS dseq FROM (
      SELECT *, idx - idx % 3 AS c0, indel_type='snv' AND loc='CDS' AND idx >= 0 AND idx - idx % 3 + 3 <= n AS snv_ok FROM (
        SELECT v.*, r.seq, 481 - ph AS n, CASE WHEN loc='CDS' THEN CASE WHEN plus THEN CASE WHEN o < 400 THEN o-60 ELSE o-260 END ELSE CASE WHEN o >= 400 THEN 740-o ELSE 540-o END END - ph END AS idx FROM {{o_vgene}} v LEFT JOIN {{v_gene_ref}} r ON r.chrom=v.chrom AND r.start_pos = 1 + v.p*1000 ) a) b) c) d""")
_trans = lambda c: f"array_to_string(list_transform(range(0, length({c})-2, 3), lambda i: {_aa('substr(' + c + ', i+1, 3)')}), '')"


@query("dt14_variant_effect", f"""SELECT var_id, chrom, pos, CASE WHEN loc IS NULL THEN '' ELSE concat('gene',p) END AS gene_id, effect, CASE effect WHEN 'in-frame_insertion' THEN concat('ins ',size//3,'aa') WHEN 'in-frame_deletion' THEN CASE WHEN dseq IS NULL THEN concat('del ',size//3,'aa') ELSE concat('del ',size//3,'aa (',{_trans("(CASE WHEN plus THEN dseq ELSE " + _RCs.format(c='dseq') + " END)")},')') END
    WHEN 'synonymous' THEN concat('p.',{_name(_aa('cref'))},c0//3+1,'=') WHEN 'stop_gained' THEN concat('p.',{_name(_aa('cref'))},c0//3+1,'*') WHEN 'stop_lost' THEN concat('p.*',c0//3+1,{_name(_aa('calt'))}) WHEN 'nonsynonymous' THEN concat('p.',{_name(_aa('cref'))},c0//3+1,{_name(_aa('calt'))}) ELSE '' END AS aa_change,
    coalesce(cref,'') AS codon_ref, coalesce(calt,'') AS codon_alt, CASE WHEN effect IN ('intergenic','UTR','intron','CDS_boundary') THEN 0 ELSE idx//3+1 END AS aa_pos, coalesce(loc='CDS' AND (abs(o-60) <= 2 OR abs(o-299) <= 2 OR abs(o-500) <= 2 OR abs(o-740) <= 2), false) AS near_splice FROM {{o_eff}}""")
def dt14(t):
    ref = t.v_gene_ref.withColumn("start_pos", F.col("start_pos") - 1)
    return ed.variant_effect(ed.cds_context(t.v_variants, t.v_features), ref)


# ---- custody ----

CUSTODY = "SELECT log_id % 40 AS log_id, line_no, CASE WHEN line_no % 97 = 0 THEN 'bad' ELSE CAST(ts - make_interval(0,0,0,0,0,CAST(line_no % 50 AS INT)*200,0) AS STRING) END AS ts, step, event, fname, digest FROM {v_custody}"
_TS = "CASE WHEN line_no % 97 = 0 THEN NULL ELSE ts - to_minutes(CAST(line_no % 50 AS INTEGER)*200) END"
fragment("o_log", f"SELECT log_id % 40 AS log_id, line_no, {_TS} AS t, step, event, fname, digest FROM {{v_custody}}")
fragment("o_mono", """SELECT log_id, line_no, CASE WHEN t IS NULL THEN 'unparseable' ELSE 'earlier' END AS error FROM (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY log_id ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {o_log}) x WHERE t IS NULL OR t < prev""")
fragment("o_pairlog", """SELECT log_id, step, unnest(list_reduce(list({'line': line_no, 'd': CASE event WHEN 'pre' THEN 1 ELSE -1 END} ORDER BY line_no), lambda a, x: CASE WHEN x.d = 1 THEN {'o': a.o + 1, 'e': a.e} WHEN a.o = 0 THEN {'o': a.o, 'e': list_append(a.e, x.line)} ELSE {'o': a.o - 1, 'e': a.e} END, {'o': 0::BIGINT, 'e': []::BIGINT[]})) FROM {o_log} WHERE event IN ('pre','post') GROUP BY 1,2""")
fragment("o_pairs_err", "SELECT log_id, step, unnest(e) AS line_no, 'post_without_pre' AS error, 1::BIGINT AS n FROM {o_pairlog} UNION ALL SELECT log_id, step, NULL, 'open_pre', o FROM {o_pairlog} WHERE o > 0")
fragment("o_hash_err", """SELECT log_id, line_no, step, nstep AS next_step, fname, digest AS digest_out, ndigest AS digest_in FROM (SELECT *, lead(event) OVER w AS nevent, lead(step) OVER w AS nstep, lead(fname) OVER w AS nf, lead(digest) OVER w AS ndigest FROM {o_log} WHERE event IN ('pre','post') WINDOW w AS (PARTITION BY log_id ORDER BY line_no)) x
    WHERE event='post' AND nevent='pre' AND nf = fname AND ndigest <> digest""")


def _log(t):
    return lines(t, CUSTODY).withColumn("files", F.create_map("fname", "digest"))


@query("wn17_custody_monotone", "SELECT * FROM {o_mono}")
def wn17(t):
    return cu.custody_monotone(_log(t), tile=128)


@query("wn18_custody_pairs", "SELECT * FROM {o_pairs_err}")
def wn18(t):
    return cu.custody_pairs(_log(t), tile=128)


@query("wn19_custody_hashes", "SELECT * FROM {o_hash_err}")
def wn19(t):
    return cu.custody_hashes(_log(t), tile=128)


@query("wn20_custody_ok", """SELECT log_id, coalesce(n,0) AS errors, coalesce(n,0) = 0 AS clean FROM (SELECT DISTINCT log_id FROM {o_log}) l LEFT JOIN (SELECT log_id, count(*) AS n FROM (SELECT log_id FROM {o_mono} UNION ALL SELECT log_id FROM {o_pairs_err} UNION ALL SELECT log_id FROM {o_hash_err}) u GROUP BY 1) e USING (log_id)""")
def wn20(t):
    return cu.custody_ok(_log(t))

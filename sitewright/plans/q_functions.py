"""Scalar functions (SC*)."""
from __future__ import annotations

from math import log

from pyspark.sql import functions as F

from sitewright import functions as fn
from sitewright.functions import names as nm, sequence as sq
from sitewright.plans.registry import query

HEX = "'0123456789abcdef'"
RC = "reverse(translate({c},'ACGTacgt','TGCAtgca'))"
RC_STRICT = "reverse(translate(regexp_replace(upper({c}),'[^ACGTN]','N','g'),'ACGT','TGCA'))"
MIXED = "concat(lower(substr(seq,1,7)), substr(seq,8,60), 'R-y')"


@query("sc1_revcomp", f"""SELECT sample, qname, CAST(mate AS INTEGER) AS mate, {RC.format(c=MIXED)} AS plain, {RC_STRICT.format(c=MIXED)} AS strict
    FROM {{v_reads}}""")
def sc1(t):
    mixed = F.expr(MIXED)
    return t.once("v_reads").select("sample", "qname", F.col("mate").cast("int").alias("mate"), fn.revcomp(mixed).alias("plain"),
                            fn.revcomp(mixed, strict=True).alias("strict"))


CIGARS = "SELECT qname, mate, ref_start, concat(CASE WHEN mapq % 5 = 0 THEN '3H' ELSE '' END, cigar, CASE WHEN mapq % 4 = 0 THEN '7N11=2X' ELSE '' END, CASE WHEN mapq % 3 = 0 THEN '12S' ELSE '' END) AS cigar, seq FROM {v_alignments}"
REF_LEN = r"CAST(list_sum(list_transform(regexp_extract_all(cigar,'(\d+)[MDN=X]',1), lambda x: CAST(x AS BIGINT))) AS BIGINT)"


def _cigars(t):
    return t.spark.sql(CIGARS, v_alignments=t.once("v_alignments"))


@query("sc2_cigar_ref_len", rf"""SELECT qname, mate, {REF_LEN} AS ref_len, CAST(len(regexp_extract_all(cigar,'\d+[A-Z=]')) AS INTEGER) AS n_ops,
    array_to_string(regexp_extract_all(cigar,'\d+([A-Z=])',1),'') AS ops FROM ({CIGARS}) c""")
def sc2(t):
    ops = fn.cigar_ops("cigar")
    return _cigars(t).select("qname", "mate", fn.ref_len("cigar").alias("ref_len"), F.size(ops).alias("n_ops"),
                             F.array_join(ops["op"], "").alias("ops"))


@query("sc3_ref_end", rf"SELECT qname, mate, ref_start + {REF_LEN} AS ref_end FROM ({CIGARS}) c")
def sc3(t):
    return _cigars(t).select("qname", "mate", fn.ref_end("ref_start", "cigar").alias("ref_end"))


@query("sc4_soft_clips", rf"""SELECT qname, mate, l AS left_len, r AS right_len, substr(seq,1,l) AS left_seq, right(seq,r) AS right_seq FROM (
    SELECT *, coalesce(TRY_CAST(regexp_extract(cigar,'^(\d+)S',1) AS INTEGER),0) AS l,
    coalesce(TRY_CAST(regexp_extract(cigar,'(\d+)S$',1) AS INTEGER),0) AS r FROM ({CIGARS}) c) d""")
def sc4(t):
    return _cigars(t).select(
        "qname", "mate", fn.clip_left_len("cigar").alias("left_len"), fn.clip_right_len("cigar").alias("right_len"),
        fn.left_clip_seq("cigar", "seq").alias("left_seq"), fn.right_clip_seq("cigar", "seq").alias("right_seq"))


@query("sc5_flags", """SELECT qname, mate, (flag & 4) <> 0 AS unmapped, (flag & 8) <> 0 AS mate_unmapped, (flag & 2) <> 0 AS proper, (flag & 1) <> 0 AS paired,
    (flag & 256) <> 0 AS secondary, (flag & 2048) <> 0 AS supplementary FROM {v_alignments}""")
def sc5(t):
    bits = {"unmapped": 4, "mate_unmapped": 8, "proper": 2, "paired": 1, "secondary": 256, "supplementary": 2048}
    return t.once("v_alignments").select("qname", "mate", *[fn.flag_is("flag", b).alias(n) for n, b in bits.items()])


@query("sc6_src_tag", """SELECT p_partkey, CASE WHEN strpos(name,'|src=') > 0 THEN substr(name,1,strpos(name,'|src=')-1) ELSE name END AS accession,
    CASE WHEN strpos(name,'|src=') > 0 THEN substr(name,strpos(name,'|src=')+5) ELSE 'none' END AS src FROM {v_names}""")
def sc6(t):
    tag = fn.parse_src_tag("name", "none")
    return t.v_names.select("p_partkey", tag["accession"].alias("accession"), tag["src_tag"].alias("src"))


@query("sc7_src_tier", """SELECT line_no, CASE WHEN sseqid LIKE '%|src=univec' THEN 1 WHEN sseqid LIKE '%|src=%' THEN 2 ELSE 0 END AS tier FROM {v_hits}""")
def sc7(t):
    return t.v_hits.select("line_no", fn.src_tier(fn.src_tag("sseqid")).alias("tier"))


def _like(words, col="n"):
    return "(" + " OR ".join(f"contains({col},'{w}')" for w in words) + ")"


_SUFFIX = "(n LIKE '%-lb' OR n LIKE '%-rb')"


def _case(rules, otherwise):
    return "CASE " + " ".join(f"WHEN {c} THEN '{v}'" for c, v in rules) + f" ELSE '{otherwise}' END"


STRUCTURE_CASE = _case([
    (_like(nm.PROMOTER), "promoter"), (_like(nm.TERMINATOR), "terminator"), (_like(nm.BORDER), "border"), (_SUFFIX, "border"),
    (_like(nm.INTRON), "intron"), (_like(nm.INSULATOR), "insulator"), (_like(nm.TRANSIT), "transit"), (_like(nm.CODING), "coding"),
    (_like(nm.REGULATORY), "regulatory"), (_like(nm.CONSTRUCT), "construct"), (_like(nm.ELEMENT), "element"),
    (_like(nm.EVENT), "event"), (_like(nm.TAXON), "taxon")], "unknown")
SUMMARY_CASE = _case([
    (_like(nm.PROMOTER), "promoter"), (_like(nm.TERMINATOR), "terminator"), (_like(nm.BORDER), "border"), (_SUFFIX, "border"),
    (_like(nm.CODING), "cds"), (_like(nm.INTRON), "marker"), (_like(nm.CONSTRUCT), "construct-specific"),
    (_like(nm.ELEMENT), "element-specific"), (_like(nm.EVENT), "event-specific"), (_like(nm.VECTOR), "vector"),
    ("NOT contains(n,'|') AND length(n) < 60", "construct-specific")], "unknown")


@query("sc8_element_class", f"SELECT p_partkey, {STRUCTURE_CASE} AS category FROM (SELECT p_partkey, lower(name) AS n FROM {{v_names}}) s")
def sc8(t):
    return t.v_names.select("p_partkey", fn.classify_element("name").alias("category"))


@query("sc9_element_class_summary", f"SELECT p_partkey, {SUMMARY_CASE} AS category FROM (SELECT p_partkey, lower(name) AS n FROM {{v_names}}) s")
def sc9(t):
    return t.v_names.select("p_partkey", fn.classify_element_summary("name").alias("category"))


@query("sc10_header_parts", """SELECT p_partkey, split_part(name,'|',1) AS element_type,
    CASE WHEN contains(name,'|') THEN split_part(name,'|',2) ELSE substr(name,1,25) END AS short_name FROM {v_names}""")
def sc10(t):
    return t.v_names.select("p_partkey", fn.header_part("name", 0).alias("element_type"),
                            fn.header_part("name", 1, 25).alias("short_name"))


@query("sc11_gc", """SELECT sample, qname, CAST(mate AS INTEGER) AS mate, CASE WHEN length(seq) > 0 THEN
    CAST(length(seq) - length(translate(seq,'GC','')) AS DOUBLE) / length(seq) ELSE 0.0::DOUBLE END AS gc FROM {v_reads}""")
def sc11(t):
    return t.once("v_reads").select("sample", "qname", F.col("mate").cast("int").alias("mate"), fn.gc("seq").alias("gc"))


@query("sc12_homopolymer", """SELECT sample, qname, CAST(mate AS INTEGER) AS mate, contains(seq,'AAAA') OR contains(seq,'CCCC') OR contains(seq,'GGGG') OR contains(seq,'TTTT') OR contains(seq,'NNNN') AS has_run
    FROM {v_reads}""")
def sc12(t):
    return t.once("v_reads").select("sample", "qname", F.col("mate").cast("int").alias("mate"), fn.has_run("seq").alias("has_run"))


OLIGO = "substr(seq, 1, CAST(7 + length(seq) % 19 AS INT))"
_pairs = "list_transform(range(1, length(s)), lambda i: substr(s, i, 2))"


def _nn(table, unknown, col="p"):
    whens = " ".join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in table.items())
    return f"CASE {col} {whens} ELSE {unknown}::DOUBLE END"


@query("sc13_melting_temperature", f"""SELECT sample, qname, CAST(mate AS INTEGER) AS mate, CASE WHEN length(s) < 10 THEN 0.0::DOUBLE ELSE round(
    (list_sum(list_transform({_pairs}, lambda p: {_nn(sq.NN_ENTHALPY, -7.5)})) + 0.2) * 1000.0::DOUBLE /
    (list_sum(list_transform({_pairs}, lambda p: {_nn(sq.NN_ENTROPY, -21.0)})) - 5.7 + 0.368::DOUBLE * (length(s)-1) * ln(0.05::DOUBLE) + 1.987::DOUBLE * ln(250e-9::DOUBLE/4)) - 273.15, 4) END AS tm
    FROM (SELECT sample, qname, mate, {OLIGO} AS s FROM {{v_reads}}) o""")
def sc13(t):
    return t.once("v_reads").select("sample", "qname", F.col("mate").cast("int").alias("mate"), F.round(fn.tm_nn(F.expr(OLIGO)), 4).alias("tm"))


DEGENERATE = "translate(md5(p_name), '0123456789abcdef', 'ACGTRYSWKMBDHVNA')"
_iupac = DEGENERATE
for _k, _v in sq.IUPAC.items():
    _iupac = f"replace({_iupac},'{_k}','<{_k.lower()}>')"
for _k, _v in sq.IUPAC.items():
    _iupac = f"replace({_iupac},'<{_k.lower()}>','[{_v}]')"


@query("sc14_iupac_regex", f"SELECT p_partkey, {_iupac} AS pattern FROM {{part}}")
def sc14(t):
    return t.part.select("p_partkey", fn.iupac_regex(F.expr(DEGENERATE)).alias("pattern"))


@query("sc15_clean_sequence", "SELECT doc_id, upper(regexp_replace(text,'[^A-Za-z]','','g')) AS seq FROM {documents}")
def sc15(t):
    return t.documents.select("doc_id", fn.clean_seq("text").alias("seq"))




def _token():
    return F.concat(F.lit(" "), F.col("p_name"), F.lit("|"), F.col("p_type"), F.lit("/"), F.col("p_brand"), F.lit("\\"),
                    F.lit("\"x'"), F.repeat(F.lit(" y"), F.col("p_size").cast("int")))


_TOK = r"""regexp_replace(trim(replace(replace(replace(replace(replace(concat(' ', p_name, '|', p_type, '/', p_brand, '\', '"x''', repeat(' y', p_size)),'|','_'),'/','_'),'\','_'),'''',''),'"','')),'\s+','_','g')"""


@query("sc16_safe_token", f"SELECT p_partkey, substr({_TOK},1,80) AS capped, {_TOK} AS uncapped FROM {{part}}")
def sc16(t):
    return t.part.select("p_partkey", fn.safe_token(_token()).alias("capped"), fn.safe_token(_token(), None).alias("uncapped"))


@query("sc17_element_header", """SELECT p_partkey, concat_ws('|', p_type, p_brand, 'org', concat('ACC', p_partkey % 30),
    substr(replace(replace(concat(p_name,'; ',repeat('ab ',p_size)),' ','_'),';',''),1,80), 'canonical_v1') AS header FROM {part}""")
def sc17(t):
    rule = F.concat(F.col("p_name"), F.lit("; "), F.repeat(F.lit("ab "), F.col("p_size").cast("int")))
    return t.part.select("p_partkey", fn.element_header(
        "p_type", "p_brand", F.lit("org"), F.concat(F.lit("ACC"), F.col("p_partkey") % 30), rule).alias("header"))


GAPPED = "concat(substr(seq,1,20), repeat('N', CAST(l % 25 AS INT)), substr(seq,21,15), repeat('n', CAST(l % 14 AS INT)), substr(seq,36,30), repeat('N', CAST(l % 3 * 7 AS INT)))"
GAPPED_ROWS = f"SELECT sample, qname, CAST(mate AS INT) AS mate, {GAPPED} AS seq FROM (SELECT *, length(seq) AS l FROM {{v_reads}}) r"


def _gapped(t):
    return t.spark.sql(GAPPED_ROWS, v_reads=t.once("v_reads"))


@query("sc18_n_gaps", f"""SELECT sample, qname, mate, CAST(e - n AS INTEGER) AS gap_start, CAST(e AS INTEGER) AS gap_end FROM (
    SELECT sample, qname, mate, n, sum(l + n) OVER (PARTITION BY sample, qname, mate ORDER BY i) AS e FROM (
      SELECT sample, qname, mate, unnest(range(1, len(runs)+1)) AS i, length(unnest(leads)) AS l, length(unnest(runs)) AS n FROM (
        SELECT sample, qname, mate, regexp_extract_all(upper(seq),'(.*?)(N{{10,}})',1) AS leads,
        regexp_extract_all(upper(seq),'(.*?)(N{{10,}})',2) AS runs FROM ({GAPPED_ROWS}) g) a) b) c""".replace("{{10,}}", "{10,}"))
def sc18(t):
    return _gapped(t).select("sample", "qname", "mate", F.explode(fn.n_gaps("seq")).alias("g")).select(
        "sample", "qname", "mate", F.col("g.start").alias("gap_start"), F.col("g.end").alias("gap_end"))


@query("sc19_effective_length", f"SELECT sample, qname, mate, CAST(length(replace(upper(seq),'N','')) AS INTEGER) AS eff_len FROM ({GAPPED_ROWS}) g")
def sc19(t):
    return _gapped(t).select("sample", "qname", "mate", fn.eff_len("seq").alias("eff_len"))


VERSIONED = "concat(p_brand, CASE WHEN p_partkey % 3 = 0 THEN '.1' WHEN p_partkey % 3 = 1 THEN '.x2' ELSE '' END)"


@query("sc20_norm_chrom", rf"SELECT p_partkey, regexp_replace({VERSIONED}, '\.\d+$', '') AS chrom FROM {{part}}")
def sc20(t):
    return t.part.select("p_partkey", fn.norm_chrom(F.expr(VERSIONED)).alias("chrom"))


_codons = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sq.codon_table().items())


@query("sc21_codons", f"""SELECT sample, qname, CAST(mate AS INTEGER) AS mate, CASE substr(seq,1,3) {_codons} ELSE '?' END AS aa1,
    CASE substr(seq,28,3) {_codons} ELSE '?' END AS aa2 FROM {{v_reads}}""")
def sc21(t):
    return t.once("v_reads").select("sample", "qname", F.col("mate").cast("int").alias("mate"), fn.translate_codon(F.substring("seq", 1, 3)).alias("aa1"),
                            fn.translate_codon(F.substring("seq", 28, 3)).alias("aa2"))


KEY = ["grp", "chrom", "pos", "indel_type", "indel_seq"]
_k = ", ".join(KEY)


@query("sc22_freq_zygosity", f"""SELECT {_k}, CASE WHEN cnt / dp >= 0.85 THEN 'homozygous' WHEN cnt / dp >= 0.2 THEN 'heterozygous' ELSE 'low-frequency' END AS zygosity,
    CASE WHEN cnt / dp >= 0.85 THEN '1/1' WHEN cnt / dp >= 0.2 THEN '0/1' ELSE '0/0' END AS genotype FROM {{v_calls}}""")
def sc22(t):
    f = F.col("cnt") / F.col("dp")
    return t.v_calls.select(*KEY, fn.freq_zygosity(f).alias("zygosity"), fn.freq_gt(f).alias("genotype"))


@query("sc23_gt_zygosity", f"""SELECT {_k}, CASE gt WHEN '1/1' THEN 'homozygous' WHEN '0/1' THEN 'heterozygous' WHEN '1|0' THEN 'heterozygous'
    WHEN '1/2' THEN 'biallelic' WHEN '0/0' THEN 'heterozygous' WHEN '2|2' THEN 'homozygous' ELSE 'unknown' END AS zygosity FROM {{v_calls}}""")
def sc23(t):
    return t.v_calls.select(*KEY, fn.gt_zygosity("gt").alias("zygosity"))


@query("sc24_nhej", f"""SELECT {_k}, (indel_type='deletion' AND length(indel_seq) BETWEEN 1 AND 20) OR (indel_type='insertion' AND length(indel_seq) BETWEEN 1 AND 5) AS nhej
    FROM {{v_calls}}""")
def sc24(t):
    return t.v_calls.select(*KEY, fn.nhej("indel_type", F.length("indel_seq")).alias("nhej"))


GUIDES = """SELECT sample, qname, CAST(mate AS INT) AS mate, CASE WHEN length(seq) % 2 = 0 THEN '+' ELSE '-' END AS strand, substr(seq,5,CASE WHEN length(seq) % 11 = 0 THEN 2 ELSE 3 END) AS pam,
    CAST(length(seq) % 3 AS INT) AS mm, length(seq)*100 AS t_start, length(seq)*100+20 AS t_end FROM {v_reads}"""


@query("sc25_pam_and_type", f"""SELECT sample, qname, mate, has_pam, CASE WHEN mm=0 AND has_pam THEN 'on-target' WHEN mm=0 THEN 'on-target-no-PAM' ELSE 'off-target' END AS site_type,
    CAST(CASE WHEN strand='+' THEN t_end-3 ELSE t_start+3 END AS INTEGER) AS cut_pos FROM (SELECT *, length(pam)=3 AND ((strand='+' AND substr(pam,2,2)='GG') OR (strand='-' AND substr(pam,1,2)='CC')) AS has_pam FROM ({GUIDES}) g) h""")
def sc25(t):
    out = fn.pam_and_type("strand", "pam", "mm", "t_start", "t_end")
    return t.spark.sql(GUIDES, v_reads=t.once("v_reads")).select("sample", "qname", "mate", out.alias("o")).select("sample", "qname", "mate", "o.*")


@query("sc26_pam_motif", """SELECT sample, qname, CAST(mate AS INTEGER) AS mate, CASE WHEN substr(w,13,2)='GG' THEN concat(substr(w,12,3),'(+)') WHEN substr(w,3,2)='CC' THEN concat(substr(w,3,3),'(-)') ELSE '' END AS motif
    FROM (SELECT *, substr(seq,9,17) AS w FROM {v_reads}) r""")
def sc26(t):
    return t.once("v_reads").select("sample", "qname", F.col("mate").cast("int").alias("mate"), fn.pam_motif(F.substring("seq", 9, 17)).alias("motif"))


SCOPED = """SELECT p_partkey, CASE CAST(p_partkey % 9 AS INT) WHEN 0 THEN 'Event test' WHEN 1 THEN 'construct' WHEN 2 THEN 'Element x' WHEN 3 THEN 'species' WHEN 4 THEN 'taxon' WHEN 5 THEN 'plant' ELSE p_type END AS mtype,
    concat('QL', CASE CAST(p_size % 7 AS INT) WHEN 0 THEN '-EVE-' WHEN 1 THEN '-CON-' WHEN 2 THEN '-ELE-' WHEN 3 THEN '-TAX-' WHEN 4 THEN '-PLN-' WHEN 5 THEN '-BAC-' ELSE '-ZZZ-' END, CAST(p_partkey AS STRING)) AS code FROM {part}"""
_scope = "CASE " + " ".join(f"WHEN contains(lower(mtype),'{w}') THEN '{s}'" for w, s in nm.SCOPE_WORDS) + " " + " ".join(
    f"WHEN contains(code,'{w}') THEN '{s}'" for w, s in nm.SCOPE_INFIXES) + " ELSE '' END"


@query("sc28_target_scope", f"SELECT p_partkey, {_scope} AS scope FROM ({SCOPED}) s")
def sc28(t):
    return t.spark.sql(SCOPED, part=t.part).select("p_partkey", fn.target_scope("mtype", "code").alias("scope"))


@query("sc29_is_vector", f"SELECT doc_id, {_like(nm.VECTOR_TITLES, 'lower(text)')} OR n_chars > 8000 AS is_vector FROM {{documents}}")
def sc29(t):
    return t.documents.select("doc_id", fn.is_vector("text", "n_chars").alias("is_vector"))

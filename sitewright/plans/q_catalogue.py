"""Catalogue curation: CU1-10, RJ18, RJ19, AG37."""
from __future__ import annotations

from pyspark.sql import functions as F

from sitewright.operators import catalogue as ct
from sitewright.plans.q_reads import lines, tabbed
from sitewright.plans.registry import fragment, query
from sitewright.functions.sequence import IUPAC


def _el(t):
    return t.v_elements.select("header", "seq", "ord")


PARTS = {"payload_cds.fa": ("ord % 3 = 0", "payload"), "gmo_combined_db.fa": ("ord % 3 = 1", "element_db"), "crl_amplicons.fa": ("ord % 3 = 2", "crl")}


@query("cu1_tag_sources", " UNION ALL ".join(f"SELECT concat(header,'|src={tag}') AS header, seq, ord FROM {{v_elements}} WHERE {cond}" for cond, tag in PARTS.values()))
def cu1(t):
    return ct.tag_sources({name: _el(t).filter(cond) for name, (cond, _) in PARTS.items()})


# three catalogues over shifted sequence classes, so exact repeats and shared methods occur
def _cat(cond, keep, expr="seq"):
    return f"SELECT concat(split_part(header,'|',1),'|M',CAST(ord % {keep} AS STRING),'|x') AS header, {expr} AS seq, ord FROM {{v_elements}} WHERE {cond}"


CUR, FULL, AMP = _cat("ord % 150 < 30", 97), _cat("ord % 150 BETWEEN 20 AND 80", 61, "substr(seq,1,CASE WHEN ord % 2 = 0 THEN 64 ELSE 50 END)"), _cat("ord % 150 > 60", 131, "substr(seq,1,CASE WHEN ord % 4 = 0 THEN 64 ELSE 50 END)")
fragment("o_cur", CUR)
fragment("o_full", f"SELECT * FROM ({FULL}) f WHERE seq NOT IN (SELECT seq FROM {{o_cur}}) QUALIFY row_number() OVER (PARTITION BY seq ORDER BY ord) = 1")
fragment("o_amp", f"SELECT * FROM ({AMP}) a WHERE seq NOT IN (SELECT seq FROM {{o_cur}}) AND seq NOT IN (SELECT seq FROM {{o_full}}) AND split_part(header,'|',2) NOT IN (SELECT split_part(header,'|',2) FROM {{o_full}}) QUALIFY row_number() OVER (PARTITION BY seq ORDER BY ord) = 1")
fragment("o_merged", "SELECT *, 'curated_element' AS source FROM {o_cur} UNION ALL SELECT *, 'euginius_fullseq' FROM {o_full} UNION ALL SELECT *, 'euginius_amplicon' FROM {o_amp}")


def _merged(t):
    return ct.merge_catalogue(lines(t, CUR), lines(t, FULL), lines(t, AMP))


@query("cu2_merge_catalogue", "SELECT header, seq, ord, source FROM {o_merged}")
def cu2(t):
    return _merged(t)


@query("cu3_catalogue_table", "SELECT split_part(header,'|',2) AS header_id, source, CAST(length(seq) AS INTEGER) AS length_bp, split_part(header,'|',1) AS sequence_type FROM {o_merged}")
def cu3(t):
    return ct.catalogue_table(_merged(t))


@query("cu3_catalogue_counts", "SELECT source, count(*) AS n, CAST(sum(length(seq)) AS BIGINT) AS total_bp FROM {o_merged} GROUP BY 1")
def cu3b(t):
    return ct.catalogue_counts(_merged(t))


@query("cu4_cluster_sequences")
def cu4(t):
    docs = t.documents.select(F.col("doc_id").alias("id"), F.col("text").alias("seq"))
    return ct.cluster_sequences(docs)


CRL = "SELECT concat_ws(chr(9), concat('QT-',CAST(p_partkey AS STRING)), 'taxon-specific', concat(p_name,' x  y'), CASE CAST(p_partkey % 4 AS INT) WHEN 0 THEN 'none' WHEN 1 THEN '' ELSE 'AB1' END, CAST(p_size AS STRING), CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 'ACGTAC' END) AS value FROM {part}"


@query("cu5_crl_records", r"SELECT concat('taxon-specific|QT-',p_partkey,'|',regexp_replace(concat(p_name,' x  y'),'\s+','_','g'),'|',CASE WHEN p_partkey % 4 < 2 THEN 'CRL-GMOMETHODS' ELSE 'AB1' END,'|amplicon_',p_size,'bp|crl_v1') AS header, 'ACGTAC' AS seq FROM {part} WHERE p_partkey % 7 <> 0")
def cu5(t):
    return ct.crl_records(lines(t, CRL))


MASTER = "SELECT p_brand AS element_class, concat('H',CAST(p_partkey AS STRING)) AS header_id, CASE WHEN p_partkey % 3 = 0 THEN 'MANUAL' ELSE 'ACC' END AS accession FROM {part}"
fragment("o_build", f"""SELECT m.*, CAST(CASE WHEN accession='MANUAL' THEN CASE WHEN ord % 2 = 0 THEN 64 ELSE 0 END ELSE CASE WHEN ord % 5 <> 0 THEN 64 ELSE 0 END END AS INTEGER) AS seq_length, CASE WHEN accession='MANUAL' THEN CASE WHEN ord % 2 = 0 THEN 'OK_MANUAL' ELSE 'MISSING_MANUAL' END ELSE CASE WHEN ord % 5 <> 0 THEN 'OK_NCBI' ELSE 'FAILED_NCBI' END END AS status
    FROM ({MASTER}) m JOIN {{v_elements}} e ON m.header_id = concat('H', e.ord)""")


def _build(t):
    rows = t.v_elements.withColumn("header_id", F.concat(F.lit("H"), "ord"))
    return ct.build_status(lines(t, MASTER), rows.filter("ord % 2 = 0").select("header_id", "seq"), rows.filter("ord % 5 <> 0").select("header_id", "seq"))


@query("cu6_build_status", "SELECT element_class, header_id, accession, seq_length, status FROM {o_build}")
def cu6(t):
    return _build(t)


@query("cu6_build_totals", "SELECT count(*) AS total, count(*) FILTER (starts_with(status,'OK')) AS ok, count(*) FILTER (regexp_matches(status,'FAILED|MISSING')) AS failed, CAST(sum(seq_length) AS BIGINT) AS total_bp FROM {o_build}")
def cu6b(t):
    return ct.build_totals(_build(t))


METHODS = "SELECT ord AS method_id, CASE CAST(ord % 4 AS INT) WHEN 0 THEN NULL WHEN 1 THEN substr(seq,1,30) WHEN 2 THEN concat(substr(seq,1,30),'N') ELSE substr(seq,1,20) END AS amplicon_seq, substr(seq,1,CASE WHEN ord % 3 = 0 THEN 10 ELSE 18 END) AS forward_seq FROM {v_elements}"


@query("cu7_amplicon_status", f"SELECT method_id, CASE WHEN method_id % 4 = 1 THEN 'OK_CLEAN' WHEN method_id % 3 <> 0 THEN 'NEEDS_MATCH' ELSE 'SKIPPED' END AS status, CAST(CASE WHEN method_id % 4 = 1 THEN 30 ELSE 0 END AS INTEGER) AS actual_length FROM ({METHODS}) m")
def cu7(t):
    return ct.amplicon_status(lines(t, METHODS)).select("method_id", "status", "actual_length")


OLD = "SELECT concat('M',CAST(p_partkey AS STRING)) AS method_code, 'event' AS target_scope, p_name AS target_name, CAST(p_size AS STRING) AS amplicon_size, 0 AS actual_length, '' AS source, 'SKIPPED' AS status, 'EU' AS accession FROM {part} WHERE p_partkey % 3 <> 0"
NEW = "SELECT concat('M',CAST(p_partkey AS STRING)) AS method_code, 'taxon' AS target_scope, p_brand AS target_name, '7' AS amplicon_size, repeat('A',CAST(p_size AS INT)) AS amplicon, concat('src',CAST(p_size AS STRING)) AS source_id FROM {part} WHERE p_partkey % 5 = 0"


@query("cu8_upsert_methods", f"""SELECT coalesce(o.method_code,n.method_code) AS method_code, CASE WHEN o.method_code IS NULL THEN n.target_scope ELSE o.target_scope END AS target_scope, CASE WHEN o.method_code IS NULL THEN n.target_name ELSE o.target_name END AS target_name, CASE WHEN o.method_code IS NULL THEN n.amplicon_size ELSE o.amplicon_size END AS amplicon_size,
    CAST(CASE WHEN n.method_code IS NOT NULL THEN length(amplicon) ELSE actual_length END AS INTEGER) AS actual_length, CASE WHEN n.method_code IS NOT NULL THEN concat('local_match:',source_id) ELSE source END AS source, CASE WHEN n.method_code IS NOT NULL THEN 'OK_LOCAL' ELSE status END AS status, CASE WHEN o.method_code IS NULL THEN source_id ELSE accession END AS accession FROM ({OLD}) o FULL JOIN ({NEW}) n ON o.method_code = n.method_code""")
def cu8(t):
    return ct.upsert_methods(lines(t, OLD), lines(t, NEW))


FULLROWS = "SELECT concat('A',CAST(ord % 40 AS STRING)) AS accession, concat('sc',CAST(ord % 3 AS STRING)) AS scope, concat('m/',CAST(ord AS STRING)) AS method_code, concat('tg ',CAST(priority AS STRING)) AS target, CASE WHEN ord % 4 = 0 THEN '' ELSE substr(seq,1,CAST(20 + priority % 40 AS INT)) END AS full_seq, CASE CAST(ord % 5 AS INT) WHEN 0 THEN 'local_fullseq' WHEN 1 THEN 'NO_HIT' WHEN 2 THEN 'SKIP_VECTOR' ELSE 'ncbi_blast_fullseq' END AS source_type, ord FROM {v_elements}"


@query("cu9_dedupe_fullseq", f"SELECT accession, scope, ord, concat(scope,'|',replace(method_code,'/','_'),'|',replace(target,' ','_'),'|',accession,'|fullseq_',length(full_seq),'bp|euginius_v1') AS header FROM ({FULLROWS}) f WHERE full_seq <> '' QUALIFY row_number() OVER (PARTITION BY accession, scope ORDER BY ord) = 1")
def cu9(t):
    return ct.dedupe_fullseq(lines(t, FULLROWS)).select("accession", "scope", "ord", "header")


@query("cu9_source_types", f"SELECT source_type, count(*) AS n FROM ({FULLROWS}) f GROUP BY 1")
def cu9b(t):
    return ct.source_type_counts(lines(t, FULLROWS))


def _block(col, start, ends):
    rest = f"substr({col}, strpos({col},'{start}') + {len(start)})"
    stop = "least(" + ",".join(f"CASE WHEN strpos({rest},'{e}') = 0 THEN NULL ELSE strpos({rest},'{e}') END" for e in ends) + ")" if len(ends) > 1 else f"nullif(strpos({rest},'{ends[0]}'),0)"
    body = f"(CASE WHEN {stop} IS NULL THEN {rest} ELSE substr({rest}, 1, {stop}-1) END)"
    clean = rf"regexp_replace(regexp_replace(regexp_replace(replace(replace({body},chr(160),' '),chr(13),''),'[ \t\f\v]+',' ','g'),'\n\s*\n+',chr(10),'g'),'^\s+|\s+$','','g')"
    return f"(CASE WHEN strpos({col},'{start}') > 0 THEN {clean} ELSE '' END)"


SPEC = {"title": [("<title>", ["</title>", "</head>"])], "heading": [("<h2>", ["</h2>"]), ("<h1>", ["</h1>", "<p>"])], "ad": [('class="ad">', ["</div>"])]}


@query("cu10_page_fields", "SELECT page_id, " + ", ".join("coalesce(" + ",".join(f"nullif({_block('html', s, e)},'')" for s, e in o) + f",'') AS {f}" for f, o in SPEC.items()) + " FROM {pages}")
def cu10(t):
    return ct.extract_fields(t.pages, "html", SPEC).select("page_id", *SPEC)


METHODPAGE = """SELECT p_partkey, concat('QL-',CASE CAST(p_partkey % 3 AS INT) WHEN 0 THEN 'EVE' WHEN 1 THEN 'CON' ELSE 'ELE' END,'-',CAST(p_partkey AS STRING)) AS method_code, concat('<b>Name:</b> ',p_name,'<br>Description: ',p_type,CASE WHEN p_partkey % 2 = 0 THEN ' Type: Plant test' ELSE '' END,' Target DNA element: ',p_brand,' Oligonucleotides: Forward Primer<p>Name: f',CAST(p_size AS STRING),' Sequence: acg t',substr('ACGTACGT',1,CAST(p_size % 8 AS INT)),'</p> Reverse Primer Name: r Sequence: GG-TT Amplicon: Size: ',CAST(p_size AS STRING),' bp Sequence: ACGN Documents') AS html FROM {part}"""


@query("cu10_method_records", """SELECT p_partkey, p_name AS method_name, p_type AS description, CASE WHEN p_partkey % 2 = 0 THEN 'Plant test' ELSE '' END AS method_type, p_brand AS target_name, CASE WHEN p_partkey % 2 = 0 THEN 'plant-specific' ELSE CASE p_partkey % 3 WHEN 0 THEN 'event-specific' WHEN 1 THEN 'construct-specific' ELSE 'element-specific' END END AS target_scope,
    concat('f',p_size) AS forward_primer_name, concat('ACGT',substr('ACGTACGT',1,p_size % 8)) AS forward_primer_seq, 'GGTT' AS reverse_primer_seq, CAST(p_size AS VARCHAR) AS amplicon_size, 'ACGN' AS amplicon_seq, '' AS notes FROM {part}""")
def cu10b(t):
    pages = lines(t, METHODPAGE).withColumn("text", ct.page_text("html"))
    return ct.method_records(pages).select("p_partkey", "method_name", "description", "method_type", "target_name", "target_scope", "forward_primer_name", "forward_primer_seq",
                                           "reverse_primer_seq", "amplicon_size", "amplicon_seq", "notes")


@query("ag37_manifest", """SELECT CAST(sum(n) AS BIGINT) AS records, md5(string_agg(concat(b,':',n,':',s), ',' ORDER BY concat(b,':',n,':',s))) AS digest FROM (SELECT substr(h,1,3) AS b, count(*) AS n, sum(CAST(concat('0x',substr(h,4,13)) AS BIGINT)) AS s FROM (
    SELECT md5(concat(header,chr(10),seq)) AS h FROM {v_elements}) x GROUP BY 1) y""")
def ag37(t):
    return ct.manifest(t.v_elements)


# ---- containment ----

AMPS = "SELECT ord AS amplicon_id, CASE CAST(ord % 4 AS INT) WHEN 0 THEN substr(seq,10,30) WHEN 1 THEN reverse(translate(substr(seq,5,12),'ACGT','TGCA')) WHEN 2 THEN substr(seq,3,8) ELSE concat('GATTACA',substr(seq,1,20)) END AS amplicon FROM {v_elements}"


@query("rj18_contained_in", f"SELECT amplicon_id, ord, header FROM (SELECT amplicon_id, min(ord) AS ord FROM (SELECT DISTINCT amplicon_id, amplicon FROM ({AMPS}) a) a JOIN (SELECT seq, min(ord) AS ord FROM {{v_elements}} GROUP BY 1) e ON contains(seq, amplicon) OR contains(seq, reverse(translate(amplicon,'ACGT','TGCA'))) GROUP BY 1) x JOIN {{v_elements}} USING (ord)")
def rj18(t):
    return ct.contained_in(lines(t, AMPS), _el(t))


PRIMERS = "SELECT ord AS method_code, CASE CAST(ord % 4 AS INT) WHEN 0 THEN 0 WHEN 1 THEN 46 WHEN 2 THEN 200 ELSE 50 END AS amp_size, concat(CASE WHEN ord % 3 = 0 THEN 'N' WHEN ord % 3 = 1 THEN 'R' ELSE '' END, substr(seq,6,6), CASE WHEN ord % 2 = 0 THEN 'W' ELSE substr(seq,12,1) END, substr(seq,13,3)) AS forward_seq, CASE WHEN ord % 5 = 0 THEN substr(seq,41,10) ELSE reverse(translate(concat(substr(seq,41,5),CASE WHEN ord % 2 = 0 THEN 'Y' ELSE substr(seq,46,1) END,substr(seq,47,4)),'ACGTY','TGCAR')) END AS reverse_seq FROM {v_elements}"


def _rx(c):
    out = c
    for k in IUPAC:
        out = f"replace({out},'{k}','<{k.lower()}>')"
    for k, v in IUPAC.items():
        out = f"replace({out},'<{k.lower()}>','[{v}]')"
    return out


_pos = lambda pat: f"CASE WHEN regexp_matches(seq,{pat}) THEN length(regexp_extract(seq, concat('^(.*?)',{pat}), 1)) ELSE -1 END"


@query("rj19_insilico_pcr", f"""SELECT method_code, amplicon, source_id FROM (SELECT method_code, substr(seq, pf+1, stop + length(reverse_seq) - pf) AS amplicon, header AS source_id, ord, amp_size FROM (SELECT *, CASE WHEN pr >= 0 THEN pr ELSE pb END AS stop FROM (
      SELECT *, {_pos('f')} AS pf, {_pos('rc')} AS pr, {_pos('rv')} AS pb FROM (SELECT method_code, amp_size, reverse_seq, {_rx('forward_seq')} AS f, {_rx('reverse_seq')} AS rv, {_rx("reverse(translate(reverse_seq,'ACGTRYKMBVDHSWN','TGCAYRMKVBHDSWN'))")} AS rc FROM ({PRIMERS}) p) p,
      (SELECT seq, arg_min(header, ord) AS header, min(ord) AS ord FROM {{v_elements}} GROUP BY 1) e) x WHERE pf >= 0) y WHERE stop > pf AND (amp_size = 0 OR abs(stop + length(reverse_seq) - pf - amp_size) < amp_size * 0.3) QUALIFY row_number() OVER (PARTITION BY method_code ORDER BY ord) = 1) z""")
def rj19(t):
    return ct.insilico_pcr(lines(t, PRIMERS), _el(t))

"""Sources and sinks (IO*), row filters (FL*), read-pair logic (RJ1-3, RJ7, DT15, IT1)."""
from __future__ import annotations

from pyspark.sql import functions as F

from sitewright import sources as io
from sitewright.operators import catalogue_filters as cf, reads as rd
from sitewright.plans.registry import fragment, query
from sitewright.sources.readers import paf_ratios, report_elements

TAB = "chr(9)"


def lines(t, sql, **more):
    from sitewright.plans.views import references
    return t.spark.sql(sql, **{r: getattr(t, r) for r in references(sql)}, **more)


def lines_once(t, sql):
    """Rows of ``sql`` over views that are not written first."""
    from sitewright.plans.views import references
    return t.spark.sql(sql, **{r: t.once(r) for r in references(sql)})


def tabbed(*cols):
    return f"concat_ws({TAB}, {', '.join(cols)})"


SAM = "SELECT " + tabbed("qname", "CAST(flag AS STRING)", "chrom", "CAST(ref_start+1 AS STRING)", "CAST(mapq AS STRING)", "cigar", "rnext",
                         "CAST(pnext AS STRING)", "'0'", "seq", "'*'", "concat('NM:i:',CAST(mapq % 5 AS STRING))",
                         "CASE WHEN has_sa THEN 'SA:Z:chr1,5,+,20M,3,0;' END") + " AS value, mate FROM {v_alignments}"


@query("io1_sam", """SELECT mate, qname, flag, chrom, CAST(ref_start + 1 AS BIGINT) AS pos, mapq, cigar, rnext, CAST(pnext AS BIGINT) AS pnext, seq,
    CAST(mapq % 5 AS VARCHAR) AS nm, CASE WHEN has_sa THEN 'chr1,5,+,20M,3,0;' END AS sa FROM {v_alignments}""")
def io1(t):
    sam = io.parse_sam(lines(t, SAM))
    return sam.select("mate", "qname", "flag", "chrom", "pos", "mapq", "cigar", "rnext", "pnext", "seq",
                      F.col("tags")["NM"].alias("nm"), F.col("tags")["SA"].alias("sa"))


PAF = "SELECT " + tabbed("qname", "'1000'", "CAST(qstart AS STRING)", "CAST(qend AS STRING)", "strand", "tname", "'5000'", "CAST(tstart AS STRING)",
                         "CAST(tend AS STRING)", "CAST(matches AS STRING)", "CASE WHEN line_no % 40 = 3 THEN '0' ELSE '400' END", "CAST(mapq AS STRING)",
                         "concat('tp:A:',tp)", "'cm:i:3'") + " AS value, line_no FROM {v_paf} UNION ALL SELECT concat('#',qname) AS value, 0-line_no AS line_no FROM {v_paf}"


@query("io2_paf", """SELECT line_no, qname, tname, strand, CASE WHEN line_no % 40 = 3 THEN 0.0::DOUBLE ELSE matches / 400.0::DOUBLE END AS identity, (qend - qstart) / 1000.0::DOUBLE AS aligned_frac
    FROM {v_paf}""")
def io2(t):
    return io.parse_paf(lines(t, PAF)).select("line_no", "qname", "tname", "strand", "identity", "aligned_frac")


@query("io3_paf_primary", "SELECT line_no, qname, tname FROM {v_paf} WHERE tp = 'P'")
def io3(t):
    return io.paf_primary(io.parse_paf(lines(t, PAF))).select("line_no", "qname", "tname")


BLAST = "SELECT " + tabbed("qseqid", "sseqid", "CAST(CAST(pident AS INT) AS STRING)", "CAST(length AS STRING)", "CAST(qstart AS STRING)", "CAST(qend AS STRING)",
                           "CAST(sstart AS STRING)", "CAST(send AS STRING)", "'1e-5'", "CAST(CAST(bitscore AS INT) AS STRING)") + " AS value, line_no FROM {v_hits}"


@query("io4_blast6", """SELECT line_no, qseqid AS query, split_part(sseqid,'|src=',1) AS subject, split_part(sseqid,'|src=',2) AS src_tag, pident AS identity,
    length, qstart AS q_start, CAST(sstart AS BIGINT) AS s_start, 1e-5::DOUBLE AS evalue, bitscore FROM {v_hits} WHERE length >= 30""")
def io4(t):
    return io.parse_blast6(lines(t, BLAST)).select("line_no", "query", "subject", "src_tag", "identity", "length", "q_start", "s_start", "evalue", "bitscore")


FASTA = "SELECT concat(header,' extra text',chr(10),substr(seq,1,30),chr(10),substr(seq,31,40),chr(10)) AS value, ord FROM {v_elements}"


@query("io5_fasta", "SELECT ord, header AS id, concat(header,' extra text') AS header, seq, CAST(length(seq) AS INTEGER) AS length FROM {v_elements}")
def io5(t):
    return io.parse_fasta(lines(t, FASTA))


# one long line block per read pair file: four numbered lines per record
FASTQ = """SELECT r.rec*4 + s.i AS line_no, CASE s.i WHEN 0 THEN concat('@',r.name,'/1 x') WHEN 1 THEN lower(r.seq) WHEN 2 THEN '+' ELSE r.qual END AS value
    FROM (SELECT p_partkey AS rec, concat('r',CAST(p_partkey AS STRING)) AS name, seq, repeat('F',CAST(length(seq) AS INT)) AS qual FROM {part} JOIN {v_elements} ON ord = p_partkey) r
    CROSS JOIN (SELECT 0 AS i UNION ALL SELECT 1 AS i UNION ALL SELECT 2 AS i UNION ALL SELECT 3 AS i) s"""


@query("io6_fastq", "SELECT concat('r',ord) AS qname, 1 AS mate, seq, repeat('F',CAST(length(seq) AS INT)) AS qual FROM {v_elements}")
def io6(t):
    return io.parse_fastq(lines(t, FASTQ), 1)


GFF = "SELECT " + tabbed("chrom", "'src'", "ftype", "CAST(start_pos AS STRING)", "CAST(end_pos AS STRING)", "'.'", "strand",
                         "CASE WHEN ftype='CDS' THEN CAST(phase AS STRING) ELSE '.' END",
                         "concat('ID=',id,';flag;Parent=',parent,';description=a%2Cb%20c=d')") + " AS value FROM {v_features} UNION ALL SELECT '#x' AS value FROM {region}"


@query("io7_gff3", """SELECT chrom, ftype, start_pos, end_pos, strand, CASE WHEN ftype='CDS' THEN phase ELSE 0 END AS phase, id, parent, id AS name, 'a,b c=d' AS description
    FROM {v_features}""")
def io7(t):
    return io.parse_gff3(lines(t, GFF)).drop("attrs")


BED = "SELECT concat(chrom,chr(9),CASE WHEN line_no % 50 = 0 THEN 'x' ELSE CAST(start_pos AS STRING) END,chr(9),CAST(end_pos AS STRING),CASE WHEN line_no % 7 = 0 THEN '' ELSE concat(chr(9),name) END) AS value, line_no FROM {v_mask}"


@query("io8_bed", "SELECT line_no, chrom, start_pos, end_pos, CASE WHEN line_no % 7 = 0 THEN 'masked' ELSE name END AS name FROM {v_mask} WHERE line_no % 50 <> 0")
def io8(t):
    return io.parse_bed(lines(t, BED))


TSV = "SELECT " + tabbed("c_name", "c_mktsegment", "CAST(c_nationkey AS STRING)") + " AS value FROM {customer} UNION ALL SELECT '# note' AS value FROM {region} UNION ALL SELECT 'name\tsegment\tnation' AS value FROM {region}"


@query("io9_tsv", "SELECT c_name AS name, c_mktsegment AS segment, CAST(c_nationkey AS VARCHAR) AS nation FROM {customer}")
def io9(t):
    return io.parse_tsv(lines(t, TSV), ["name", "segment", "nation"])


CUSTODY = """SELECT line_no, log_id, concat(chr(123),'"ts":"2024-01-01T00:00:00+00:00","sample":"s","step":"',step,'","event":"',event,'","user":"u","input_sha256":',
    CASE WHEN event = 'pre' THEN concat(chr(123),'"',fname,'":"',digest,'"',chr(125)) ELSE 'null' END,',"exit_code":',CAST(line_no % 3 AS STRING),chr(125)) AS value FROM {v_custody}"""


@query("io10_custody", """SELECT line_no, log_id, step, event, CAST(line_no % 3 AS INTEGER) AS exit_code, CASE WHEN event='pre' THEN digest END AS digest FROM {v_custody}""")
def io10(t):
    log = io.parse_custody(lines(t, CUSTODY))
    return log.select("line_no", "log_id", "step", "event", "exit_code", F.get(F.map_values("input_sha256"), F.lit(0)).alias("digest"))


STATS = """SELECT sample, concat('insertion_',site_chr,'_',CAST(site_pos AS STRING),'_',site_id,'_',m.k,chr(9),CASE m.k WHEN 'verdict' THEN CASE WHEN n_elements > 1 THEN 'CANDIDATE' ELSE 'UNKNOWN' END
    WHEN 'insert_length' THEN CAST(largest_gap AS STRING) WHEN 'status' THEN concat('ok',chr(9),'x') ELSE CAST(n_borders AS STRING) END) AS value
    FROM {v_evidence} CROSS JOIN (SELECT 'verdict' AS k UNION ALL SELECT 'insert_length' AS k UNION ALL SELECT 'status' AS k UNION ALL SELECT 'remaining_ns' AS k) m WHERE NOT (m.k = 'status' AND n_elements = 0)
    UNION ALL SELECT sample, concat('insertion_sites',chr(9),'7') AS value FROM {v_evidence}"""


@query("io11_site_stats", """SELECT sample, concat('insertion_',site_chr,'_',site_pos,'_',site_id) AS site_id, CASE WHEN n_elements > 1 THEN 'CANDIDATE' ELSE 'UNKNOWN' END AS verdict, CAST(largest_gap AS VARCHAR) AS insert_length,
    CASE WHEN n_elements > 0 THEN concat('ok',chr(9),'x') END AS status, CAST(n_borders AS VARCHAR) AS remaining_ns, CAST(NULL AS VARCHAR) AS assembly_rounds FROM {v_evidence}""")
def io11(t):
    return io.parse_site_stats(lines(t, STATS))


REPORTS = """SELECT site_id, concat('Report',chr(10),'Insertion site: ',site_chr,':',CAST(site_pos AS STRING),chr(10),'Structure: single-copy',chr(10),
    CASE WHEN n_elements = 3 THEN '' ELSE concat('Verdict: ',CASE n_elements WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'FALSE_POSITIVE' ELSE 'CANDIDATE' END,' - because ',CAST(n_elements AS STRING),chr(10)) END,
    'T-DNA borders found: ',CAST(n_borders AS STRING),chr(10),'  largest non-host gap: 1,',lpad(CAST(largest_gap % 1000 AS STRING),3,'0'),'bp',chr(10),'Detailed element positions:',chr(10),
    repeat(concat('   10  200 + element_db P-x y',chr(10)),CAST(n_elements AS INT))) AS value FROM {v_evidence}"""


@query("io12_reports", """SELECT site_id, concat(site_chr,':',site_pos) AS insertion_site, 'single-copy' AS structure, CASE n_elements WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'FALSE_POSITIVE' WHEN 2 THEN 'CANDIDATE' END AS verdict,
    CASE WHEN n_elements < 3 THEN concat('because ',n_elements) END AS reason, CAST(n_borders AS BIGINT) AS n_borders, 1000 + largest_gap % 1000 AS largest_gap, CAST(n_elements AS INTEGER) AS n_element_rows FROM {v_evidence}""")
def io12(t):
    return io.parse_reports(lines(t, REPORTS)).withColumn("n_element_rows", F.size("elements")).drop("elements")


@query("io12_report_elements", """SELECT site_id, 10::BIGINT AS q_start, 200::BIGINT AS q_end, '+' AS direction, 'element_db' AS source, 'P-x y' AS element
    FROM {v_evidence}, unnest(range(n_elements)) u(i)""")
def io12b(t):
    return report_elements(io.parse_reports(lines(t, REPORTS)), ["site_id"])


@query("io14_fasta_lines", r"SELECT concat('>',qname,chr(10),regexp_replace(regexp_replace(seq,'(.{80})',concat('\1',chr(10)),'g'),'\n$','')) AS value FROM {v_reads}")
def io14(t):
    return io.fasta_lines(t.once("v_reads"), "qname")


# ---- filters ----

QC = """SELECT *, CASE WHEN (length(qual) - g20) / length(qual) > 0.4::DOUBLE THEN 'low_quality' WHEN length(seq) < 50 THEN 'too_short' ELSE 'passed' END AS qc
    FROM (SELECT *, length(regexp_replace(qual,'[!-4]','','g')) AS g20, length(regexp_replace(qual,'[!->]','','g')) AS g30 FROM {v_reads}) q"""
fragment("o_qc", QC)


@query("fl1_read_qc", "SELECT sample, qname, CAST(mate AS INTEGER) AS mate, qc FROM {o_qc} WHERE qc = 'passed'")
def fl1(t):
    return rd.read_qc(t.once("v_reads")).filter("qc = 'passed'").select("sample", "qname", F.col("mate").cast("int").alias("mate"), "qc")


@query("fl1_qc_summary", """SELECT sample, count(*) FILTER (qc='passed') AS passed, count(*) FILTER (qc='low_quality') AS low_quality, count(*) FILTER (qc='too_short') AS too_short, count(*) AS reads_before,
    CAST(sum(length(seq)) AS BIGINT) AS bases_before, CAST(coalesce(sum(length(seq)) FILTER (qc='passed'),0) AS BIGINT) AS bases_after,
    sum(g20)/sum(length(seq)) AS q20_rate_before, sum(g30)/sum(length(seq)) AS q30_rate_before,
    sum(g20) FILTER (qc='passed')/sum(length(seq)) FILTER (qc='passed') AS q20_rate_after, sum(g30) FILTER (qc='passed')/sum(length(seq)) FILTER (qc='passed') AS q30_rate_after
    FROM {o_qc} GROUP BY sample""")
def fl1b(t):
    return rd.qc_summary(rd.read_qc(t.once("v_reads")))


@query("fl2_primary", "SELECT qname, mate, chrom, ref_start FROM {v_alignments} WHERE (flag & 2308) = 0")
def fl2(t):
    return rd.primary(t.once("v_alignments")).select("qname", "mate", "chrom", "ref_start")


VEC = """SELECT p_partkey, concat(p_name, CASE CAST(p_partkey % 9 AS INT) WHEN 0 THEN ' Adapter x' WHEN 1 THEN ' pCAMBIA-1300' WHEN 2 THEN ' PCR primer' WHEN 3 THEN ' Ion Torrent' WHEN 4 THEN ' binary plasmid index' WHEN 5 THEN ' Bin 19' WHEN 6 THEN ' indexed' ELSE ' plain' END) AS header FROM {part}"""
_REM = r"lower(regexp_extract(header,'(?i)(\badapter\b|\bprimer\b|\blinker\b|\bPCR\b|\bIllumina\b|\bIon\s*Torrent\b|\b454\b|\bSOLiD\b|\bbarcode\b|\bindex\b)',1))"
_PLANT = r"regexp_matches(header,'(?i)(\bbinary\b|\bpCAMBIA\b|\bpPZP\d|\bpGreen\b|\bpSoup\b|\bpBI\d|\bpBIN\d|\bBin\s*19\b|\bplant\s+transform|\bT-DNA\b|\bGUS\s+gene\s+fusion\b|\bpART\b|\bpORE\b|\bpMDC\b|\bpEarley\b|\bpGWB\b|\bpCLEAN\b|\bpMAA\b)')"


@query("fl3_filter_vectors", f"SELECT p_partkey, concat('univec|',header) AS header FROM ({VEC}) v WHERE {_REM} = '' AND {_PLANT}")
def fl3(t):
    return cf.filter_vectors(lines(t, VEC), "plant")


@query("fl3_removals", f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN {_REM} <> '' THEN {_REM} WHEN NOT {_PLANT} THEN 'non-plant-vector' END AS reason FROM ({VEC}) v) r WHERE reason IS NOT NULL GROUP BY reason")
def fl3b(t):
    return cf.vector_removals(lines(t, VEC), "plant")


@query("fl4_subsample_pairs", """SELECT sample, qname, CAST(mate AS INTEGER) AS mate FROM {v_reads} WHERE CAST(concat('0x',substr(md5(concat('42:',qname)),1,8)) AS BIGINT) < 1288490188""")
def fl4(t):
    return rd.subsample_pairs(t.once("v_reads"), 0.3, 42).select("sample", "qname", F.col("mate").cast("int").alias("mate"))


CONTIGS = "SELECT DISTINCT sample, qseqid AS contig FROM {v_hits}"


def _long(hits):
    return hits.withColumn("length", F.col("length") * 5)


@query("fl5_marker_contigs", f"SELECT sample, contig FROM ({CONTIGS}) c WHERE EXISTS (SELECT 1 FROM {{v_hits}} h WHERE h.sample = c.sample AND h.qseqid = c.contig AND pident >= 90 AND length*5 >= 200)")
def fl5(t):
    return cf.filter_contigs_by_markers(lines(t, CONTIGS), _long(t.v_hits))


@query("fl5_marker_counts", f"""SELECT sample, count(*) AS total, count(*) FILTER (ok) AS kept FROM (SELECT sample, qseqid, bool_or(pident >= 90 AND length*5 >= 200) AS ok FROM {{v_hits}} GROUP BY 1,2) g GROUP BY sample""")
def fl5b(t):
    contigs = lines(t, CONTIGS)
    return cf.marker_counts(contigs, cf.filter_contigs_by_markers(contigs, _long(t.v_hits)))


@query("fl6_element_hits", "SELECT sample, qseqid, count(*) AS n_hits, arg_min(sseqid, (db_idx, line_no, sseqid)) AS first_hit FROM {v_hits} WHERE length >= 20 GROUP BY 1,2")
def fl6(t):
    return cf.element_hits(t.v_hits.withColumn("line_no", F.struct("line_no", "sseqid")))


CLIP_PAF = "SELECT sample, qname, line_no, qlen, qstart, qend + line_no % 9 * 80 AS qend, matches, CASE WHEN line_no % 40 = 3 THEN 0 ELSE CAST(300 + line_no % 60 AS INT) END AS block_len FROM {v_paf}"


@query("fl7_maps_to_host", f"SELECT DISTINCT sample, qname FROM ({CLIP_PAF}) p WHERE block_len > 0 AND matches / block_len >= 0.90 AND (qend - qstart) / qlen >= 0.80")
def fl7(t):
    return cf.maps_to_host(paf_ratios(lines(t, CLIP_PAF)))


GHITS = "SELECT line_no, sseqid, 20 AS grna_len, 14 + line_no % 7 AS length, line_no % 6 AS n_mismatch, sstart, send FROM {v_hits}"


@query("fl8_grna_hits", f"""SELECT line_no, sseqid, CASE WHEN sstart < send THEN '+' ELSE '-' END AS strand, CAST(least(sstart,send) - 1 AS BIGINT) AS t_start, CAST(greatest(sstart,send) AS BIGINT) AS t_end, n_mismatch + 20 - length AS mismatches
    FROM ({GHITS}) g WHERE length >= 16 AND n_mismatch <= 4""")
def fl8(t):
    return cf.grna_hits(lines(t, GHITS)).select("line_no", "sseqid", "strand", "t_start", "t_end", "mismatches")


SITES = "SELECT sample, site_id, CASE WHEN insert_len % 4 = 0 THEN 'CANDIDATE' WHEN insert_len % 4 = 1 THEN 'CANDIDATE_LOW_CONF' ELSE 'UNKNOWN' END AS verdict FROM {v_inserts}"
INSERTS = "SELECT sample, site_id, CAST(length % 3 AS BIGINT) AS idx, subject AS header, db FROM {v_insert_hits}"


@query("fl9_candidate_inserts", f"SELECT i.sample, i.site_id, idx, db, concat(i.sample,'|',substr(i.site_id,11),'|',idx,'|',header) AS header FROM ({INSERTS}) i JOIN ({SITES}) s USING (sample, site_id) WHERE verdict = 'CANDIDATE'")
def fl9(t):
    return cf.candidate_inserts(lines(t, SITES), lines(t, INSERTS))


JUNC = """SELECT sample, concat('contig', CAST(line_no % 300 AS STRING)) AS contig, tname AS host_chr, tstart % 5 AS junction_pos, mapq AS host_mapq, line_no,
    CASE CAST(line_no % 4 AS INT) WHEN 0 THEN 'Low' WHEN 1 THEN 'Medium' WHEN 2 THEN 'High' ELSE 'odd' END AS confidence FROM {v_paf}"""


@query("fl10_dedupe_junctions", f"SELECT sample, contig, host_chr, junction_pos, host_mapq, line_no, confidence FROM ({JUNC}) j QUALIFY row_number() OVER (PARTITION BY sample, contig, host_chr, junction_pos ORDER BY host_mapq DESC, line_no) = 1")
def fl10(t):
    return cf.dedupe_junctions(lines(t, JUNC))


@query("fl11_best_junctions", f"""SELECT * FROM (SELECT sample, contig, host_chr, junction_pos, host_mapq, line_no, confidence FROM ({JUNC}) j
    QUALIFY row_number() OVER (PARTITION BY sample, contig, host_chr, junction_pos ORDER BY CASE confidence WHEN 'High' THEN 0 WHEN 'Low' THEN 2 ELSE 1 END, line_no) = 1) b WHERE confidence <> 'Low'""")
def fl11(t):
    return cf.best_junctions(lines(t, JUNC))


# ---- read pairs ----

CONSTRUCT_MAPPED = "SELECT sample, qname, CASE WHEN length(seq) % 7 = 0 THEN CASE WHEN mate = 2 THEN 2052 ELSE 4 END WHEN length(seq) % 3 = 0 THEN 4 ELSE 3 END AS flag FROM {v_reads}"
_HITNAMES = f"SELECT DISTINCT sample, qname FROM ({CONSTRUCT_MAPPED}) a WHERE (flag & 4) = 0 OR (flag & 2048) <> 0"


@query("rj1_extract_pairs", f"SELECT sample, qname, CAST(mate AS INTEGER) AS mate FROM {{v_reads}} SEMI JOIN ({_HITNAMES}) n USING (sample, qname)")
def rj1(t):
    return rd.extract_pairs(lines(t, CONSTRUCT_MAPPED), t.v_reads).select("sample", "qname", F.col("mate").cast("int").alias("mate"))


@query("rj1_pair_counts", f"""SELECT sample, count(*) AS names, CAST(sum(r1) AS BIGINT) AS r1, CAST(sum(r2) AS BIGINT) AS r2, count(*) FILTER (r1=0 OR r2=0) AS singletons FROM (
    SELECT sample, qname, count(*) FILTER (mate=1) AS r1, count(*) FILTER (mate=2) AS r2 FROM {{v_reads}} SEMI JOIN ({_HITNAMES}) n USING (sample, qname) GROUP BY 1,2) g GROUP BY sample""")
def rj1b(t):
    return rd.pair_counts(rd.extract_pairs(lines(t, CONSTRUCT_MAPPED), t.v_reads))


@query("rj2_foreign_reads", "SELECT DISTINCT sample, qname FROM {v_alignments} a WHERE NOT EXISTS (SELECT 1 FROM {v_alignments} b WHERE b.sample=a.sample AND b.qname=a.qname AND (b.flag & 12) = 0 AND b.mapq >= 20)")
def rj2(t):
    return rd.foreign_reads(t.v_alignments)


@query("rj3_unmapped", "SELECT qname, mate, flag, (flag & 12) = 12 AS both_unmapped FROM {v_alignments} WHERE (flag & 4) <> 0")
def rj3(t):
    from sitewright.functions import flag_is
    return rd.unmapped_reads(t.v_alignments).select("qname", "mate", "flag", flag_is("flag", 8).alias("both_unmapped"))


REGIONS = "SELECT chrom, start_pos, end_pos FROM {v_mask}"
_INREG = "EXISTS (SELECT 1 FROM (" + REGIONS + ") r WHERE r.chrom = a.chrom AND a.ref_start + 1 BETWEEN r.start_pos - 500 AND r.end_pos + 500)"
fragment("o_homology", f"SELECT *, (flag & 4) = 0 AND {_INREG} AS hit FROM {{v_alignments}} a")


def _pos1(t):
    return t.v_alignments.withColumn("pos", F.col("ref_start") + 1)


@query("rj7_homology_filter", "SELECT qname, mate, chrom, ref_start FROM {o_homology} WHERE qname NOT IN (SELECT qname FROM {o_homology} WHERE hit)")
def rj7(t):
    return rd.homology_filter(_pos1(t), lines(t, REGIONS)).select("qname", "mate", "chrom", "ref_start")


@query("rj7_homology_report", """SELECT sample, count(*) FILTER ((flag & 4) = 0) // 2 AS total_pairs, count(DISTINCT CASE WHEN (flag & 4) = 0 THEN qname END) AS exact_pairs, count(DISTINCT CASE WHEN hit THEN qname END) AS discarded_pairs,
    count(*) FILTER (hit) AS discarded_records, count(*) FILTER ((flag & 4) = 0) // 2 - count(DISTINCT CASE WHEN hit THEN qname END) AS retained_pairs,
    count(DISTINCT CASE WHEN hit THEN qname END) / (count(*) FILTER ((flag & 4) = 0) // 2) AS discarded_frac FROM {o_homology} GROUP BY sample""")
def rj7b(t):
    return rd.homology_report(_pos1(t), lines(t, REGIONS))


@query("rj7_homology_by_chrom", "SELECT sample, chrom, count(*) AS discarded FROM {o_homology} WHERE hit GROUP BY 1,2")
def rj7c(t):
    return rd.homology_by_chrom(_pos1(t), lines(t, REGIONS))


POOL = "SELECT sample, qname, CAST(mate AS INT) AS mate, CASE WHEN length(seq) % 4 = 0 THEN substr(seq,1,19 + length(seq) % 3) ELSE seq END AS seq FROM {v_reads}"


@query("it1_read_pool", f"""SELECT sample, qname, mate, CASE WHEN mate = 2 THEN reverse(translate(seq,'ACGT','TGCA')) ELSE seq END AS seq FROM ({POOL}) p
    WHERE qname IN (SELECT qname FROM ({POOL}) q GROUP BY qname HAVING count(*) = 2 AND min(length(seq)) >= 20 AND NOT bool_or(contains(seq,'N')))""")
def it1(t):
    return rd.read_pool(lines_once(t, POOL))


PHASE_SITES = "SELECT sample, site_id, chrom, 0 AS pos_idx, pos FROM {v_sites} UNION ALL SELECT sample, site_id, chrom, 1 AS pos_idx, pos + 30 AS pos FROM {v_sites}"
_read_class = """CASE WHEN ref_end < p - 20 OR ref_start > p + 20 THEN 0
    WHEN (rc >= 20 AND abs(ref_end - p) <= 20) OR (lc >= 20 AND abs(ref_start - p) <= 20) THEN 2
    WHEN ref_start <= p - 20 AND ref_end >= p + 20 AND rc < 20 AND lc < 20 THEN 1 ELSE 0 END"""
fragment("o_phase", rf"""SELECT sample, site_id, qname, CASE WHEN max(CAST(v=2 AS INT)) = 1 THEN 'insertion' WHEN max(CAST(v=1 AS INT)) = 1 THEN 'wt' ELSE 'distal' END AS phase FROM (
    SELECT sample, site_id, qname, CASE WHEN v1 > 0 THEN v1 ELSE v2 END AS v FROM (
      SELECT a.sample, s.site_id, a.qname, {_read_class.replace(' p ', ' (s.pos-1) ').replace('- p)', '- (s.pos-1))')} AS v1, {_read_class.replace(' p ', ' (s.pos+29) ').replace('- p)', '- (s.pos+29))')} AS v2
      FROM (SELECT *, coalesce(TRY_CAST(regexp_extract(cigar,'^(\d+)S',1) AS INTEGER),0) AS lc, coalesce(TRY_CAST(regexp_extract(cigar,'(\d+)S$',1) AS INTEGER),0) AS rc FROM {{v_alignments}} WHERE (flag & 2308) = 0) a
      JOIN {{v_sites}} s ON a.sample = s.sample AND a.chrom = s.chrom AND a.ref_start <= s.pos + 530 AND a.ref_end > s.pos - 500) x) y GROUP BY 1,2,3""")


@query("dt15_phase_reads", "SELECT sample, site_id, qname, phase, phase <> 'wt' AS kept FROM {o_phase}")
def dt15(t):
    return rd.phase_reads(t.v_alignments, lines(t, PHASE_SITES), flank=500)


@query("dt15_site_read_names", "SELECT sample, site_id, qname FROM {o_phase} WHERE phase <> 'wt' UNION ALL SELECT DISTINCT sample, NULL, qname FROM {v_alignments} WHERE (flag & 12) = 12")
def dt15b(t):
    return rd.site_read_names(rd.phase_reads(t.v_alignments, lines(t, PHASE_SITES), flank=500), t.v_alignments)

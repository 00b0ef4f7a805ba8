"""Readers and sinks on real files."""
import gzip

import pytest
from pyspark.sql import functions as F

from sitewright import sources as io


def put(path, text):
    path.write_text(text)
    return str(path)


def test_sam(spark, tmp_path):
    p = put(tmp_path / "a.sam", "@HD\tx\nr1\t3\tc1\t11\t60\t20M\t=\t50\t0\tACGT\tIIII\tNM:i:0\tSA:Z:c2,1,+,5M,0,0;\nshort\tline\n\n")
    r = io.read_sam(spark, p).collect()
    assert len(r) == 1 and r[0].pos == 11 and r[0].tags == {"NM": "0", "SA": "c2,1,+,5M,0,0;"}


def test_fasta_blocks_and_sink(spark, tmp_path):
    p = put(tmp_path / "a.fa", ">s1 desc\nACGTACGT\nACG\n>s2\nTT\n")
    df = io.read_fasta(spark, p)
    assert {(r.id, r.seq, r.length) for r in df.collect()} == {("s1", "ACGTACGTACG", 11), ("s2", "TT", 2)}
    blocks = {(r.chrom, r.start_pos): r.seq for r in io.ref_blocks(df, block=4, overlap=2).collect()}
    assert blocks == {("s1", 0): "ACGTAC", ("s1", 4): "ACGTAC", ("s1", 8): "ACG", ("s2", 0): "TT"}
    io.write_fasta(df, str(tmp_path / "out"), width=4)
    back = io.read_fasta(spark, str(tmp_path / "out"))
    assert {(r.id, r.seq) for r in back.collect()} == {("s1", "ACGTACGTACG"), ("s2", "TT")}


def test_fastq_pairs(spark, tmp_path):
    for m in (1, 2):
        with gzip.open(tmp_path / f"r{m}.fq.gz", "wt") as fh:
            fh.writelines(f"@q{i}/{m} x\nacgt{'a' * i}\n+\n@III{'I' * i}\n" for i in range(50))
    rows = io.read_fastq(spark, str(tmp_path / "r1.fq.gz"), str(tmp_path / "r2.fq.gz")).collect()
    assert len(rows) == 100 and {(r.qname, r.mate) for r in rows} == {(f"q{i}", m) for i in range(50) for m in (1, 2)}
    assert next(r for r in rows if r.qname == "q3").seq == "ACGTAAA"


def test_line_numbers_over_partitions(spark):
    df = spark.createDataFrame([(str(i),) for i in range(1000)], "value string").repartition(1).coalesce(1)
    many = spark.range(0, 1000, 1, 7).select(F.col("id").cast("string").alias("value"))
    assert all(int(r.value) == r.line_no for r in io.index_lines(many).collect())
    assert io.index_lines(df).count() == 1000


def test_custody_names_the_bad_line(spark, tmp_path):
    good = '{"ts":"2024-01-01T00:00:00+00:00","sample":"s","step":"a","event":"pre","input_sha256":{"f":"d"}}\n'
    assert io.read_custody(spark, put(tmp_path / "ok.jsonl", good)).first().input_sha256 == {"f": "d"}
    with pytest.raises(Exception, match="Line 3: invalid JSON"):
        io.read_custody(spark, put(tmp_path / "bad.jsonl", good + "\n" + "{oops\n")).collect()


def test_small_readers(spark, tmp_path):
    bed = io.read_bed(spark, put(tmp_path / "m.bed", "#c\nc1\t5\t9\tn\nc1\tx\t9\nc1\t1\t2\nc1\t1\n")).collect()
    assert {(r.start_pos, r.end_pos, r.name) for r in bed} == {(5, 9, "n"), (1, 2, "masked")}
    tsv = io.read_tsv(spark, put(tmp_path / "t.tsv", "# note\na\tb\n1\t2\n")).collect()
    assert [(r.a, r.b) for r in tsv] == [("1", "2")]
    b6 = io.read_blast6(spark, put(tmp_path / "h.tsv", "q\ts|src=univec|src=x\t99.5\t30\t1\t30\t5\t34\t1e-9\t55.2\nq\ts\t99\t29\t1\t29\t1\t29\t1\t9\n")).collect()
    assert [(r.subject, r.src_tag, r.bitscore) for r in b6] == [("s", "univec|src=x", 55.2)]
    gff = io.read_gff3(spark, put(tmp_path / "g.gff3", "c1\tx\tgene\t1\t9\t.\t+\t.\tID=g1;Name=N;description=a%2Cb%20c\n")).first()
    assert (gff.id, gff.name, gff.description, gff.phase) == ("g1", "N", "a,b c", 0)
    stats = io.read_site_stats(spark, put(tmp_path / "s.txt", "insertion_Chr_1_2_verdict\tCANDIDATE\ninsertion_Chr_1_2_insert_length\t10\n")).first()
    assert (stats.site_id, stats.verdict, stats.insert_length) == ("insertion_Chr_1_2", "CANDIDATE", "10")


def test_report_text(spark, tmp_path):
    text = ("Insertion site: Chr3:16,439\nVerdict: UNKNOWN — no element annotations\nT-DNA borders found: 4\nx largest non-host gap: 1,024bp\n"
            "Detailed element positions:\n  10  90  +  element_db  P-35S x\n")
    put(tmp_path / "insertion_a_report.txt", text)
    r = io.read_reports(spark, str(tmp_path)).first()
    assert (r.verdict, r.reason, r.n_borders, r.largest_gap, len(r.elements)) == ("UNKNOWN", "no element annotations", 4, 1024, 1)


def test_table_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s0", "c1", 2), ("s1", "c1", 1)], "sample string, chrom string, pos int")
    io.write_table(df, str(tmp_path / "p"), sort_by=("chrom", "pos"))
    assert {r.sample for r in spark.read.parquet(str(tmp_path / "p")).collect()} == {"s0", "s1"}
    io.write_tsv(df, str(tmp_path / "t"))
    assert spark.read.csv(str(tmp_path / "t"), sep="\t", header=True).count() == 2

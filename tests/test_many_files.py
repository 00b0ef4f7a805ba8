"""Readers over folders and small splits, and the audit of logs as they are read."""
import json

import pytest

from sitewright.operators import custody
from sitewright.sources import readers as io, sinks


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_fastq_folders(spark, tmp_path, small_splits):
    want = set()
    for mate in (1, 2):
        (tmp_path / f"m{mate}").mkdir()
        for f, n in (("a", 300), ("b", 77), ("c", 5)):
            out = []
            for i in range(n):
                seq, qual = "ACGT" * (1 + i % 9), f"{'IFGH'[mate]}" * (4 * (1 + i % 9))
                out.append(f"@{f}{i}/{mate}\n{seq}\n+\n{qual}\n")
                want.add((f"{f}{i}", mate, seq, qual))
            (tmp_path / f"m{mate}" / f"{f}.fq").write_text("".join(out))
    got = {(r.qname, r.mate, r.seq, r.qual) for r in io.read_fastq(spark, f"{tmp_path}/m1", f"{tmp_path}/m2").collect()}
    assert got == want


def test_fasta_headers(spark, tmp_path, small_splits):
    (tmp_path / "fa").mkdir()
    (tmp_path / "fa/a.fa").write_bytes(b">e1 note 5'->3' A>G\r\nACGT\r\nAC\r\n>e2\r\nGG")
    (tmp_path / "fa/b.fa").write_text("".join(f">r{i} x>y\n{'ACGTA' * 30}\n" for i in range(200)))
    got = {r.id: (r.header, r.seq) for r in io.read_fasta(spark, f"{tmp_path}/fa").collect()}
    assert got["e1"] == ("e1 note 5'->3' A>G", "ACGTAC") and got["e2"] == ("e2", "GG")
    assert len(got) == 202 and all(got[f"r{i}"] == (f"r{i} x>y", "ACGTA" * 30) for i in range(200))


def test_custody_logs_feed_the_audit(spark, tmp_path, small_splits):
    (tmp_path / "logs").mkdir()
    line = lambda step, event, i, digest: json.dumps({
        "ts": f"2024-01-01T00:{i // 60:02d}:{i % 60:02d}+00:00", "sample": "s", "step": step, "event": event,
        "input_sha256" if event == "pre" else "output_sha256": {"f": digest}})
    good = [x for i in range(60) for x in (line(f"s{i}", "pre", i, f"d{i}"), line(f"s{i}", "post", i, f"d{i + 1}"))]
    bad = [line("s1", "pre", 5, "a"), line("s1", "post", 6, "b"), line("s2", "pre", 3, "c")]
    (tmp_path / "logs/good.jsonl").write_text("\n".join(good) + "\n")
    (tmp_path / "logs/bad.jsonl").write_text("\n".join(bad))
    log = io.read_custody(spark, f"{tmp_path}/logs")
    numbers = {}
    for r in log.collect():
        numbers.setdefault(r.log_id.rsplit("/", 1)[1], []).append(r.line_no)
    assert {k: sorted(v) for k, v in numbers.items()} == {"good.jsonl": list(range(1, 121)), "bad.jsonl": [1, 2, 3]}
    ok = {r.log_id.rsplit("/", 1)[1]: (r.errors, r.clean) for r in custody.custody_ok(log, tile=16).collect()}
    assert ok == {"good.jsonl": (0, True), "bad.jsonl": (3, False)}


def test_tsv_rows_may_start_like_the_header(spark):
    lines = spark.createDataFrame([("# note",), ("name\tkind",), ("name\tx",), ("b",)], "value string")
    assert [(r.name, r.kind) for r in io.parse_tsv(lines, ["name", "kind"]).collect()] == [("name", "x"), ("b", None)]


def test_star_is_no_sequence(spark):
    line = "q\t0\tchr1\t5\t60\t4M\t*\t0\t0\t{}\t*"
    rows = io.parse_sam(spark.createDataFrame([(line.format("*"),), (line.format("ACGT"),)], "value string")).collect()
    assert [(r.seq, r.qual) for r in rows] == [(None, None), ("ACGT", None)]


def test_writing_one_sample_keeps_the_others(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), ("B", 2)], "sample string, v int")
    sinks.write_table(df, f"{tmp_path}/t")
    sinks.write_table(spark.createDataFrame([("B", 3)], "sample string, v int"), f"{tmp_path}/t")
    assert sorted((r.sample, r.v) for r in spark.read.parquet(f"{tmp_path}/t").collect()) == [("A", 1), ("B", 3)]

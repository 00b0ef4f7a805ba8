"""Text formats to tables.

Every format has a ``parse_*`` function over a frame with one ``value`` column, and a ``read_*`` function
that feeds it from files.  Prefer Parquet partitioned by sample for the large tables; these readers are the
way in.
"""
from __future__ import annotations

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from sitewright.functions import src_tag, strip_src_tag

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STAT_METRICS = ["insert_length", "remaining_ns", "assembly_rounds", "status", "verdict"]
CUSTODY_SCHEMA = ("ts string, sample string, step string, event string, user string, cmd string, input_sha256 map<string,string>, "
                  "output_sha256 map<string,string>, exit_code int, wall_time_sec double")


def _fields(lines: DataFrame, least: int, comment: str | None = "#") -> DataFrame:
    keep = F.trim("value") != ""
    if comment:
        keep = keep & ~F.startswith("value", F.lit(comment))
    rest = [c for c in lines.columns if c != "value"]
    return lines.filter(keep).select(*rest, F.split("value", "\t").alias("f")).filter(F.size("f") >= least)


def _f(i: int, kind: str | None = None) -> Column:
    c = F.get("f", F.lit(i))
    return c.try_cast(kind) if kind else c


def _rest(lines: DataFrame) -> list[str]:
    return [c for c in lines.columns if c != "value"]


def parse_sam(lines: DataFrame) -> DataFrame:
    """SAM text: header lines dropped, at least 11 fields, trailing tags as a map; ``*`` stands for no bases or qualities."""
    rows = _fields(lines, 11, "@")
    tags = F.transform(F.slice("f", 12, F.greatest(F.size("f") - 11, F.lit(0))), lambda x: F.struct(
        F.substring(x, 1, 2).alias("key"), F.substring(x, F.lit(6), F.length(x)).alias("value")))
    return rows.select(
        *_rest(lines), _f(0).alias("qname"), _f(1, "int").alias("flag"), _f(2).alias("chrom"), _f(3, "bigint").alias("pos"),
        _f(4, "int").alias("mapq"), _f(5).alias("cigar"), _f(6).alias("rnext"), _f(7, "bigint").alias("pnext"),
        F.nullif(_f(9), F.lit("*")).alias("seq"), F.nullif(_f(10), F.lit("*")).alias("qual"), F.map_from_entries(tags).alias("tags"))


def parse_paf(lines: DataFrame) -> DataFrame:
    rows = _fields(lines, 12)
    longs = {1: "qlen", 2: "qstart", 3: "qend", 6: "tlen", 7: "tstart", 8: "tend", 9: "matches", 10: "block_len"}
    cols = [_f(0).alias("qname"), _f(4).alias("strand"), _f(5).alias("tname"), _f(11, "int").alias("mapq"),
            F.slice("f", 13, F.greatest(F.size("f") - 12, F.lit(0))).alias("tags")]
    return paf_ratios(rows.select(*_rest(lines), *cols, *[_f(i, "bigint").alias(n) for i, n in longs.items()]))


def paf_ratios(paf: DataFrame) -> DataFrame:
    """Derived identity (0 for an empty block) and aligned fraction of the query."""
    return paf.withColumns({
        "identity": F.when(F.col("block_len") > 0, F.col("matches") / F.col("block_len")).otherwise(0.0),
        "aligned_frac": F.when(F.col("qlen") > 0, (F.col("qend") - F.col("qstart")) / F.col("qlen")).otherwise(0.0),
    })


def paf_primary(paf: DataFrame) -> DataFrame:
    return paf.filter(F.array_contains("tags", "tp:A:P"))


def parse_blast6(lines: DataFrame, min_len: int = 30) -> DataFrame:
    """Similarity hits of at least ``min_len``; the source tag moves to its own column."""
    rows = _fields(lines, 10, None).select(
        *_rest(lines), _f(0).alias("query"), strip_src_tag(_f(1)).alias("subject"), src_tag(_f(1)).alias("src_tag"),
        _f(2, "double").alias("identity"), _f(3, "bigint").alias("length"), _f(4, "bigint").alias("q_start"),
        _f(5, "bigint").alias("q_end"), _f(6, "bigint").alias("s_start"), _f(7, "bigint").alias("s_end"),
        _f(8, "double").alias("evalue"), F.rtrim(_f(9)).try_cast("double").alias("bitscore"))
    return rows.filter(F.col("length") >= min_len)


def parse_fasta(records: DataFrame) -> DataFrame:
    """One row per record text (header line, then sequence lines)."""
    text = F.regexp_replace("value", "\r", "")
    at = F.instr(text, "\n")
    header = F.when(at > 0, F.substring(text, F.lit(1), at - 1)).otherwise(text)
    seq = F.when(at > 0, F.regexp_replace(F.substring(text, at + 1, F.length(text)), r"\s", "")).otherwise("")
    rows = records.filter(F.trim("value") != "").select(*_rest(records), header.alias("header"), seq.alias("seq"))
    return rows.select(*_rest(records), F.regexp_extract("header", r"^(\S+)", 1).alias("id"), "header", "seq",
                       F.length("seq").alias("length"))


def ref_blocks(seqs: DataFrame, block: int = 4096, overlap: int = 64) -> DataFrame:
    """Cut long sequences into blocks (0-based ``start_pos``) that run ``overlap`` bases into the next one; linear in length."""
    def cut(batches):
        for pdf in batches:
            for name, seq in pdf.itertuples(index=False):
                at = range(0, max(len(seq), 1), block)
                for lo in range(0, len(at), 4096):  # a few thousand blocks per output batch
                    part = at[lo:lo + 4096]
                    yield pd.DataFrame({"chrom": name, "start_pos": list(part), "core_len": block, "seq": [seq[a:a + block + overlap] for a in part]})

    return seqs.select("id", "seq").mapInPandas(cut, "chrom string, start_pos long, core_len int, seq string")


def index_file_lines(lines: DataFrame) -> DataFrame:
    """Lines just read from text files, numbered from 0 within each file (``path``, ``line_no``).

    A task may hold splits of several files in any order, so lines are counted per (file, split start) and the counts
    are summed along each file.
    """
    rows = lines.select(*lines.columns, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("_block"),
                        F.monotonically_increasing_id().alias("_id"))
    splits = rows.groupBy("path", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_least"))
    w = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("path", "_block", (F.coalesce(F.sum("_n").over(w), F.lit(0)) - F.col("_least")).alias("_shift"))
    return rows.join(splits, ["path", "_block"]).select(*lines.columns, "path", (F.col("_id") + F.col("_shift")).alias("line_no"))


def index_lines(lines: DataFrame) -> DataFrame:
    """Number lines of one file in order: row number inside the partition plus the lines of the partitions before it."""
    rows = lines.withColumn("_id", F.monotonically_increasing_id())
    part, local = F.shiftright("_id", 33).alias("_part"), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)).alias("_local")
    rows = rows.select(*lines.columns, part, local)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    return rows.join(offsets, "_part").select(*lines.columns, (F.col("_offset") + F.col("_local")).alias("line_no"))


def parse_fastq(numbered: DataFrame, mate: int) -> DataFrame:
    """Four-line records from lines numbered 0, 1, 2, ... in ``line_no``, per ``path`` if there is one."""
    slot = F.col("line_no") % 4
    recs = numbered.groupBy(*[c for c in ("path",) if c in numbered.columns], F.floor(F.col("line_no") / 4).alias("record")).agg(
        *[F.max(F.when(slot == i, F.col("value"))).alias(n) for i, n in ((0, "head"), (1, "seq"), (3, "qual"))])
    name = F.regexp_replace(F.regexp_extract("head", r"^@?(\S*)", 1), "/[12]$", "")
    return recs.select(name.alias("qname"), F.lit(mate).alias("mate"), F.upper(F.trim("seq")).alias("seq"), F.trim("qual").alias("qual"))


def parse_gff3(lines: DataFrame) -> DataFrame:
    """Gene model features; attributes as a map, percent codes decoded in the description."""
    pairs = F.filter(F.split(_f(8), ";"), lambda a: F.instr(a, "=") > 0)
    attrs = F.map_from_entries(F.transform(pairs, lambda a: F.struct(
        F.substring_index(a, "=", 1).alias("key"),
        F.substring(a, F.instr(a, "=") + 1, F.length(a)).alias("value"))))
    rows = _fields(lines, 9).select(
        *_rest(lines), _f(0).alias("chrom"), _f(2).alias("ftype"), _f(3, "bigint").alias("start_pos"), _f(4, "bigint").alias("end_pos"),
        _f(6).alias("strand"), F.coalesce(_f(7, "int"), F.lit(0)).alias("phase"), attrs.alias("attrs"))
    get = lambda k: F.coalesce(F.col("attrs")[k], F.lit(""))
    desc = F.replace(F.replace(get("description"), F.lit("%2C"), F.lit(",")), F.lit("%20"), F.lit(" "))
    return rows.withColumns({"id": get("ID"), "parent": get("Parent"), "name": F.coalesce(F.col("attrs")["Name"], get("ID")), "description": desc})


def parse_bed(lines: DataFrame) -> DataFrame:
    rows = _fields(lines, 3).select(
        *_rest(lines), _f(0).alias("chrom"), _f(1, "bigint").alias("start_pos"), _f(2, "bigint").alias("end_pos"),
        F.coalesce(_f(3), F.lit("masked")).alias("name"))
    return rows.filter(F.col("start_pos").isNotNull() & F.col("end_pos").isNotNull())


def parse_tsv(lines: DataFrame, columns: list[str]) -> DataFrame:
    """Tab-separated rows with a header line and ``#`` comments; short rows give NULLs.

    Only a line that holds all the column names is a header; a row may start with the first of them.
    """
    head = F.slice("f", 1, len(columns)) == F.array(*[F.lit(c) for c in columns])
    rows = _fields(lines, 1).filter(~head)
    return rows.select(*_rest(lines), *[F.nullif(_f(i), F.lit("")).alias(c) for i, c in enumerate(columns)])


def parse_custody(lines: DataFrame, line_no: str = "line_no") -> DataFrame:
    """Custody log lines; the first invalid line stops the read with its number."""
    rec = F.from_json("value", CUSTODY_SCHEMA + ", _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = lines.filter(F.trim("value") != "").withColumn("r", rec)
    message = F.concat(F.lit("Line "), F.col(line_no).cast("string"), F.lit(": invalid JSON"))
    checked = F.when(F.col("r._bad").isNull(), F.col("r")).otherwise(F.raise_error(message))
    return rows.withColumn("r", checked).select(*_rest(lines), "r.*").drop("_bad")


def parse_site_stats(lines: DataFrame) -> DataFrame:
    """``<site>_<metric><TAB>value`` lines, one row per site with a column per metric."""
    at = F.instr("value", "\t")
    rows = lines.filter(at > 0).select(
        *_rest(lines), F.substring("value", F.lit(1), at - 1).alias("key"), F.substring(F.col("value"), at + 1, F.length("value")).alias("stat"))
    pattern = "^(insertion_.+)_(%s)$" % "|".join(STAT_METRICS)
    rows = rows.select(*_rest(lines), F.regexp_extract("key", pattern, 1).alias("site_id"), F.regexp_extract("key", pattern, 2).alias("metric"), "stat")
    keys = [*_rest(lines), "site_id"]
    return rows.filter(F.col("site_id") != "").groupBy(*keys).agg(
        *[F.max(F.when(F.col("metric") == m, F.col("stat"))).alias(m) for m in STAT_METRICS])


def parse_reports(texts: DataFrame) -> DataFrame:
    """Fields of a free-text site report; one row per report text in ``value``."""
    grab = lambda p, g=1: F.nullif(F.regexp_extract("value", p, g), F.lit(""))
    number = lambda p: F.coalesce(F.replace(grab(p), F.lit(","), F.lit("")).try_cast("bigint"), F.lit(0).cast("bigint"))
    body = F.regexp_extract("value", r"(?s)Detailed element positions[^\n]*\n(.*)$", 1)
    return texts.select(
        *_rest(texts),
        grab(r"(?m)^Verdict:\s*([A-Z_]+)").alias("verdict"), grab(r"(?m)^Verdict: [A-Z_]+ \S+ (.*)$").alias("reason"),
        grab(r"(?m)^Insertion site:\s*(.*)$").alias("insertion_site"), grab(r"(?m)^Structure:\s*(.*)$").alias("structure"),
        number(r"(?m)^T-DNA borders found:\s*(\d+)").alias("n_borders"), number(r"largest non-host gap: ([\d,]+)bp").alias("largest_gap"),
        F.regexp_extract_all(body, F.lit(r"(?m)^\s+(\d+\s+\d+\s+\S+\s+\S+\s+.+)$"), F.lit(1)).alias("elements"))


def report_elements(reports: DataFrame, keys: list[str]) -> DataFrame:
    """Element rows of parsed reports."""
    rows = reports.select(*keys, F.explode("elements").alias("e")).withColumn("p", F.split("e", r"\s+", 5))
    return rows.select(*keys, F.get("p", F.lit(0)).cast("bigint").alias("q_start"), F.get("p", F.lit(1)).cast("bigint").alias("q_end"),
                       F.get("p", F.lit(2)).alias("direction"), F.get("p", F.lit(3)).alias("source"), F.get("p", F.lit(4)).alias("element"))


def _text(spark: SparkSession, path, **opts) -> DataFrame:
    return spark.read.options(**opts).text(path)


def read_sam(spark, path):
    return parse_sam(_text(spark, path))


def read_paf(spark, path):
    return parse_paf(_text(spark, path))


def read_blast6(spark, path, min_len: int = 30):
    return parse_blast6(_text(spark, path), min_len)


def read_fasta(spark, path):
    """Records start at a ``>`` at the start of a line; one inside a header belongs to it."""
    records = _text(spark, path, lineSep="\n>")
    return parse_fasta(records.withColumn("value", F.regexp_replace("value", "^\\s*>", "")))


def read_fastq(spark, r1, r2):
    """Both mates' files or folders, every file numbered on its own; mates share ``qname``."""
    return parse_fastq(index_file_lines(_text(spark, r1)), 1).unionByName(parse_fastq(index_file_lines(_text(spark, r2)), 2))


def read_gff3(spark, path):
    return parse_gff3(_text(spark, path))


def read_bed(spark, path):
    return parse_bed(_text(spark, path))


def read_tsv(spark, path):
    """Column names from the header line of each file."""
    return spark.read.csv(path, sep="\t", header=True, comment="#")


def read_custody(spark, path):
    """Log files for the audit: ``log_id`` is the file, lines count from 1, ``files`` the digests that count at the event."""
    lines = index_file_lines(_text(spark, path)).withColumn("line_no", F.col("line_no") + 1).withColumnRenamed("path", "log_id")
    files = F.when(F.col("event") == "pre", F.col("input_sha256")).when(F.col("event") == "post", F.col("output_sha256"))
    return parse_custody(lines).withColumn("files", files)


def read_site_stats(spark, path):
    lines = spark.read.text(path).withColumn("path", F.col("_metadata.file_path"))
    return parse_site_stats(lines)


def read_reports(spark, path):
    lines = spark.read.text(path, wholetext=True).withColumn("path", F.col("_metadata.file_path"))
    return parse_reports(lines)

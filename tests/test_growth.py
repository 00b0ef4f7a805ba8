"""Work that must grow with the rows and not with their square."""
import random
import re
from math import log

import pytest
from plan_rows import largest_output
from pyspark.sql import functions as F

from sitewright.functions import sequence as sq
from sitewright.operators import catalogue as ct, core, edits as ed, evidence, primers, reads, similarity, sites
from sitewright.plans import catalog, views
from sitewright.session import configure


def _copies(spark, n=400):
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("ACGT", k=64)) for _ in range(3)]
    elements = spark.createDataFrame([(i, f"h{i}", texts[i % 3]) for i in range(n)], "ord int, header string, seq string")
    return texts, elements


def test_contained_in_compares_copies_once(spark):
    texts, elements = _copies(spark)
    amplicons = spark.createDataFrame([(i, texts[i % 3][5:40] if i % 4 else "TTTTTTTTTTTTTTTTTTTT") for i in range(400)], "amplicon_id int, amplicon string")
    found = ct.contained_in(amplicons, elements)
    assert largest_output(found) < 20000
    assert {r.amplicon_id: (r.header, r.ord) for r in found.collect()} == {i: (f"h{i % 3}", i % 3) for i in range(400) if i % 4}


def test_insilico_pcr_binds_copies_once(spark):
    texts, elements = _copies(spark)
    flip = lambda s: s.translate(str.maketrans("ACGT", "TGCA"))[::-1]
    rows = [(i, 0 if i % 2 else 50, texts[i % 3][4:20], flip(texts[i % 3][40:54])) for i in range(400)]
    found = ct.insilico_pcr(spark.createDataFrame(rows, "method_code int, amp_size int, forward_seq string, reverse_seq string"), elements)
    assert largest_output(found) < 20000
    assert {r.method_code: (r.amplicon, r.source_id) for r in found.collect()} == {i: (texts[i % 3][4:54], f"h{i % 3}") for i in range(400)}


def _plain_tm(s):
    dh = ds = 0.0
    for a, b in zip(s, s[1:]):
        dh += sq.NN_ENTHALPY.get(a + b, sq.NN_UNKNOWN[0])
        ds += sq.NN_ENTROPY.get(a + b, sq.NN_UNKNOWN[1])
    dh, ds = dh + 0.2, ds - 5.7 + 0.368 * (len(s) - 1) * log(0.05)
    return dh * 1000.0 / (ds + 1.987 * log(250e-9 / 4)) - 273.15


def _plain_primer(text, limit, forward):
    text, n = text.upper(), len(text)
    for w in range(0, min(limit, n - 25), 5):
        found = []
        for size in range(18, 26):
            p = text[w:w + size] if forward else _flip(text[n - w - size:n - w])
            share = sum(x in "GC" for x in p) / size
            band = 0 if 0.35 <= share <= 0.65 else 1 if 0.25 <= share <= 0.75 else None
            if band is not None and "N" not in p and not any(x * 4 in p for x in "ACGTRY"):
                found.append((band, abs(_plain_tm(p) - 60), size, p, round(_plain_tm(p), 9), share, w if forward else n - w))
        if found:
            return min(found)[3:]
    return None


def _flip(s):
    return s.translate(str.maketrans("ACGT", "TGCA"))[::-1]


def test_primers_are_picked_without_a_shuffle(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(300):
        letters = "ACGT" * 6 + ("acgtNRRRY" if i % 3 == 0 else "") + ("AT" * 12 if i % 4 == 0 else "")
        rows.append((i, "".join(rnd.choices(letters, k=rnd.choice([10, 25, 26, 40, 120, 200]))), rnd.randrange(0, 120)))
    picked = primers.pick_primers(spark.createDataFrame(rows, "k int, amplicon_seq string, junction_offset int"), ["k"])
    assert "Exchange" not in picked._jdf.queryExecution().executedPlan().toString()
    got = {r.k: ((r.fwd_primer, round(r.fwd_tm, 9), r.fwd_gc, r.fwd_pos), (r.rev_primer, round(r.rev_tm, 9), r.rev_gc, r.rev_pos)) for r in picked.collect()}
    both = {k: (_plain_primer(s, off, True), _plain_primer(s, len(s) - off, False)) for k, s, off in rows}
    assert got == {k: v for k, v in both.items() if all(v)} and len(got) > 50


def test_single_pass_queries_write_no_view(spark, sf, monkeypatch):
    written = []
    monkeypatch.setattr(views, "_STAGED", {})
    monkeypatch.setattr(views, "checkpoint", lambda df: written.append(df) or df)
    for name in ("sc1_revcomp", "sc12_homopolymer", "sc13_melting_temperature", "sc18_n_gaps", "sc19_effective_length", "sc25_pam_and_type", "fl1_read_qc"):
        assert catalog.queries()[name](spark, sf).count() > 0
    assert not written


def test_spark_views_hold_the_rows_of_the_shared_text(spark, sf):
    t = views.Tables(configure(spark), sf)
    for name in views.SPARK_VIEWS:
        plain = spark.sql(views.VIEWS[name], lineitem=t.lineitem)
        assert plain.exceptAll(t.once(name)).isEmpty() and t.once(name).exceptAll(plain).isEmpty()


def test_melting_temperature_and_gaps_against_plain_text(spark):
    rnd = random.Random(9)
    texts = ["", "ACG", None, "N" * 30, "acgtnnnnnnnnnnacg\nNNNNNNNNNNN", *("".join(rnd.choices("ACGTN", weights=[3, 3, 3, 3, w], k=rnd.randrange(8, 90))) for w in (0, 1, 40) for _ in range(40))]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, s string").select("i", sq.tm_nn("s").alias("tm"), sq.n_gaps("s").alias("g")).collect()
    for r in rows:
        s = texts[r.i]
        if s is None:
            assert r.tm is None and r.g is None
            continue
        assert r.tm == (0.0 if len(s) < 10 else _plain_tm(s.upper()))
        assert [(x.start, x.end) for x in r.g] == [m.span() for m in re.finditer("N{10,}", s.upper())]


def test_mask_and_flanks_compare_positions_once(spark):
    where = spark.createDataFrame([("s0", f"i{i}", "chr1", 5000 + i % 5, 0) for i in range(2000)], "sample string, site_id string, chrom string, pos_5p bigint, pos_3p bigint")
    bed = spark.createDataFrame([("chr1", 4990 + i % 3, 5003, f"m{i}", i) for i in range(2000)], "chrom string, start_pos bigint, end_pos bigint, name string, line_no bigint")
    masked = sites.apply_mask(where, bed)
    assert largest_output(masked) <= 8000
    assert {(r.pos_5p, r.mask_element) for r in masked.collect()} == {(5000 + i, "m1997" if i < 3 else None) for i in range(5)}
    at = where.select("sample", "site_id", F.col("chrom").alias("site_chr"), F.col("pos_5p").alias("site_pos"))
    regions = bed.select("chrom", (F.col("start_pos") + 10).alias("lo"), F.col("end_pos").alias("hi"), (1999 - F.col("line_no")).alias("region_idx"))
    flanked = evidence.site_flanking(at, regions, 1)
    assert largest_output(flanked) <= 8000
    found = {(r.site_id, r.flanking_hit.lo, r.flanking_hit.hi) for r in flanked.collect()}
    assert found == {(f"i{i}", 5000, 5004) for i in range(2000)}


def test_equal_alignments_are_spread_out_once(spark):
    read = ("s", "c", 10, 113, "2S50M2D40M3I8M", "NN" + "ACGTA" * 10 + "CCGGT" * 8 + "TTT" + "ACGTACGT", 3, 60)
    schema = "sample string, chrom string, ref_start long, ref_end long, cigar string, seq string, flag int, mapq int"
    rows = spark.createDataFrame([read] * 300, schema)
    events = ed.pileup_events(rows)
    assert largest_output(events) <= 300
    got = {r.pos: r for r in ed.pileup(events).collect()}
    assert {r.dp for r in got.values()} == {300} and sorted(got) == list(range(11, 111))
    assert got[11]["A"] == 300 and got[61]["DEL"] == 300 and got[63]["C"] == 300 and got[102]["INS"] == 300


def test_page_records_match_each_label_once(spark):
    page = ("<b>Name:</b> m%s<br>Description: d Type: Plant test Target DNA element: g Oligonucleotides: Forward Primer<p>Name: f Sequence: ac gt</p> "
            "Reverse Primer Name: r Sequence: GG-TT Amplicon: Size: 70 bp Sequence: ACGN Documents")
    pages = spark.range(3).select(F.concat(F.lit("QL-EVE-"), "id").alias("method_code"), F.format_string(page, "id").alias("html"))
    pages = pages.withColumn("text", ct.page_text("html"))
    # every copy of the text in a block's expression is evaluated and compiled again
    assert str(ct.extract_block(F.col("page_body"), "A:", ["B:", "C:"])).count("page_body") == 1
    got = ct.method_records(pages).collect()
    assert [(r.method_name, r.description, r.target_name, r.forward_primer_name, r.forward_primer_seq, r.reverse_primer_seq, r.probe_seq, r.amplicon_size, r.amplicon_seq)
            for r in got] == [(f"m{i}", "d", "g", "f", "ACGT", "GGTT", "", "70", "ACGN") for i in range(3)]


def test_equal_inserts_and_mates_are_searched_once(spark):
    rnd = random.Random(5)
    contig, other = ("".join(rnd.choices("ACGT", k=100)) for _ in range(2))
    inserts = spark.createDataFrame([(i, "AC" * 20 + similarity.BORDER_MOTIF * (i % 2)) for i in range(300)], "insert_id int, seq string")
    scanned = []
    scan, similarity.motif_hits = similarity.motif_hits, lambda seqs, *a: (scanned.append(seqs.count()), scan(seqs, *a))[1]
    try:
        got = {r.insert_id: r.n_borders for r in similarity.border_hits(inserts, ["insert_id"]).collect()}
    finally:
        similarity.motif_hits = scan
    assert scanned == [2] and got == {i: 2 * (i % 2) for i in range(300)}
    pairs = spark.createDataFrame([("s", f"q{i}", contig[:60] if i % 2 else other[:60], other[20:80]) for i in range(300)], "sample string, qname string, r1 string, r2 string")
    found = similarity.recruit_pairs(spark.createDataFrame([("s", contig)], "sample string, seq string"), pairs)
    assert largest_output(found) <= 1200
    assert {r.qname for r in found.collect()} == {f"q{i}" for i in range(1, 300, 2)}


def test_equal_reads_are_indexed_once(spark, monkeypatch):
    rnd = random.Random(6)
    text = "".join(rnd.choices("ACGT", k=60))
    seeds = spark.createDataFrame([("s", "a", text[:30])], "sample string, site_id string, seq string")
    pool = spark.createDataFrame([("s", f"r{i}", text[5:55]) for i in range(200)] + [("s", "x", text[8:60])], "sample string, read_id string, seq string")
    written, write = [], similarity.checkpoint

    def counted(df):
        out = write(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(similarity, "checkpoint", counted)
    got = similarity.extend_seeds(seeds, pool).collect()
    # two texts of at most 52 bases; the two hundred equal reads carry the vote
    assert max(written) <= 80 and [(r.seq, r.growth) for r in got] == [(text[:55], 25)]


def test_reads_are_kept_where_they_are(spark):
    """Names decide which reads stay; the reads themselves are not shuffled."""
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        text = "".join(rnd.choices("ACGT", k=30))
        kinds = [[1, 2], [1, 2], [1], [2], [1, 1], [1, 2, 2], [1, 2, 3]][i % 7]
        rows += [(("s0", "s1", None)[i % 17 % 3], f"q{i % 390}" if i % 11 else None, m, text[:19] if (i + m) % 13 == 0 else text[:9] + "N" + text[10:] if (i + m) % 9 == 0 else text)
                 for m in kinds]
    df = spark.createDataFrame(rows, "sample string, qname string, mate int, seq string")
    ok = {m: {(s, q) for s, q, k, t in rows if k == m and len(t) >= 20 and "N" not in t and s and q} for m in (1, 2)}
    flip = str.maketrans("ACGT", "TGCA")
    want = sorted((s, q, m, t.translate(flip)[::-1] if m == 2 else t) for s, q, m, t in rows if (s, q) in ok[1] & ok[2])
    pool = reads.read_pool(df)
    assert sorted(tuple(r) for r in pool.collect()) == want and len(want) > 100
    assert "Exchange hashpartitioning" not in pool._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bits, table, most", [(8, 22, 1 << 30), (2, 6, 1 << 30), (8, 12, 1 << 6)])
def test_known_keys_are_told_apart(spark, monkeypatch, bits, table, most):
    """Tables that most keys meet by chance, or none at all, give the same rows."""
    monkeypatch.setattr(core, "KEY_BITS", bits)
    monkeypatch.setattr(core, "LEAST_BITS", table)
    monkeypatch.setattr(core, "FILTER_BITS", most)
    for share in (0, 3, 60, 100):
        rows = spark.range(500).selectExpr("concat('k', id) AS k", "id % 3 AS x").union(spark.sql("SELECT CAST(NULL AS STRING), 0L"))
        good = F.crc32(F.col("k").cast("binary")) % 100 < share
        known = rows.filter("k IS NOT NULL").select(*core.key_hashes("k", "k"), good.alias("good"))
        got = core.keep_known(rows.withColumn("j", F.col("k")), ["k", "j"], known)
        assert got.columns == ["k", "x", "j"]
        assert sorted(r.k for r in got.collect()) == sorted(r.k for r in rows.filter("k IS NOT NULL").filter(good).collect())


def test_reads_that_come_twice_vote_once(spark):
    """A read under one name counts once, two names of one text twice; sites with equal seeds grow alike, a site with two seeds keeps both."""
    text = "".join(random.Random(8).choices("ACGT", k=60))
    pool = [("s", "a", text[:45]), ("s", "b", text[5:50]), ("s", "b", text[5:50]), ("s", "b", text[5:50])]
    seeds = spark.createDataFrame([("s", "x", text[:30]), ("s", "y", text[:30].lower()), ("s", "z", text[:28]), (None, "n", text[:30]), ("s", "e", None)], "sample string, site_id string, seq string")
    grown = lambda rows: {r.site_id: (r.seq, r.growth) for r in similarity.extend_seeds(seeds, spark.createDataFrame(rows, "sample string, read_id string, seq string")).collect()}
    assert grown(pool) == {"x": (text[:45], 15), "y": (text[:45], 15), "z": (text[:45], 17)}
    assert grown([*pool, ("s", "c", text[5:50])]) == {"x": (text[:50], 20), "y": (text[:50], 20), "z": (text[:50], 22)}

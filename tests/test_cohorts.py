"""Two samples or hosts that share chromosome names and positions never touch each other's rows."""
from sitewright.operators import edits, evidence, reads, reference, sites


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_homology(spark):
    aln = spark.createDataFrame([(s, "q", 1, 0, "chr1", 1000) for s in "AB"], "sample string, qname string, mate int, flag int, chrom string, pos long")
    paf = spark.createDataFrame([("B", "chr1", 900, 1100, 0.99, 0, 200)],
                                "sample string, tname string, tstart long, tend long, identity double, qstart long, qend long")
    assert rows(reads.homology_filter(aln, reads.homologous_regions(paf)), "sample") == [("A",)]
    assert rows(reads.homology_filter(aln, reads.homologous_regions(paf.drop("sample"))), "sample") == []


def test_flanking(spark):
    hits = spark.createDataFrame([("B", "chr1", 99.0, 100, 4000, 0, 100, 5000, 5100, 0)],
                                 "sample string, chrom string, pident double, length long, qlen long, qstart long, qend long, sstart long, send long, region_idx int")
    ins = spark.createDataFrame([("A", "s1", "chr1", 5050), ("B", "s1", "chr1", 5050)], "sample string, site_id string, site_chr string, site_pos long")
    assert rows(evidence.site_flanking(ins, evidence.flanking_regions(hits)), "sample") == [("B",)]


def test_controls(spark):
    cols = "sample string, control_sample string, chrom string, pos long, indel_type string, indel_seq string, ref string, alt string, size int"
    treat = spark.createDataFrame([(s, c, "chr1", 100, "deletion", "ACG", "TACG", "T", 3) for s, c in (("A", "CA"), ("B", "CB"))], cols)
    control = spark.createDataFrame([("CB", "chr1", 100, "deletion", "ACG", "TACG", "T", 3)],
                                    "sample string, chrom string, pos long, indel_type string, indel_seq string, ref string, alt string, size int")
    targets = spark.createDataFrame([("chr1", 0, "on-target", 0, 105)], "chrom string, grna_idx int, site_type string, mismatches int, cut_pos long")
    assert rows(edits.edits_at_targets(treat, control, targets), "sample") == [("A",)]
    assert rows(edits.specific_indels(treat, control), "sample") == [("A",)]
    assert rows(edits.specific_indels(treat.drop("control_sample"), control), "sample") == []
    keyed = targets.selectExpr("'B' AS sample", "*")
    assert rows(edits.edits_at_targets(treat, control.limit(0), keyed), "sample") == [("B",)]


def test_nearest_junction(spark):
    ind = spark.createDataFrame([("A", "chr1", 100), ("B", "chr1", 100)], "sample string, chrom string, pos long")
    junc = spark.createDataFrame([("A", "chr1", 4000000, 2), ("B", "chr1", 110, 1)], "sample string, chrom string, pos long, line_no long")
    assert rows(edits.nearest_junction(ind, junc), "sample", "distance_to_junction") == [("A", 3999900), ("B", 10)]


def test_masks_and_labels(spark):
    hits = spark.createDataFrame([("h1", "chr1", 99.0, 300, 101, 400, "e1"), ("h2", "chr1", 99.0, 300, 301, 600, "e2")],
                                 "host string, chrom string, pident double, length long, sstart long, send long, element string")
    mask = evidence.build_mask(hits)
    assert rows(mask, "host", "start_pos", "end_pos", "name") == [("h1", 100, 400, "e1"), ("h2", 300, 600, "e2")]
    assert len(evidence.build_mask(hits.drop("host")).collect()) == 1
    st = spark.createDataFrame([("A", "s1", "h1", "chr1", 500, 0), ("A", "s2", "h2", "chr1", 500, 0)],
                               "sample string, site_id string, host string, chrom string, pos_5p long, pos_3p long")
    from pyspark.sql import functions as F
    got = sites.apply_mask(st, mask.withColumn("line_no", F.lit(1)))
    assert rows(got.filter("mask_element IS NOT NULL"), "site_id") == [("s2",)]
    labels = sites.host_endogenous(spark.createDataFrame([("h1", "e1", 95.0, 60.0, 1)], "host string, qseqid string, pident double, qcov double, line_no long"))
    elements = spark.createDataFrame([("h1", "e1"), ("h2", "e1")], "host string, qseqid string")
    assert rows(sites.drop_endogenous(elements, labels), "host") == [("h2",)]


def test_reference_and_genes(spark):
    ref = spark.createDataFrame([("h1", "chr1", 0, "A" * 60 + "GG" + "A" * 60), ("h2", "chr1", 0, "T" * 122)], "host string, chrom string, start_pos long, seq string")
    win = spark.createDataFrame([(1, "h1", "chr1", 58, 63), (2, "h2", "chr1", 58, 63)], "w int, host string, chrom string, lo long, hi long")
    assert rows(reference.fetch_ref(win, ref, ["w"]), "w", "ref_seq") == [(1, "AAGGA"), (2, "TTTTT")]
    feats = spark.createDataFrame([("h1", "chr1", "gene", 1, 100, "+", "g1", "", 0), ("h1", "chr1", "CDS", 10, 90, "+", "c1", "g1", 0)],
                                  "host string, chrom string, ftype string, start_pos long, end_pos long, strand string, id string, parent string, phase int")
    pts = spark.createDataFrame([("a", "h1", "chr1", 50), ("b", "h2", "chr1", 50)], "point_id string, host string, chrom string, pos long")
    assert rows(edits.junction_location(pts, feats), "point_id", "location") == [("a", "CDS"), ("b", "intergenic")]
    var = pts.withColumnRenamed("point_id", "var_id")
    assert rows(edits.cds_context(var, feats), "var_id", "gene_id") == [("a", "g1"), ("b", None)]


def test_ranks_of_equal_support(spark):
    """Sites of one support are ranked by id over all ranges, per sample."""
    rows = [(f"s{i % 2}", f"site{(i * 7919) % 3000:05d}", "high", i % 3 == 0, 5, 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "sample string, site_id string, confidence string, has_element_hits boolean, reads_5p int, reads_3p int")
    got = {(r.sample, r.site_id): r.site_rank for r in sites.rank_sites(df).collect()}
    for sample in ("s0", "s1"):
        order = sorted((r for r in rows if r[0] == sample), key=lambda r: (not r[3], r[1]))
        assert [got[sample, r[1]] for r in order] == list(range(1, len(order) + 1))

"""Findings of round 3 on growth: work and memory of one task follow the rows that count."""
import random

from pyspark.sql import functions as F

from sitewright.operators import edits, reference, reports, sites
from test_guides import FLIP, scan


def shuffled(df) -> int:
    """Run ``df`` and return the rows of its largest shuffle."""
    df.collect()
    best, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        metric = node.metrics().get("shuffleRecordsWritten")
        if metric.isDefined():
            best = max(best, metric.get().value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return best


def test_anchor_recall_orders_only_cuts_of_the_truth(spark):
    table = spark.range(3000).select(F.lit("s").alias("sample"), F.concat(F.lit("insertion_chr1_"), F.col("id") + 10000).alias("site_id"), F.lit("UNKNOWN").alias("verdict"))
    # two sites of one id: the smaller verdict counts, whichever comes first
    twins = spark.createDataFrame([("s", "insertion_chr2_5", v) for v in ("FALSE_POSITIVE", "CANDIDATE", "UNKNOWN")], "sample string, site_id string, verdict string")
    truth = spark.createDataFrame([("s", "chr1_1234"), ("s", "chr2_5"), ("s", "chr10"), ("t", "chr1_1"), ("s", "chr1_123456789")], "sample string, anchor string")
    found = reports.anchor_recall(table.unionByName(twins), truth)
    assert shuffled(found) <= 40
    got = {(r["sample"], r["anchor"]): (r["site_id"], r["pass"]) for r in found.collect()}
    assert got == {("s", "chr1_1234"): ("insertion_chr1_12340", False), ("s", "chr2_5"): ("insertion_chr2_5", True), ("s", "chr10"): (None, False),
                   ("t", "chr1_1"): (None, False), ("s", "chr1_123456789"): (None, False)}


def test_pairs_leave_no_group_per_chromosome(spark):
    rnd = random.Random(8)
    tile, rows, want = sites.TILE, [], set()
    for chrom in range(40):
        # around the edge of two tiles, and far from any edge
        spots = sorted(rnd.sample(range(tile - 400, tile + 400), 60) + rnd.sample(range(5000, 9000), 60) + rnd.sample(range(3 * tile - 60, 3 * tile - 20), 12))
        side = {p: rnd.choice(["left", "right"]) for p in spots}
        used = set()
        for p in spots:
            free = [(abs(q - p), q) for q in spots if side[q] == "left" and q not in used and abs(q - p) <= 50]
            if side[p] == "right" and free:
                used.add(min(free)[1])
                want.add((f"c{chrom}", p, min(free)[1]))
        rows += [("s", f"c{chrom}", side[p], p, p, 1) for p in spots]
    frame = spark.createDataFrame(rows, "sample string, chrom string, side string, anchor long, position long, n_reads int")
    found = sites.pair_clusters(frame)
    assert "FlatMapGroups" not in found._jdf.queryExecution().executedPlan().toString()
    got = found.collect()
    assert {(r.chrom, r.r_pos, r.l_pos) for r in got if r.r_pos is not None and r.l_pos is not None} == want
    ends = [(r.chrom, s, p) for r in got for s, p in (("right", r.r_pos), ("left", r.l_pos)) if p is not None]
    assert sorted(ends) == sorted((r[1], r[2], r[3]) for r in rows)
    # null sample and chromosome are a group like any other; an empty table gives nothing
    odd = spark.createDataFrame([(None, None, "right", 10, 10, 1), (None, None, "left", 30, 30, 1)], frame.schema)
    assert [(r.r_pos, r.l_pos) for r in sites.pair_clusters(odd).collect()] == [(10, 30)]
    assert sites.pair_clusters(frame.limit(0)).collect() == []


def test_many_guides_make_few_rows_each(spark):
    rnd = random.Random(9)
    refs = [("h", "chr1", start, 100, "".join(rnd.choices("ACGTN", (20, 20, 20, 20, 1), k=130))) for start in (0, 100)]
    guides = []
    for i in range(400):
        seq, n = rnd.choice(refs)[4], rnd.choice([20, 20, 23, 12])
        at = rnd.randrange(len(seq) - n)
        g = "".join(rnd.choice("ACGT") if rnd.random() < 0.2 else c for c in seq[at:at + n])
        guides.append(("h", i, g if i % 2 else g.translate(FLIP)[::-1]))
    ref = spark.createDataFrame(refs, "host string, chrom string, start_pos long, core_len long, seq string")
    table = spark.createDataFrame(guides, "host string, grna_idx int, guide string")
    cols = ("host", "chrom", "grna_idx", "strand", "t_start", "t_end", "mismatches", "pam_seq")
    for m in (2, 4):
        found = reference.grna_sites(ref, table, m)
        got, want = sorted(tuple(r) for r in found.select(*cols).collect()), scan(refs, guides, m)
        assert got == want and len(got) > 100
    long = reference.grna_sites(ref, table.filter("length(guide) = 20"), 4)
    assert shuffled(long) <= 35 * 2 * 400


def test_codons_come_from_intervals_summed_once_per_gene(spark):
    rnd = random.Random(10)
    text = "".join(rnd.choices("ACGT", k=400))
    spans = {"+": [(21, 40), (61, 64), (90, 131)], "-": [(201, 217), (230, 231), (260, 301)]}
    feats, variants, want = [], [], {}
    for strand, cds in spans.items():
        gene, lo, hi = f"g{strand}", cds[0][0] - 5, cds[-1][1] + 5
        feats += [("c", "gene", lo, hi, strand, 0, gene, ""), ("c", "mRNA", lo, hi, strand, 0, f"m{strand}", gene)]
        feats += [("c", "CDS", s, e, strand, 1, f"x{s}", f"m{strand}") for s, e in cds]
        spots = [p for s, e in cds for p in range(s, e + 1)]
        spots = (spots if strand == "+" else spots[::-1])[1:]
        for k, p in enumerate(spots):
            codon = spots[k - k % 3:k - k % 3 + 3]
            raw = "".join(text[q - 1] for q in codon)
            want[f"{strand}{p}"] = "" if len(codon) < 3 else raw if strand == "+" else raw.translate(FLIP)[::-1]
            variants.append((f"{strand}{p}", "c", p, "A", "snv", 1))
    frame = spark.createDataFrame(variants, "var_id string, chrom string, pos long, alt string, indel_type string, size int")
    table = spark.createDataFrame(feats, "chrom string, ftype string, start_pos long, end_pos long, strand string, phase int, id string, parent string")
    ref = spark.createDataFrame([("c", 0, text[:100]), ("c", 100, text[100:])], "chrom string, start_pos long, seq string")
    found = edits.variant_effect(edits.cds_context(frame, table), ref)
    # intervals are summed with the gene models, not with every variant
    assert "aggregate(" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert {r.var_id: r.codon_ref for r in found.collect()} == want and sum(map(bool, want.values())) > 100

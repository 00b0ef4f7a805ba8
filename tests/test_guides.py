"""Guide targets by pigeonhole seeds against a plain scan."""
import random

from sitewright.operators.reference import grna_sites, seed_deltas

FLIP = str.maketrans("ACGT", "TGCA")


def scan(refs, guides, max_mm):
    out = []
    for host, chrom, start, core, seq in refs:
        for ghost, idx, g in guides:
            if ghost != host:
                continue
            for strand, p in (("+", g), ("-", g.translate(FLIP)[::-1])):
                for i in range(min(len(seq) - len(p) + 1, core)):
                    mm = sum(a != b or a not in "ACGT" for a, b in zip(seq[i:], p))
                    if mm <= max_mm:
                        out.append((host, chrom, idx, strand, start + i, start + i + len(p), mm, seq[i + len(p):i + len(p) + 3] if strand == "+" else seq[max(0, i - 3):i]))
    return sorted(out)


def test_targets_of_two_hosts(spark):
    rnd = random.Random(4)
    refs = [(h, "chr1", start, 300, "".join(rnd.choices("ACGTN", (9, 9, 9, 9, 1), k=330))) for h in ("h1", "h2") for start in (0, 300, 600)]
    guides = []
    for i in range(60):
        host, n = rnd.choice(["h1", "h2"]), rnd.choice([9, 20, 21, 31])
        seq = rnd.choice([r[4] for r in refs if r[0] == host])
        at = rnd.randrange(len(seq) - n)
        g = [rnd.choice("ACGT") if c == "N" or rnd.random() < 0.15 else c for c in seq[at:at + n]]
        g = "".join(g) if i % 2 else "".join(g).translate(FLIP)[::-1]
        guides.append((host, i, g))
    guides.append(("h1", 60, "AC" * 16))  # too long to have targets
    ref = spark.createDataFrame(refs, "host string, chrom string, start_pos long, core_len long, seq string")
    table = spark.createDataFrame(guides, "host string, grna_idx int, guide string")
    cols = ("host", "chrom", "grna_idx", "strand", "t_start", "t_end", "mismatches", "pam_seq")
    for m in (0, 1, 4, 7):
        got = sorted(tuple(r) for r in grna_sites(ref, table.filter("length(guide) > 9" if m > 4 else "true"), m).select(*cols).collect())
        want = scan(refs, [g for g in guides[:60] if m <= 4 or len(g[2]) > 9], m)
        assert got == want and len(got) > 5
    # guides without a host are sought in every host
    both = grna_sites(ref, table.drop("host").limit(5), 2).count()
    assert both == len(scan(refs, [(h, *g[1:]) for g in guides[:5] for h in ("h1", "h2")], 2))
    assert grna_sites(ref, table.limit(0)).collect() == [] and grna_sites(ref.limit(0), table).collect() == []


def test_deltas_reach_every_neighbour_once():
    d = seed_deltas(5, 2)
    assert len(set(d.tolist())) == len(d) == 1 + 5 * 3 + 10 * 9

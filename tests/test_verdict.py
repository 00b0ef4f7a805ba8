"""Verdict table: golden evidence rows and rule order."""
import pytest
from pyspark.sql import functions as F

from sitewright.operators.evidence import VerdictRules, canonical_override, verdict

RULES = VerdictRules(canonical_triplets={"a": {"hLF1", "P-Gt1", "T-nos"}, "default": {"bar", "P-CaMV35S", "T-ocs"}})

# Golden evidence rows
# (element?, host fraction, host bp, largest gap, flank lo-hi, site position, off-target count, construct, combined, verdict)
GOLDEN = """
1 0.874 11688 1024 - 16439674 1 0.102 0.976 CANDIDATE
1 0.600 5000 2000 - 29074002 0 0.050 0.650 CANDIDATE
1 0.300 1500 5000 - 2877409 0 0.100 0.400 CANDIDATE
0 0.960 10922 452 - 13500285 0 0.000 0.960 FALSE_POSITIVE
0 0.198 997 2127 12121778-12123978 12123277 0 0.000 0.198 FALSE_POSITIVE
1 0.000 0 9999 - 29159516 0 0.920 0.920 FALSE_POSITIVE
1 0.190 600 9999 - 21947115 0 0.840 1.000 FALSE_POSITIVE
1 0.460 3000 9999 - 31434949 0 0.480 0.940 FALSE_POSITIVE
0 0.990 18344 100 - 1719289 0 0.000 0.990 FALSE_POSITIVE
0 0.900 8194 303 - 27416138 0 0.000 0.900 FALSE_POSITIVE
0 0.489 1228 1230 - 27546790 0 0.000 0.489 UNKNOWN
0 0.796 4148 809 - 28363144 0 0.000 0.796 UNKNOWN
1 0.032 356 5403 - 6501 1 0.677 0.709 CANDIDATE
1 0.452 5266 6381 - 547982 0 0.058 0.510 CANDIDATE
1 0.022 76 3110 - 75 0 0.465 0.487 CANDIDATE
1 0.000 0 9999 - 8440 0 0.050 0.050 CANDIDATE
1 0.000 0 9999 - 800850 0 0.510 0.510 CANDIDATE
1 0.000 0 9999 - 6663169 0 0.100 0.100 CANDIDATE
1 0.000 0 9999 - 4219576 0 0.607 0.607 CANDIDATE
0 0.993 5398 138 - 1982508 0 0.000 0.993 FALSE_POSITIVE
0 0.917 7492 317 - 362523 0 0.000 0.917 FALSE_POSITIVE
0 0.997 10432 134 - 8069 0 0.000 0.997 FALSE_POSITIVE
1 0.000 0 9999 - 547872 0 0.874 0.874 FALSE_POSITIVE
"""

SCHEMA = ("id int, elements array<string>, host_endogenous_elements array<string>, matched_canonical array<string>, flanking_hit struct<chrom:string,lo:bigint,hi:bigint>, "
          "site_chr string, site_pos bigint, n_off_target int, host_fraction double, largest_gap bigint, construct_frac double, combined_frac double")


def row(i, elements=(), endo=(), flank=None, pos=100, off=0, host=0.0, gap=0, con=0.0, comb=0.0, chrom="c1"):
    return (i, list(elements), list(endo), list(elements), flank, chrom, pos, off, host, gap, con, comb)


def run(spark, rows):
    return {r.id: (r.verdict, r.rule) for r in verdict(spark.createDataFrame(rows, SCHEMA), RULES).collect()}


def test_golden_rows(spark):
    rows, want = [], {}
    for i, line in enumerate(GOLDEN.split("\n")[1:-1]):
        el, host, bp, gap, flank, pos, off, con, comb, label = line.split()
        iv = None if flank == "-" else ("c1", *map(int, flank.split("-")))
        rows.append(row(i, ["node"] if el == "1" else [], (), iv, int(pos), int(off), float(host), int(gap), float(con), float(comb)))
        want[i] = label
    assert {k: v[0] for k, v in run(spark, rows).items()} == want


def test_rule_order_and_edges(spark):
    trio = ["bar", "P-CaMV35S", "T-ocs"]
    rows = [
        row(1, trio, trio, ("c1", 1, 200), off=5, host=0.79, con=0.9, comb=0.99),  # triplet beats everything
        row(2, trio, trio, host=0.80),                                              # host share blocks the triplet
        row(3, ["x"], (), ("c1", 100, 200)), row(4, ["x"], (), ("c1", 101, 200)), row(5, ["x"], (), ("c2", 1, 200)),
        row(6, ["x"], (), ("c2", 1, 200), chrom=""),                                # no site chromosome: interval alone decides
        row(7, ["x"], off=2), row(8, ["x"], off=1), row(9, ["x"], con=0.25, comb=0.85), row(10, ["x"], con=0.2499, comb=0.99),
        row(11, ["x"], host=0.8, gap=499), row(12, ["x"], host=0.8, gap=500), row(13, host=0.85, gap=500, con=0.05), row(14, host=0.85, gap=500, con=0.051),
    ]
    got = run(spark, rows)
    assert [got[i][1] for i in range(1, 15)] == ["1", "1.5", "2", "6", "6", "2", "3", "6", "4", "6", "5", "6", "7", "8"]


def test_override(spark):
    df = spark.createDataFrame([(["bar", "P-CaMV35S", "T-ocs"], 0.5, "FALSE_POSITIVE"), (["bar", "P-CaMV35S", "T-ocs"], 0.8, "FALSE_POSITIVE"), (["bar"], 0.1, "UNKNOWN")],
                               "elements array<string>, host_fraction double, verdict string")
    assert [r.verdict for r in canonical_override(df, RULES).collect()] == ["CANDIDATE", "FALSE_POSITIVE", "UNKNOWN"]

"""Ordered folds and interval helpers against plain-Python models on random data with dense runs."""
import random

import pytest
from pyspark.sql import functions as F

from sitewright.operators import core


def positions(seed, n, span):
    rng = random.Random(seed)
    return sorted({rng.randrange(span) for _ in range(n)})


CASES = [(1, 60, 4000), (2, 400, 900), (3, 30, 90000), (4, 500, 20000), (5, 1500, 3000)]


@pytest.fixture(scope="module")
def points(spark):
    rows = [(f"k{s}", p) for s, n, span in CASES for p in positions(s, n, span)]
    rows += [("even", p) for p in range(0, 2000, 40)]
    return spark.createDataFrame(rows, "k string, pos long").cache(), rows


@pytest.mark.parametrize("tile", [64, 256, 4096])
def test_anchored_clusters(points, tile):
    df, rows = points
    want, last = {}, {}
    for k, p in sorted(rows):
        if k not in last or p - last[k] > 50:
            last[k] = p
        want[(k, p)] = last[k]
    got = {(r.k, r.pos): r.anchor for r in core.anchored_clusters(df, ["k"], "pos", 50, tile).collect()}
    assert got == want


@pytest.mark.parametrize("fan, rounds", [(2, 6), (3, 4), (7, 3)])
def test_tile_maps_are_scanned_in_rounds(points, monkeypatch, fan, rounds):
    monkeypatch.setattr(core, "FAN", fan)
    monkeypatch.setattr(core, "ROUNDS", rounds)
    df, rows = points
    want, last = {}, {}
    for k, p in sorted(rows):
        if p < 4000:
            if k not in last or p - last[k] > 50:
                last[k] = p
            want[(k, p)] = last[k]
    got = {(r.k, r.pos): r.anchor for r in core.anchored_clusters(df.filter("pos < 4000"), ["k"], "pos", 50, 64).collect()}
    assert got == want


def test_states_of_tiles_after_gaps_and_of_several_keys(spark):
    rows = [("a", t, [(i * 3 + t) % 5 for i in range(5)]) for t in (*range(40), *range(45, 90), 1000)] + [("b", 7, [4, 3, 2, 1, 0]), ("b", 8, [1, 1, 1, 1, 1])]
    want, prev = {}, {}
    for k, t, m in sorted(rows):
        slot = prev[k][1] if k in prev and prev[k][0] == t - 1 else 0
        want[(k, t)] = slot
        prev[k] = (t, m[slot])
    df = spark.createDataFrame(rows, "k string, _tile long, _map array<int>")
    got = {(r.k, r._tile): r._slot for r in core.tile_entries(df, ["k"], 5).collect()}
    assert got == want
    assert core.tile_entries(df.limit(0), ["k"], 5).collect() == []


@pytest.mark.parametrize("tile", [64, 1 << 20])
def test_islands(points, tile):
    df, rows = points
    want, prev, start = {}, {}, {}
    for k, p in sorted(rows):
        if k not in prev or p - prev[k] > 20:
            start[k] = p
        prev[k] = p
        want[(k, p)] = start[k]
    got = {(r.k, r.pos): r.island for r in core.islands(df, ["k"], "pos", 20, tile).collect()}
    assert got == want


@pytest.mark.parametrize("tile", [None, 128, 1 << 20])
@pytest.mark.parametrize("adjacent", [False, True])
def test_interval_union(spark, tile, adjacent):
    rng = random.Random(7)
    rows = [("a", s, s + rng.randrange(30)) for s in (rng.randrange(5000) for _ in range(300))]
    rows += [("b", 0, 3000), ("b", 10, 12), ("b", 3001, 3001), ("b", 3003, 3003)]
    want = []
    for k in "ab":
        cur = None
        for _, s, e in sorted(r for r in rows if r[0] == k):
            if cur and s <= cur[2] + (1 if adjacent else 0):
                cur[2] = max(cur[2], e)
            else:
                cur = [k, s, e]
                want.append(cur)
    got = core.interval_union(spark.createDataFrame(rows, "k string, lo long, hi long"), ["k"],
                              adjacent=adjacent, tile=tile).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.mark.parametrize("salts", [1, 3])
def test_bin_join(spark, salts):
    rng = random.Random(3)
    ivs = [(i, s, s + rng.randrange(200)) for i, s in enumerate(rng.randrange(2000) for _ in range(40))]
    reads = [(i, s, s + 60) for i, s in enumerate(rng.randrange(2000) for _ in range(200))]
    l = spark.createDataFrame(reads, "rid int, rs long, re long").withColumn("c", F.lit("x"))
    r = spark.createDataFrame(ivs, "iid int, s long, e long").withColumn("c", F.lit("x"))
    got = core.bin_join(l, r, ["c"], (F.col("rs"), F.col("re")), (F.col("s"), F.col("e")),
                        (F.col("rs") <= F.col("e")) & (F.col("re") >= F.col("s")), width=50, salts=salts)
    want = sorted((a, i) for a, s, e in reads for i, s2, e2 in ivs if s <= e2 and e >= s2)
    assert sorted((x.rid, x.iid) for x in got.collect()) == want


def test_upper_median(spark):
    rng = random.Random(5)
    rows = [(k, rng.randrange(9)) for k in "abc" for _ in range(rng.randrange(1, 12))] + [("d", 1), ("d", 2)]
    df = spark.createDataFrame(rows, "k string, v long")
    want = {k: sorted(v for a, v in rows if a == k)[len([1 for a, _ in rows if a == k]) // 2] for k in "abcd"}
    assert {r.k: r.median for r in core.upper_median(df, ["k"], "v").collect()} == want
    assert {r.k: r.m for r in df.groupBy("k").agg(core.upper_median_agg("v").alias("m")).collect()} == want

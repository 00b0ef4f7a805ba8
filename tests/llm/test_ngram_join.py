import random

import pytest

from sitewright.llm.components import components
from sitewright.llm.ngram_join import join_components
from sitewright.llm.queries import QUERIES


def shingles(text, n):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute(rows, n, percent):
    sets = {}
    for i, t in rows:
        sets.setdefault(i, []).append(shingles(t, n))
    ids = sorted(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = {}
    for i in ids:
        for s in sets[i]:
            for g in s:
                where.setdefault(g, set()).add(i)
    near = {(a, b) for v in where.values() for a in v for b in v if a < b}
    for a, b in near:
        if any(s and 100 * len(s & t) >= percent * len(s | t) for s in sets[a] for t in sets[b]):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def check(df, rows, n, percent, **options):
    want = brute([r for r in rows if r[0] is not None], n, percent)
    got = join_components(df, n=n, percent=percent, **options).collect()
    assert len(got) == len(rows)
    assert sorted(map(str, ((r.doc_id, r.n_shingles) for r in got))) == sorted(map(str, ((i, len(shingles(t, n))) for i, t in rows)))
    for r in got:
        assert r.component_id == (None if r.doc_id is None else want[r.doc_id]), r


def made(seed, groups=40):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    boiler = [rng.choice(words) for _ in range(60)]
    rows, i = [], 10
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.randint(1, 120))]
        for _ in range(rng.choice([1, 1, 2, 3, 9])):
            t = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                t[rng.randrange(len(t))] = rng.choice(words)
            if rng.random() < 0.4:
                t = t + boiler
            rows.append((i, " ".join(t)))
            i += rng.randint(1, 3)
    # a chain in which only neighbours link, and a large group of near copies
    chain = [rng.choice(words) for _ in range(100)]
    for _ in range(15):
        rows.append((i, " ".join(chain)))
        chain[rng.randrange(100)] = rng.choice(words)
        i += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, small, ranked", [(1, 2, 5), (2, 24, 1 << 17), (3, 3, 0)])
def test_equals_all_pairs(spark, seed, small, ranked):
    rows = made(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    check(df, rows, 4, 85, small=small, ranked=ranked)


def test_odd_rows(spark):
    long = "many words in one text " * 3000
    rows = [(None, "a b c d"), (1, None), (2, ""), (3, " \n"), (4, "One two"), (5, "one TWO"), (6, "one two three"), (7, long), (8, long + "x"),
            (9, "a b c d e f"), (9, "a b c d e f"), (11, "q r s t u"), (11, "a b c d e f"), (12, "É b c d e"), (13, "é b c d e")]
    df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in rows], "doc_id long, text string, n int, node double")
    check(df, rows, 5, 80)
    assert join_components(df.limit(0)).collect() == []


def test_whole_table(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    want = brute(rows, 4, 85)
    got = {r.doc_id: r.component_id for r in QUERIES["op1_ngram_join"](spark, sf).collect()}
    assert got == want


def test_components(spark):
    rng = random.Random(3)
    edges = [(a, a + 1) for a in range(50, 90)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(150)] + [(1000, i) for i in range(1, 40)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: find(i) for i in root if any(i in e and e[0] != e[1] for e in edges)}

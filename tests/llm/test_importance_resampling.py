"""Importance resampling against plain counting and sorting, its SQL, and on odd rows."""
import hashlib
import math
import random
import re
import zlib

import duckdb

from sitewright.llm import importance_resampling as ir, sql
from sitewright.llm.queries import QUERIES

WORDS = ["alpha", "Beta", "gamma", "É1", "x9", "delta", "of", "the", "\U0001f600"]


def features(text, longest=2):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    runs = [" ".join(w[i:i + k]) for k in range(1, longest + 1) for i in range(len(w) - k + 1)]
    return len(w), [zlib.crc32(x.encode()) % 10000 for x in runs]


def brute(rows, target):
    s, t = [0] * 10000, [0] * 10000
    for counts, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for f in features(x)[1]:
                counts[f] += 1
    a, b = sum(s), sum(t)
    out = []
    for i, x in rows:
        n, f = features(x)
        g = [math.floor(1000 * math.log((t[k] + 1) * (a + 10000) / ((s[k] + 1) * (b + 10000)))) for k in f]
        weight = sum(g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(able):
        r[4] = k + 1 if k < 25 * len(able) // 100 else None
    return sorted((tuple(r[:4]) + (r[4] if r in able else None,) for r in out), key=repr)


def odd_rows():
    rnd = random.Random(5)
    rows = [(None, None), (1, ""), (2, " .,;\n"), (3, "too few words"), (4, "w " * 20), (5, "long\ttext, " * 40000)]
    rows += [(i if i % 11 else None, " ".join(rnd.choices(WORDS, k=rnd.randrange(10, 60)))) for i in range(10, 300)]
    return rows + [(77, "the same row again " * 8)] * 40 + [(None, "no id for this row at all " * 5)] * 30


def test_odd_rows(spark):
    rows, target = odd_rows(), ["alpha beta gamma", None, "", "É1 x9 x9 \U0001f600"]
    docs = spark.createDataFrame([(i, t, 1, 2, "q") for i, t in rows], "doc_id long, text string, rank int, _id int, score string").repartition(5)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = ir.resample(docs, bench, keep=("doc_id", "rank", "_id", "score"))
    assert got.columns == ["doc_id", "_id", "n_features", "weight", "score", "rank"]
    made = sorted((tuple(r) for r in got.drop("_id").collect()), key=repr)
    assert made == brute(rows, target)
    ranks = sorted(r[4] for r in made if r[4])
    assert ranks == list(range(1, len(ranks) + 1))
    assert ir.resample(docs.limit(0), bench).collect() == []
    assert ir.resample(docs.filter("doc_id < 4"), bench.limit(0)).filter("rank is not null").collect() == []


def test_cutoff_among_ties(spark):
    rows = [(5, i) for i in range(100)] + [(9, 3), (9, 3), (2, 1), (5, None), (5, None)]
    df = spark.createDataFrame(rows, "score long, _id long")
    assert ir.cutoff(df, 1) == (9, 3) and ir.cutoff(df, 2) == (9, 3) and ir.cutoff(df, 3) == (5, 0) and ir.cutoff(df, 102) == (5, 99)
    assert ir.cutoff(df, 103) == (5, None) and ir.cutoff(df, 105)[0] == 2


def test_pieces_give_the_runs_of_the_whole_text():
    for text in (t for _, t in odd_rows()[:60]):
        for longest in (1, 2, 4):
            want = sorted(features(text, longest)[1])
            for piece in (1, 9, 1 << 20):
                if piece > 5 or len(text or "") < 1000:
                    got = list(ir.runs(text, longest, piece))
                    assert sorted(x % 10000 for _, s in got for x in s) == want and sum(n for n, _ in got) == features(text)[0]


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    frame = QUERIES["op13_importance_resampling"](spark, sf)
    cols = sorted(frame.columns)
    got = sorted((tuple(r) for r in frame.select(cols).collect()), key=repr)
    assert got == sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({sql.OP13})").fetchall(), key=repr)

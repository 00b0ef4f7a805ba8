import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from sitewright.llm.suffix_array import sort_positions
from sitewright.llm.suffix_dedup import dedup_digest, deduplicated, whole_characters
from sitewright.llm.queries import QUERIES


def covered(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(hashlib.blake2b(b[i:i + length], digest_size=16).digest() for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        flag = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[hashlib.blake2b(b[i:i + length], digest_size=16).digest()] > 1:
                flag[i:i + length] = True
        out.append(flag)
    return out


def expected(texts, length):
    rows = []
    for t, flag in zip(texts, covered(texts, length)):
        b = np.frombuffer((t or "").encode(), np.uint8)
        edge = np.diff(np.concatenate([[0], flag.astype(np.int8)]))
        rows.append((len(b), int(flag.sum()), int((edge == 1).sum()), hashlib.sha256(b[~flag].tobytes()).hexdigest()))
    return rows


def made(seed):
    rng = random.Random(seed)
    text = lambda n: "".join(rng.choice("abcdéß \n") for _ in range(n))
    shared = [text(90) for _ in range(3)]
    docs = [None, "", "short", "a" * 300, "ab" * 100]
    for _ in range(60):
        t = text(rng.randint(0, 200))
        for s in shared:
            if rng.random() < 0.4:
                cut = rng.randint(0, 60)
                t = t[:len(t) // 2] + s[cut:] + t[len(t) // 2:]
        docs.append(t)
        if rng.random() < 0.2:
            docs.append(t if rng.random() < 0.5 else t[:20] + "X" + t[20:])
    return docs


@pytest.mark.parametrize("seed, frequent, batch", [(1, 3, 300), (2, 1000, 1 << 20), (3, 0, 2000)])
def test_equals_brute_force(spark, seed, frequent, batch):
    texts = made(seed)
    rows = [(i if i else None, t, "k", 1, 2.5) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key string, h1 int, spans double").repartition(4)
    got = {r.doc_id: r for r in dedup_digest(df, length=40, gram=8, frequent=frequent, run=4, batch=batch).collect()}
    assert len(got) == len(texts)
    for (i, *_), want in zip(rows, expected(texts, 40)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want, i
    out = deduplicated(df, length=40, gram=8, frequent=frequent, run=4, batch=batch)
    assert out.columns == df.columns
    left = {r.doc_id: r.text for r in out.collect()}
    for (i, t, *_), flag in zip(rows, covered(texts, 40)):
        if t is None:
            assert left[i] is None
            continue
        at, keep = 0, []
        for c in t:
            n = len(c.encode())
            if not flag[at:at + n].all():
                keep.append(c)
            at += n
        assert left[i] == "".join(keep)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "x" * 10 + "y" * 50), (1, "x" * 10 + "y" * 50), (2, "z" * 5)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_removed) for r in dedup_digest(df, length=40, gram=8).collect())
    assert got == [(1, 60), (1, 60), (2, 0)]
    assert dedup_digest(df.limit(0)).collect() == []


def test_whole_characters():
    assert whole_characters("aéb", [(0, 2)]) == "éb" and whole_characters("aéb", [(0, 3)]) == "b" and whole_characters("", []) == ""


def test_suffix_order():
    rng = np.random.default_rng(0)
    for trial in range(60):
        depth, n = int(rng.integers(1, 40)), 300
        data = rng.integers(97, 97 + int(rng.integers(1, 4)), n).astype(np.uint8)
        if trial % 3 == 0:
            data = np.tile(data[:60], 5)
        wanted = np.flatnonzero(rng.random(n - depth + 1) < 0.6)
        order, lcp = sort_positions(data, wanted, depth)
        s = [data[i:i + depth].tobytes() for i in order]
        assert sorted(order) == wanted.tolist() and s == sorted(s)
        for a, b, c in zip(s, s[1:], lcp[1:]):
            assert a[:c] == b[:c] and (c == depth or a[c] != b[c])


def test_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    want = dict(zip((r.doc_id for r in rows), expected([r.text for r in rows], 400)))
    got = QUERIES["op3_suffix_dedup"](spark, sf).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[r.doc_id]

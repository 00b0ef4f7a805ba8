import numpy as np
import pytest

from sitewright.llm import ann_graph
from sitewright.llm.queries import QUERIES


def brute(rows, queries, k):
    out = {}
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(float)
    for i, v in queries:
        d = np.sqrt(((x - np.array(v, np.float32).astype(float)) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), d[j]) for j in order]
    return out


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect() if r.embedding and any(r.embedding)]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0], 10)
    got = {}
    for r in QUERIES["op9_ann_graph"](spark, sf_dir).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    assert set(got) == set(want)
    hit = 0
    exact = dict()
    for i, best in want.items():
        assert sorted(got[i]) == list(range(1, len(best) + 1))
        hit += len({v for v, _ in best} & {v for v, _ in got[i].values()})
        assert [v for _, v in sorted(got[i].items())] == sorted(got[i].values(), key=lambda p: (p[1], p[0]))
    assert hit / sum(map(len, want.values())) >= 0.95


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (100, [0.0, 2.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]),
            (6, [inf, 1.0]), (7, []), (8, [3.0, 4.0]), (None, [1.0, 1.0]), (200, [5.0, 5.0, 5.0]), (300, [0.0, 0.0])]
    rows += [(1000 + i, [7.0, 7.0]) for i in range(50)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, h int, score int")
    got = ann_graph.search(df, df.filter("vec_id % 100 = 0"), k=3, shard_rows=8).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 4)))
    assert sorted(by[0]) == [(1, 1, 0.0), (2, 100, 2.2361), (3, 8, 4.4721)]
    assert sorted(by[1000]) == [(1, 1001, 0.0), (2, 1002, 0.0), (3, 1003, 0.0)]
    assert 200 not in by and 300 not in by and set(by) == {0, 100, 1000}
    assert ann_graph.search(df.limit(0), df.limit(0)).collect() == []

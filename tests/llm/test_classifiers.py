import zlib

import duckdb
import numpy as np
import pytest

from sitewright.llm import quality_classifier, toxicity
from sitewright.llm.queries import QUERIES

LARGE = "/root/testdata/sf0.1"


def held(doc_id, n, left):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % n == left


@pytest.mark.parametrize("name, label, fold, precision, recall", [
    ("op8_quality_classifier", "quality", (3, 1), 0.98, 0.98), ("op6_toxicity", "toxic", (4, 2), 0.95, 0.75)])
def test_held_out_labels(spark, name, label, fold, precision, recall):
    got = {r.doc_id: r for r in QUERIES[name](spark, LARGE).collect()}
    known = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{LARGE}/labels.parquet'").fetchall())
    assert len(got) == duckdb.sql(f"SELECT count(*) FROM '{LARGE}/documents.parquet'").fetchall()[0][0]
    assert all(r.held_out == held(r.doc_id, *fold) and 0 <= r.score <= 1 for r in got.values())
    pairs = [(known[i], r.predicted) for i, r in got.items() if r.held_out and i in known]
    hit = sum(a == b == 1 for a, b in pairs)
    assert hit / sum(b for _, b in pairs) >= precision and hit / sum(a for a, _ in pairs) >= recall


@pytest.mark.parametrize("module, label", [(quality_classifier, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, module, label):
    texts = [None, "", "  \n", "a", "word " * 30000, "same", "same", "é\U0001f600 | # !"]
    docs = spark.createDataFrame([(i if i else None, t, i, 0.0, "k") for i, t in enumerate(texts)],
                                 "doc_id long, text string, label int, order double, _id string")
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, 0), (6, 1), (7, 0), (8, 1), (None, 1), (9, None), (1, 1)], f"doc_id long, {label} int")
    got = module.score(docs, labels).collect()
    assert len(got) == len(texts) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
    assert len({r.score for r in got if r.doc_id in (5, 6)}) == 1
    assert module.score(docs.limit(0), labels).collect() == []
    if module is quality_classifier:
        assert sorted(map(str, module.accepted(docs, labels).collect())) == sorted(
            str(r) for r, s in zip(docs.collect(), got) if s.predicted)
    bare = module.score(docs, labels.limit(0)).collect()
    assert {r.score for r in bare} == {0.5 if label == "quality" else 0.0}


def test_ranking_prefers_better_documents():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 3))
    y = (x[:, 0] - x[:, 1] + 0.1 * rng.normal(size=400) > -0.8).astype(int)
    m = quality_classifier.fit(x, y, float((y == 0).mean()), pairs=3000)
    assert ((m.margin(x) > 0) == y).mean() > 0.9


def test_l1_keeps_few_weights():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 600)
    examples = [np.unique(np.concatenate([rng.integers(100, 100000, 50), [7] if t else []]).astype(int)) for t in y]
    w, bias = toxicity.ftrl(examples, y.astype(float))
    assert w[7] > 1 and (w != 0).sum() < 400


def test_threshold_covers_all_training_labels(spark):
    rng = np.random.default_rng(3)
    n = 6000
    junk = rng.uniform(0, 0.5, n)
    texts = [" ".join("#|%" if rng.random() < j else f"word{rng.integers(500)}" for _ in range(60)) for j in junk]
    quality = [int(j + rng.normal() * 0.1 < 0.35) for j in junk]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, q in enumerate(quality)], "doc_id long, quality int")
    got = quality_classifier.score(docs, labels, limit=200).collect()
    train = [r for r in got if not held(r.doc_id, 3, 1)]
    assert abs(sum(r.predicted == 0 for r in train) - sum(quality[r.doc_id] == 0 for r in train)) <= len(train) // 500


def test_quantile_cut_narrows_down(spark, monkeypatch):
    monkeypatch.setattr(quality_classifier, "MAX_VALUES", 8)
    rng = np.random.default_rng(4)
    for s in (rng.normal(size=500) ** 3, rng.integers(0, 5, 500).astype(float), np.zeros(500)):
        y = rng.integers(0, 2, 500)
        share, order = float((y == 0).mean()), np.sort(s)
        at = int((y == 0).sum()) - 1
        got = quality_classifier.quantile_cut(spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, s double"), share)
        assert got == pytest.approx((order[at] + order[at + 1]) / 2)

"""Fill-in-the-middle against a loop over matches, its SQL, and on odd rows."""
import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from sitewright.llm import fill_middle, sql
from sitewright.llm.queries import QUERIES

TEXTS = [None, "", "x", "words, more w0rds\nand é ü \U0001f600 end", "has <P> inside", "a<S>", "<M>", "   ", "abc" * 9000 + " z", "one two three " * 3000,
         "\t\x00 tab", "same text", "same text"]


def brute(i, text):
    text = text or ""
    units = [m.group() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", text)]
    x = hashlib.sha256(f"1:{'null' if i is None else i}".encode()).hexdigest()
    h = [int(x[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form = "spm" if h[3] % 100 < 20 else "psm"
    return n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.fixture
def docs(spark):
    rows = [(i if i % 9 else None, t, "x", 1) for i, t in enumerate(TEXTS * 4)]
    return spark.createDataFrame(rows, "doc_id long, text string, form string, _t int").repartition(3)


def test_odd_rows(docs):
    made = fill_middle.transform(docs, keep=("doc_id", "text", "form", "_t")).withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    assert len(made) == 4 * len(TEXTS)
    for r in made:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == brute(r.doc_id, r.text), r
        assert r.back == (r.text or "") and r._t == 1
    assert {r.form for r in made} == {"plain", "psm", "spm"}
    assert fill_middle.transform(docs.limit(0)).collect() == []


def test_stretches_give_the_ends_of_the_whole_text():
    for t in TEXTS[1:]:
        want = [m.end() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", t)]
        assert all(fill_middle.unit_ends(t, k).tolist() == want for k in (1, 7, 1000, 1 << 19))


def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    frame = QUERIES["op11_fill_middle"](spark, sf)
    cols = sorted(frame.columns)
    got = sorted((tuple(r) for r in frame.select(cols).collect()), key=repr)
    assert got == sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({sql.OP11})").fetchall(), key=repr)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "Exchange" not in plan

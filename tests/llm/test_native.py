"""Quality rules and source mixing against their SQL, on the smallest table and on odd rows."""
import duckdb
import pytest
from pyspark.sql import functions as F

from sitewright.llm import mixing, quality_rules, sql
from sitewright.llm.queries import QUERIES

LONG = "some words of a very long text that goes on and on without an end in sight " * 100
ROWS = [(1, None, "en", "a"), (2, "", "en", "b"), (3, " \t\n", None, "b"), (4, "one two three four five six seven eight nine ten eleven", "en", None),
        (5, "a b c d e a b c d e a b c d e f g h", "en", "a"), (5, "a b c d e a b c d e a b c d e f g h", "en", "a"), (None, "x # y | z % " * 6, None, None),
        (7, LONG, "de", "c"), (8, "same line\nsame line\n \nother words in this line to make it ten long\nsame line", "de", "c"), (9, "é" * 40, "fr", "d"),
        (10, "\U0001f600 b\x0bc\x0cd e f g h i j k l", "fr", "d")]
SCHEMA = "doc_id long, text string, lang string, source string"


def key(row):
    return tuple("" if x is None else f"{x:.9g}" if isinstance(x, float) else str(x) for x in row)


def same(con, text, frame):
    want = con.sql(text)
    cols = sorted(want.columns)
    at = [want.columns.index(c) for c in cols]
    assert sorted(frame.columns) == cols
    assert sorted(key(r[c] for c in cols) for r in frame.collect()) == sorted(key(r[i] for i in at) for r in want.fetchall())


@pytest.fixture
def odd(spark, tmp_path):
    df = spark.createDataFrame([(*r, i, 1.5) for i, r in enumerate(ROWS * 6)], SCHEMA + ", size int, n_words double").repartition(4)
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT doc_id, text, lang, source FROM '{tmp_path}/documents.parquet/*.parquet'")
    return spark.read.parquet(f"{tmp_path}/documents.parquet"), con


@pytest.mark.parametrize("name, text", [("op2_quality_rules", sql.OP2), ("op7_mixing", sql.OP7)])
def test_smallest_table(spark, sf, name, text):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    same(con, text, QUERIES[name](spark, sf))


def test_rules_on_odd_rows(odd):
    df, con = odd
    got = quality_rules.judge(df)
    same(con, sql.OP2, got.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))
    assert quality_rules.judge(df.limit(0)).collect() == []


def test_mix_on_odd_rows(odd):
    df, con = odd
    plan = mixing.plan_copies(df)
    assert plan.columns[:4] == ["doc_id", "text", "lang", "source"]
    same(con, sql.OP7, plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")))
    copies = {r.n: r.copies for r in plan.groupBy(F.md5(F.to_json(F.struct("doc_id", "source"))).alias("n")).agg(F.sum("copies").alias("copies")).collect()}
    assert mixing.mixed(df).count() == sum(copies.values())
    assert mixing.mixed(df).columns == df.columns
    assert mixing.plan_copies(df.limit(0)).collect() == []


def test_targets_and_takes(spark):
    rows = [(i, "w " * (1 + i % 40), "x", f"s{i % 7}" if i % 3 else "hot") for i in range(3000)]
    plan = mixing.plan_copies(spark.createDataFrame(rows, SCHEMA))
    got = plan.groupBy("source").agg(F.first("target").alias("t"), F.sum(F.col("size") * F.col("copies")).alias("n"), F.first("source_size").alias("s")).collect()
    assert abs(sum(r.t for r in got) - 1.5 * sum(r.s for r in got)) < 1e-6
    assert all(abs(r.t - r.n) <= 40 and r.t <= 2 * r.s + 1e-9 for r in got)


def test_junk_does_not_widen_its_own_fence(spark):
    """One source in five documents junk: its upper fence is bounded by the fence of all documents."""
    plain, junk = "plain words that say one thing after the other and then come to an end here", "a # b $ c | d & e * f % g < h > i # j $ k | l"
    rows = [(i, f"{plain} {i}", "en", f"s{i % 5}") for i in range(500)] + [(1000 + i, f"{junk} {i}", "en", "s0") for i in range(25)]
    got = {r.doc_id: r.kept for r in quality_rules.judge(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all(kept == (i < 1000) for i, kept in got.items()) and len(got) == 525

from collections import Counter

import duckdb
import numpy as np

import corpus_pipeline
from sitewright.llm import sql
from sitewright.llm.bpe import load_tokenizer
from sitewright.llm.queries import QUERIES, word_bpe
from test_ngram_join import brute
from test_suffix_dedup import covered


def test_stages_against_brute_force(spark, sf, tmp_path):
    docs, before = spark.read.parquet(f"{sf}/documents.parquet"), None
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf)
        if k < 4:
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        before, rows = docs.collect(), out.collect()
        text = {r.doc_id: r.text for r in before}
        if name == "good_documents":
            kept = {r.doc_id for r in QUERIES["op8_quality_classifier"](spark, sf).collect() if r.predicted}
            assert {r.doc_id for r in rows} == kept and all(r.text == text[r.doc_id] for r in rows)
        elif name == "one_of_near_copies":
            root = brute(list(text.items()), 5, 80)
            assert sorted(r.doc_id for r in rows) == sorted(set(root.values())) and all(r.text == text[r.doc_id] for r in rows)
        elif name == "without_repeats":
            want = {}
            for r, flag in zip(before, covered([r.text for r in before], 400)):
                at, left = 0, []
                for c in r.text:
                    n = len(c.encode())
                    if not flag[at:at + n].all():
                        left.append(c)
                    at += n
                want[r.doc_id] = "".join(left)
            assert {r.doc_id: r.text for r in rows} == want and all(r.n_chars == len(r.text) for r in rows)
        elif name == "mixed_sources":
            con = duckdb.connect()
            con.sql(f"CREATE VIEW docs AS SELECT * FROM '{tmp_path}/2/*.parquet'")
            want = dict(con.sql(f"WITH {sql.mixing('docs')} SELECT doc_id, copies FROM mix WHERE copies > 0").fetchall())
            assert Counter(r.doc_id for r in rows) == want
        else:
            tok = load_tokenizer(word_bpe())
            assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in before)
            for r in rows:
                ids = tok.encode(text[r.doc_id], add_special_tokens=False).ids
                assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == tok.decode(ids, skip_special_tokens=False)
        docs = out
    assert corpus_pipeline.run(spark, sf).count() == len(rows)

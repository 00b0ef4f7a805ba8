import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sitewright.llm.bpe import encode, load_tokenizer
from sitewright.llm.queries import QUERIES, word_bpe

TEXTS = [None, "", "  \t\n", "Hello, World's  end  x  y", "a<|endoftext|>b <|startoftext|>", "é Éİ ΣΣ ǅ",
         "don't DON'T 'S 12 3½ ١", "　", "\U0001f600\U0001f600 \x00 \x1f\x85", "word " * 5000, "x" * 30000, "same text", "same text"]


@pytest.mark.parametrize("block", [40, 1 << 20])
def test_equals_library(spark, block):
    rows = [(i if i != 5 else None, t, "x", 1.0) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, block double").repartition(3)
    got = encode(docs, word_bpe(), block=block, parts=7).collect()
    assert len(got) == len(TEXTS)
    tok = load_tokenizer(word_bpe())
    for r in got:
        text = TEXTS[5 if r.doc_id is None else r.doc_id] or ""
        ids = tok.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == tok.decode(ids, skip_special_tokens=False)


def test_empty_table_and_clashing_names(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert encode(docs, word_bpe()).collect() == []
    with pytest.raises(ValueError):
        encode(docs.withColumn("ids", F.lit(1)), word_bpe(), keep=("doc_id", "ids"))


def test_whole_table(spark, sf):
    tok = load_tokenizer(word_bpe())
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op5_bpe"](spark, sf).collect()
    assert {r.doc_id for r in got} == set(text)
    for r in got:
        ids = tok.encode(text[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_a_block_is_taken_piece_by_piece(spark):
    import pyarrow as pa

    from sitewright.llm import bpe

    sizes = [300_000] * 20 + [0, 5_000_000, 10]
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n if n else None for n in sizes])], ["_text"])
    got = list(bpe._pieces([batch], 0, 4 << 20))
    assert [len(t) for _, ts, _ in got for t in ts] == sizes and sum(b.num_rows for b, _, _ in got) == len(sizes)
    assert all(sum(map(len, ts[:-1])) < bpe.PIECE for _, ts, _ in got) and [e for _, _, e in got].count(True) == 2
    rows = [(i, f"w{i % 3} some{i} words " * 18000) for i in range(20)]
    tok = load_tokenizer(word_bpe())
    for r in encode(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), word_bpe()).collect():
        ids = tok.encode(rows[r.doc_id][1], add_special_tokens=False).ids
        assert np.frombuffer(r.ids, "<u4").tolist() == ids and r.decoded == tok.decode(ids, skip_special_tokens=False)

"""Registered queries of the subpackage: each derives the digest columns of its contract from the operator's own result."""
from __future__ import annotations

from pathlib import Path
from typing import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from sitewright.llm import sql
from sitewright.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def wrap(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return wrap


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op2_quality_rules", sql.OP2)
def op2(spark, sf_dir):
    from sitewright.llm.quality_rules import judge

    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_mixing", sql.OP7)
def op7(spark, sf_dir):
    from sitewright.llm.mixing import plan_copies

    return plan_copies(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def word_bpe() -> str:
    """Text of the tokenizer file; the path is the package's own."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        return f.read()


@query("op5_bpe")
def op5(spark, sf_dir):
    from sitewright.llm.bpe import encode

    coded = encode(table(spark, sf_dir, "documents"), word_bpe())
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def held_out(n: int, left: int):
    from sitewright.llm.labels import fold

    return F.coalesce(fold("doc_id", n) == left, F.lit(False)).alias("held_out")


@query("op6_toxicity")
def op6(spark, sf_dir):
    from sitewright.llm.toxicity import score

    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(4, 2), "score", "predicted")


@query("op8_quality_classifier")
def op8(spark, sf_dir):
    from sitewright.llm.quality_classifier import score

    scored = score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", held_out(3, 1), "score", "predicted")


@query("op4_language_crf")
def op4(spark, sf_dir):
    from sitewright.llm.language_crf import identify

    return identify(table(spark, sf_dir, "documents")).select("doc_id", held_out(3, 1), "lang_pred", "score")


@query("op9_ann_graph")
def op9(spark, sf_dir):
    from sitewright.llm.ann_graph import search

    vectors = table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


@query("op1_ngram_join")
def op1(spark, sf_dir):
    from sitewright.llm.ngram_join import join_components

    return join_components(table(spark, sf_dir, "documents"), n=4, percent=85).select("doc_id", "n_shingles", "component_id", "class_id")


@query("op3_suffix_dedup")
def op3(spark, sf_dir):
    from sitewright.llm.suffix_dedup import dedup_digest

    return dedup_digest(table(spark, sf_dir, "documents"))


#: Notices, grants and whole texts of public licenses.
LICENSES = [
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is "
     "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS "
     "FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("apache-2.0-notice", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0-header", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
     "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
     "in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either "
     "express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("mit-notice", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
     "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, "
     "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
     "following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the "
     "Software."),
    ("bsd-grant", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
     "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
     "disclaimer."),
    ("all-rights-reserved", "All rights reserved."),
    ("mit-notice-licensed", "Licensed under the MIT License."),
    ("bsd-2-clause-notice", "Licensed under the BSD 2-Clause License."),
    ("bsd-3-clause-notice", "Licensed under the BSD 3-Clause License."),
    ("isc-notice", "Licensed under the ISC License."),
    ("mpl-2.0-header", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
     "with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("lgpl-2.1-header", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("lgpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("agpl-3.0-header", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public "
     "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("gpl-2.0-header", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
     "as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("epl-2.0-header", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
     "available at https://www.eclipse.org/legal/epl-2.0/"),
    # whole texts, one file each
    *((f"{f.stem.lower()}-text", f.read_text(encoding="utf-8")) for f in sorted((Path(__file__).parent / "licenses").glob("*.txt"))),
]


@query("op10_license_scan")
def op10(spark, sf_dir):
    """One row per document and license it holds."""
    from sitewright.llm.license_scan import scan

    places = scan(table(spark, sf_dir, "documents"), LICENSES)
    return places.groupBy("doc_id", F.col("template").alias("license")).agg(
        F.count(F.lit(1)).alias("n_places"), F.min("first_word").alias("first_word"), F.max("containment").alias("containment"))


@query("op11_fill_middle", sql.OP11)
def op11(spark, sf_dir):
    from sitewright.llm.fill_middle import restored, transform

    made = transform(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


@query("op13_importance_resampling", sql.OP13)
def op13(spark, sf_dir):
    from sitewright.llm.importance_resampling import resample

    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op12_personal_data")
def op12(spark, sf_dir):
    from sitewright.llm.personal_data import KINDS, find, learn

    docs = table(spark, sf_dir, "documents")
    found = find(docs, learn(docs))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    return found.select("doc_id", *((F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("bigint").alias(f"n_{k}") for k in KINDS),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))

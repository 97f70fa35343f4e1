from __future__ import annotations

import corpus_pipeline
from helpers import DOCS
from test_secret_scan import base
from test_simhash import brute_print, classes

from tempora.llm.mixing import mix_sources, quality_weights
from tempora.llm.sentencepiece_fst import load

SF = "/root/testdata/sf0.001"


def test_stage_by_stage_against_brute_force(spark, tmp_path):
    docs, before = spark.read.parquet(f"{SF}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        if name == "mix_sources":
            copies = {r.doc_id: r.copies for r in mix_sources(docs, quality_weights(spark.read.parquet(f"{SF}/labels.parquet"))).collect()}
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        rows = docs.collect()
        ids = [r.doc_id for r in rows]
        if name == "language_id":
            assert sorted(ids) == sorted(i for i, r in before.items() if any(c.isalpha() for c in r.text or ""))
        elif name == "simhash_near_dedup":
            prints = {i: brute_print(r.text) for i, r in before.items()}
            near = [(i, j) for i in prints for j in prints if j < i and (prints[i] ^ prints[j]).bit_count() <= 4]
            assert sorted(ids) == sorted(set(classes(near, prints).values()))
        elif name == "secret_scan":
            assert sorted(ids) == sorted(before)
            assert all((r.text == before[r.doc_id].text) == (not base(before[r.doc_id].text)) and not base(r.text) for r in rows)
        elif name == "mix_sources":
            assert all(ids.count(i) == copies[i] for i in before) and all(r == before[r.doc_id] for r in rows)
        else:
            model = load()
            assert len(rows) == sum(copies.values())
            assert all(r.ids == model.encode(before[r.doc_id].text).tolist() for r in rows)


def test_stages_take_empty_and_odd_tables(spark):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "a", 0), (1, "", "en", "a", 0), (2, "the the", None, None, 7)], DOCS)
    for docs in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, SF).count() >= 0

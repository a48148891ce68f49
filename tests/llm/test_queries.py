"""Registered queries of the subpackage against their SQL, and the pipeline against brute force."""

import hashlib
import os
import sys
import zlib

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from conftest import SF001
from oracle_compare import compare
from streamlens.llm import langid, queries

sys.path.insert(0, os.path.dirname(__file__))

import test_decontaminate  # noqa: E402
import test_lines  # noqa: E402
import test_sigtree  # noqa: E402


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_matches_sql(spark, name):
    ok, message = compare(spark, name, SF001)
    assert ok, message


def test_each_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in queries.QUERIES) == list(range(1, 14))


def brute_pipeline(rows, items):
    """{doc_id: text} of what the first four stages keep."""
    by = {}
    for r in rows:
        if r.text is not None and r.lang is not None and zlib.crc32(str(r.doc_id).encode()) % 3 != 1:
            by.setdefault(r.lang, []).append(langid.letters(r.text))
    profile = []
    for g, texts in by.items():
        profile += [(g, c, k + 1) for k, c in enumerate(langid.ranked(*langid.gram_counts("".join(texts).replace("  ", " ")), 300).tolist())]
    model = langid.Profiles(profile, 300)
    found = {r.doc_id: (r, model.predict(r.text, 40.0)) for r in rows}
    docs = [(i, r.text) for i, (r, p) in found.items() if p[0] != "und" and p[2] <= corpus_pipeline.MOST_DISTANCE]
    gone, _ = test_lines.brute(docs, 0.8)
    cut = {i: set(g) for i, _, g in gone}
    docs = [(i, "\n".join(x for k, x in enumerate(t.split("\n")) if k not in cut[i])) for i, t in docs]
    low = {i: c for i, _, c in test_sigtree.brute(docs)}
    docs = [(i, t) for i, t in docs if low[i] == i]
    bad = {d for d, _ in test_decontaminate.brute(docs, items)}
    return {i: t for i, t in docs if i not in bad}


def test_pipeline_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = brute_pipeline(docs.collect(), items)
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF001).collect()}
    assert got.keys() == want.keys() and 50 < len(got) < 200
    ref = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, t in want.items():
        ids = ref.encode(t, add_special_tokens=False).ids
        assert list(got[i].ids) == ids and got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(ref.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, None, None, None), (9002, "", "en", "s", 0), (None, "The thing and the other.", "en", None, 5), (9003, "12 34", "en", "s", 5)], docs.schema)
    d = docs.limit(20).unionByName(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, SF001)
        assert d.columns == docs.columns
        d = spark.createDataFrame(d.collect(), docs.schema)
    assert {9001, 9002, 9003}.isdisjoint({r.doc_id for r in d.collect()})
    last = corpus_pipeline.STAGES[-1][1](spark, d.unionByName(odd), SF001)
    assert last.where("doc_id = 9001").first().n_tokens == 0
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF001).count() == 0

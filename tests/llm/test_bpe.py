"""Pair-index BPE against the tokenizers library, and its edge cases."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from streamlens.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", "   ", "Hello, World's it's THE\tend\n\n", "a<|endoftext|>b <|startoftext|>", "<|END", "naïve Ünïcode ΣΑΣ İstanbul ǅ ß",
       "é ́x 가", "12345 ½²³ Ⅷ 3.14", "!\x1c! a\x1fb \x85 x　y​z", "\U0001f600\U0001f468‍\U0001f469", "aaaaaaaaaaaaa",
       "'s's't're 'LL", "日本語テキスト", "hello" * 300, "x" * 20000, "﻿ bom", "a­b", "\x00\x01", "don't'd I'm", "_ __a__ a_b"]


@pytest.fixture(scope="module")
def ref():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


def test_matches_library(spark, ref):
    rng = random.Random(5)
    alphabet = "abcdefghij  '’.,\n\t09éßΣ<|>-_!?"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(80))) for _ in range(500)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in bpe.encode(df, PATH, decoded="decoded").collect()}
    for i, t in enumerate(texts):
        want = ref.encode(t, add_special_tokens=False).ids
        assert list(got[i].ids) == want, t
        assert got[i].decoded == ref.decode(want, skip_special_tokens=False)


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (None, "a"), (2, "")], "doc_id long, text string")
    rows = bpe.encode(df, PATH, decoded="back").collect()
    assert sorted((r.doc_id or -1, len(r.ids), r.back) for r in rows) == [(-1, 1, "a</w>"), (-1, 1, "a</w>"), (1, 0, ""), (2, 0, "")]
    assert bpe.encode(df.limit(0), PATH).collect() == []
    again = bpe.decode(bpe.encode(df, PATH), PATH).collect()
    assert sorted(r.decoded for r in again) == ["", "", "a</w>", "a</w>"]


def test_small_cache_gives_the_same(ref):
    import json
    b = bpe.PairIndexBPE(json.load(open(PATH)), most_cached=3)
    for t in ODD:
        assert b.encode_batch([t])[0].tolist() == ref.encode(t, add_special_tokens=False).ids

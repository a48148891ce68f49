"""Prefix-table encoding against the sentencepiece library, and its edge cases."""

import random

import public_tokenizers
import pytest
import sentencepiece

from streamlens.llm import piecetable

PATH = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "  a", "a  b ", "\n", "a\nb", "▁a ▁▁", "é\x00x", "日本語 \U0001d518", "<s>hi</s>", "<0x0A>", "　x \xa0 ", " \t ", " " * 11, " " * 1000 + "x",
       "x" * 5000, "=" * 777, "\U0001f468‍\U0001f469", "don't", "⁇ ⁇", "a" * 63 + "b", "﻿bom", "\x7f\x1f"]


@pytest.fixture(scope="module")
def ref():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def table():
    return piecetable.PrefixTable(piecetable.read_model(PATH))


def random_texts(rng, pieces, count):
    for k in range(count):
        kind = k % 4
        if kind == 0:
            yield "".join(rng.choice("abcdefghij  \n.,'") for _ in range(rng.randrange(60)))
        elif kind == 1:  # pieces side by side, so that merges compete across their borders
            yield "".join(rng.choice(pieces) for _ in range(rng.randrange(1, 12)))
        elif kind == 2:
            yield " " * rng.randrange(80) + rng.choice(["", "x", "the", " \n "]) + " " * rng.randrange(40)
        else:
            yield "".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 0x3000), rng.randrange(0x4E00, 0x9FFF)])) for _ in range(rng.randrange(30)))


def test_matches_library(spark, ref, table):
    texts = ODD + list(random_texts(random.Random(5), list(table.id), 1500))
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = {r.doc_id: r for r in piecetable.encode(df, PATH, decoded="decoded").collect()}
    for i, t in enumerate(texts):
        want = ref.encode(t)
        assert list(got[i].ids) == want, t
        assert got[i].decoded == ref.decode(want)


def test_every_prefix_has_its_own_encoding_in_the_table(ref, table):
    text = "▁unbelievable,▁internationalisation▁▁▁of▁the▁things"
    last = table.last_tokens(text)
    for stop in range(1, len(text) + 1):
        ids, at = [], stop
        while at:
            ids.append(last[at])
            at -= table.size[last[at]]
        assert ids[::-1] == ref.encode(text[1:stop].replace("▁", " ")) or stop == 1


def test_decodes_like_the_library(spark, ref):
    rows = [[1, 264], [264, 1, 264], [0], [264, 0], [243, 160], [243], [300, 243, 300], [28705], [], [2, 28705, 264], [240, 159, 152, 131, 264]]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)] + [(99, None)], "k int, ids array<int>")
    got = {r.k: r.decoded for r in piecetable.decode(df, PATH).collect()}
    assert got == {**{i: ref.decode(r) for i, r in enumerate(rows)}, 99: ""}


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (None, "a"), (None, "a"), (2, "")], "doc_id long, text string")
    rows = piecetable.encode(df, PATH, decoded="back").collect()
    assert sorted((r.doc_id or -1, list(r.ids), r.back) for r in rows) == [(-1, [264], "a"), (-1, [264], "a"), (1, [], ""), (2, [], "")]
    assert piecetable.encode(df.limit(0), PATH).collect() == []
    assert sorted(r.decoded for r in piecetable.decode(piecetable.encode(df, PATH), PATH).collect()) == ["", "", "a", "a"]


def test_very_long_text_without_space(spark, ref):
    text = "xyz" * 200_000 + "日本" * 20_000
    row = piecetable.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), PATH, decoded="back").first()
    assert list(row.ids) == ref.encode(text) and row.back == text


def test_small_caches_give_the_same(ref):
    t = piecetable.PrefixTable(piecetable.read_model(PATH), most_cached=3, longest_cached=2)
    for text in ODD:
        assert t.encode_batch([text])[0].tolist() == ref.encode(text)


def test_other_models_are_refused():
    with pytest.raises(ValueError):
        piecetable.PrefixTable(b"\x12\x02\x18\x01")  # a unigram trainer
    with pytest.raises(ValueError):
        piecetable.PrefixTable(piecetable.read_model(PATH) + b"\x1a\x02\x20\x01")  # extra white space removed


def test_query_matches_library(spark, ref):
    import hashlib

    from conftest import SF001
    from streamlens.llm.queries import QUERIES
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    got = QUERIES["op12_sentencepiece"](spark, SF001).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = ref.encode(docs[r.doc_id])
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(ref.decode(ids).encode()).hexdigest()

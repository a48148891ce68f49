"""Rank-order language profiles: brute force, held-out accuracy, edge cases."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from conftest import SF01
from streamlens.llm import langid, queries


def brute_counts(text):
    c = Counter()
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            g = text[i:i + n]
            if g == " " or (n == 3 and g[1] == " "):
                continue
            code = 0
            for ch in g:
                code = (code << 21) | ord(ch)
            c[code] += 1
    return c


def test_gram_counts_match_brute_force(monkeypatch):
    text = langid.letters("Öl, l'été über 3 Bäume; aa aa aaa zz. " * 5)
    want = brute_counts(text)
    for long in (1 << 20, 7, 3):
        monkeypatch.setattr(langid, "_LONG", long)
        codes, n = langid.gram_counts(text)
        assert {k: v for k, v in zip(codes.tolist(), n.tolist()) if v} == dict(want)


def test_distance_is_out_of_place():
    rows = [("a", ord("x"), 1), ("a", ord("y"), 2), ("b", ord("y"), 1), ("b", ord("q"), 2)]
    p = langid.Profiles(rows, 3)
    d = p.distances("yyx")  # ranks: three most frequent grams by (count, code)
    top = langid.ranked(*langid.gram_counts("yyx"), 3).tolist()
    prof = {"a": {ord("x"): 0, ord("y"): 1}, "b": {ord("y"): 0, ord("q"): 1}}
    for i, g in enumerate("ab"):
        want = sum(abs(r - prof[g][t]) if t in prof[g] else 3 for r, t in enumerate(top)) / (len(top) * 3)
        assert np.isclose(d[i], want)


def test_held_out_accuracy(spark):
    rows = queries.op5_language_id(spark, SF01).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    test = [r for r in rows if r.held_out and lang[r.doc_id]]
    assert len(rows) == len(lang) and len(test) > 200
    assert sum(r.lang_pred == lang[r.doc_id] for r in test) / len(test) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_numerals_are_no_letters(spark):
    """Superscripts, fractions and Roman or circled numerals alone give no language."""
    df = spark.createDataFrame([(1, "the cat", "en"), (2, "²½ ①", None), (3, "Ⅷ ৴", None), (4, "ª x", None)], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.learn_and_identify(df).collect()}
    assert got == {1: "en", 2: "und", 3: "und", 4: "en"}


def test_edges(spark):
    df = spark.createDataFrame([(1, "the cat", "en", "x"), (1, "the cat", "en", "x"), (None, None, None, None), (2, "", "en", "y"),
                                (3, "12 %% 34", "fr", "z"), (4, "le chat " * 4000, "fr", None)],
                               "doc_id long, text string, lang string, score string")
    got = langid.learn_and_identify(df).collect()
    assert sorted((r.doc_id or 0, r.lang_pred) for r in got) == [(0, "und"), (1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "fr")]
    assert langid.learn_and_identify(df.limit(0)).collect() == []
    assert {r.lang_pred for r in langid.learn_and_identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}

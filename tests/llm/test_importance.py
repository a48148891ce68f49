"""Importance resampling against a plain Python version, and its edge cases."""

import hashlib
import math
import random
import re
from zlib import crc32

import pytest

from streamlens.llm import importance

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def runs(text, longest):
    w = WORD.findall((text or "").translate(LOWER))
    return [" ".join(w[i:i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]


def brute(rows, target, buckets=10_000, longest=1, percent=10, least=20, seed=2024):
    bucket = {}

    def of(text):
        return [bucket.setdefault(f, crc32(f.encode()) % buckets) for f in runs(text, longest)]

    s, t = [0] * buckets, [0] * buckets
    for text in rows:
        for b in of(text[1]):
            s[b] += 1
    for text in target:
        for b in of(text):
            t[b] += 1
    big_s, big_t = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        found = of(text)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in found)
        out.append([i, len(found), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(runs(text, 1))])
    able = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:percent * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def texts(rng, count):
    words = ["the", "of", "Grün", "ÄB", "x1", "日本", "İ"] + [f"w{k}" for k in range(300)]
    return [" ,.-\n"[rng.randrange(5)].join(rng.choice(words) + rng.choice(["", ".", "'", " "]) for _ in range(rng.randrange(60))) for _ in range(count)]


def columns(df):
    return sorted(((r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("longest,most_words,most_pairs", [(1, 20_000, 50_000), (1, 3, 1), (2, 50, 40), (3, 5, 2)])
def test_matches_plain_version(spark, longest, most_words, most_pairs):
    rng = random.Random(longest)
    rows = list(enumerate(texts(rng, 150)))
    target = texts(rng, 10)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    model = importance.fit(docs, goal, buckets=500, longest=longest, most_words=most_words, most_pairs=most_pairs)
    assert len(model.head.words) <= most_words and len(model.head.pairs) <= (most_pairs if longest > 1 else 0)
    got = columns(importance.draw(docs, model, percent=30))
    assert got == brute(rows, target, 500, longest, 30)


def test_head_holds_the_frequent_words(spark):
    docs = spark.createDataFrame([(f"common {k} rare{k}",) for k in range(200)], "text string").repartition(4)
    head = importance.learn_head([docs], most_words=10)
    assert head.words[b"common"] == crc32(b"common") and len(head.words) <= 10


def test_edges(spark):
    long = "Word und " * 200_000
    rows = [(1, None), (2, ""), (None, "a b"), (None, "a b"), (3, "..."), (4, long), (4, long), (5, "tie " * 30), (5, "tie " * 30)]
    docs = spark.createDataFrame([(i, t, 1, 2, "clash") for i, t in rows], "doc_id long, text string, rank int, n_words int, other string")
    goal = spark.createDataFrame([("word",), (None,)], "text string")
    got = importance.draw(docs, importance.fit(docs, goal), percent=50)
    assert "other" in got.columns and columns(got) == brute(rows, ["word"], percent=50)
    none = importance.draw(docs.limit(0), importance.fit(docs.limit(0), goal.limit(0)))
    assert none.collect() == []
    blank = importance.draw(docs, importance.fit(docs, goal.limit(0)))
    assert columns(blank) == brute(rows, [])
    with pytest.raises(ValueError):
        importance.fit(docs, goal, longest=0)


def test_resample_returns_the_texts(spark):
    rng = random.Random(9)
    rows = list(enumerate(texts(rng, 120)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    goal = spark.createDataFrame([(t,) for t in texts(rng, 5)], "text string")
    got = importance.resample(docs, goal, percent=20).collect()
    want = [r for r in brute(rows, [r.text for r in goal.collect()], percent=20) if r[4]]
    assert sorted((r.doc_id, r["rank"]) for r in got) == sorted((r[0], r[4]) for r in want)
    assert all(dict(rows)[r.doc_id] == r.text for r in got)

"""Benchmark decontamination against brute force over all windows."""

import random
import re
from collections import Counter

from conftest import SF001
from streamlens.llm import decontaminate, queries


def words(t):
    return re.sub(r"[\s!-/:-@\[-`{-~]+", " ", (t or "").lower()).strip(" ").split(" ") if (t or "").strip() else []


def grams(w):
    k = min(5, len(w))
    return Counter(tuple(w[i:i + k]) for i in range(len(w) - k + 1))


def brute(docs, items, similarity=0.75):
    """{(doc_id, item_id): (similarity, start)} of the best window."""
    out = {}
    own = [(i, [x for x in words(t) if x]) for i, t in items]
    own = [(i, w, grams(w)) for i, w in own if w]
    for d, t in docs:
        w = [x for x in words(t) if x]
        seen = {tuple(w[i:i + k]) for k in (1, 2, 3, 4, 5) for i in range(len(w) - k + 1)}
        for i, iw, ig in own:
            if not any(g in seen for g in ig):
                continue
            for s in range(len(w) - len(iw) + 1):
                wg = grams(w[s:s + len(iw)])
                x = sum((wg & ig).values())
                sim = x / sum((wg | ig).values())
                if sim >= similarity and sim > out.get((d, i), (0,))[0]:
                    out[d, i] = (sim, s)
    return out


def same(rows, want):
    got = {(r.doc_id, r.item_id): (round(r.similarity, 9), r.start) for r in rows}
    assert got == {k: (round(a, 9), b) for k, (a, b) in want.items()} and len(got) == len(rows)


def test_whole_table_matches_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    want = brute(docs, items)
    same(queries.op1_decontamination(spark, SF001).collect(), want)
    assert want


def test_planted_and_edges(spark):
    rng = random.Random(7)
    v = [f"v{i}" for i in range(2000)]
    pick = lambda n: [rng.choice(v) for _ in range(n)]
    items = [(i, " ".join(pick(rng.choice([15, 20, 37, 59, 120])))) for i in range(12)] + [(50, "Two words"), (51, "one"), (52, ""), (53, None), (54, "a a a a a a a a a a")]
    docs = []
    for i in range(80):
        w = list(items[rng.randrange(12)][1].split())
        kind = i % 5
        if kind == 1 and len(w) > 50:
            w[rng.randrange(len(w))] = "zz"
        elif kind == 2:
            w.insert(rng.randrange(len(w)), "zz")
        elif kind == 3:
            h = len(w) // 2
            w = w[h:] + w[:h]
        elif kind == 4:
            w = pick(30)
        docs.append((i, " ".join(pick(rng.randrange(40)) + w + pick(rng.randrange(40)))))
    docs += [(100, None), (101, ""), (None, items[0][1].upper() + "!"), (103, "xx two, WORDS yy"), (104, "a " * 300), (105, "one"), (105, "one"), (106, "v1 " + items[1][1])]
    df = spark.createDataFrame([(*d, "c") for d in docs], "doc_id long, text string, words string")
    it = spark.createDataFrame([(*i, "c") for i in items], "item_id long, text string, size string")
    want = brute(docs, items)
    same(decontaminate.leaks(df, it).collect(), want)
    same(decontaminate.leaks(df, it, most_broadcast=0).collect(), want)
    bad = {d for d, _ in want}
    assert sorted(r.doc_id or -1 for r in decontaminate.clean(df, it).collect()) == sorted(d or -1 for d, _ in docs if d not in bad)
    assert decontaminate.clean(df, it).columns == df.columns
    assert decontaminate.leaks(df.limit(0), it).collect() == []
    assert decontaminate.leaks(df, it.limit(0)).collect() == []


def test_search_finds_all_within_the_radius(spark):
    rng = random.Random(3)
    sign = lambda x: x - (1 << 64) if x >> 63 else x
    items = [(i, 10, rng.getrandbits(64)) for i in range(20)]
    asked = []
    for j in range(200):
        p = rng.choice(items)[2]
        for b in rng.sample(range(64), rng.randrange(20)):
            p ^= 1 << b
        asked.append((j, rng.choice([10, 11]), p))
    a = spark.createDataFrame([(j, n, sign(p)) for j, n, p in asked], "j long, size int, print long")
    i = spark.createDataFrame([(k, n, sign(p)) for k, n, p in items], "key long, size int, print long")
    for radius in (3, 15, 23):
        want = {(j, k) for j, n, p in asked for k, m, q in items if n == m and bin(p ^ q).count("1") <= radius}
        assert {(r.j, r.key) for r in decontaminate.search(a, i, radius).collect()} == want != set()


def brute_short(docs, items):
    """As brute, and for documents shorter than the item the whole as the window."""
    out = brute(docs, items)
    for d, t in docs:
        w = [x for x in words(t) if x]
        for i, it in items:
            own = [x for x in words(it) if x]
            k = min(5, len(own))
            if k <= len(w) < len(own):
                x = sum((grams(w) & grams(own)).values())
                sim = x / (len(w) + len(own) - 2 * (k - 1) - x)
                if sim >= 0.75:
                    out[d, i] = (sim, 0)
    return out


def test_cut_items(spark):
    """Items continued differently at one end, and items less some words with nothing around them."""
    rng = random.Random(17)
    v = [f"{rng.randrange(10**6):x}" for _ in range(3000)]
    pick = lambda n: [rng.choice(v) for _ in range(n)]
    items = [(i, " ".join(pick(n))) for i, n in enumerate([6, 10, 18, 25, 32, 40, 46, 60, 102])]
    docs = []
    for i, t in items:
        w = t.split()
        for k in range(40):
            cut = round((len(w) - 4) / 7) - rng.choice([0, 0, 0, 1])
            docs.append((len(docs), " ".join(pick(rng.randrange(3)) + w[:len(w) - cut] + pick(cut + rng.randrange(9)))))
            docs.append((len(docs), " ".join(pick(cut) + w[cut:])))
        for cut in range(1, max(3, len(w) // 4)):
            docs += [(len(docs), " ".join(w[cut:])), (len(docs) + 1, " ".join(w[:-cut])), (len(docs) + 2, " ".join(w[:5] + w[5 + cut:]))]
    want = brute_short(docs, items)
    short = [d for d, i in want if len(docs[d][1].split()) < len(items[i][1].split())]
    assert len(want) > 300 and len(short) > 30
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    same(decontaminate.leaks(df, it).collect(), want)
    assert {r.doc_id for r in decontaminate.clean(df, it).collect()} == {d for d, _ in docs} - {d for d, _ in want}
    # the fingerprints alone: what they find is right, and they find nearly all item-sized windows
    alone = {(r.doc_id, r.item_id) for r in decontaminate.leaks(df, it, counted=False).collect()}
    whole = {(d, i) for d, i in want if len(docs[d][1].split()) >= len(items[i][1].split())}
    assert alone <= set(want)
    recall = len(alone & whole) / len(whole)
    print(f"recall of the fingerprints alone: {recall:.4f} of {len(whole)}")
    assert recall >= 0.97

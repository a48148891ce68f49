"""Context-tree weighting against a brute-force tree, the base score, edges."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from pyspark.sql import functions as F

from conftest import SF001
from streamlens.llm import chunks, ctw, queries


def lower(t):
    return (t or "").encode().translate(chunks.LOWER)


def decisions(sym):
    out = [(0, int(sym == 256))]
    if sym < 256:
        node = 1
        for j in range(7, -1, -1):
            bit = (sym >> j) & 1
            out.append((node, bit))
            node = node * 2 + bit
    return out


def steps(text, depth):
    seq = [256] * depth + list(text) + [256]
    for i in range(depth, len(seq)):
        for node, bit in decisions(seq[i]):
            yield [(tuple(seq[i - d:i]), node) for d in range(depth + 1)], bit


def brute_model(texts, depth):
    n = defaultdict(lambda: [0, 0])
    kids = defaultdict(set)
    for t in texts:
        for path, bit in steps(t, depth):
            for d, key in enumerate(path):
                n[key][bit] += 1
                if d:
                    kids[path[d - 1]].add(key)

    def pe(key):
        a, b = n[key]
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    pw, beta = {}, {}
    for key in sorted(n, key=lambda k: -len(k[0])):
        if len(key[0]) == depth:
            pw[key] = pe(key)
        else:
            below = sum(pw[c] for c in kids[key])
            top = max(pe(key), below)
            pw[key] = math.log(.5) + top + math.log(math.exp(pe(key) - top) + math.exp(below - top))
            beta[key] = pe(key) - below

    def logp(text):
        total = 0.0
        for path, bit in steps(text, depth):
            seen = [k for k in path if k in n]
            p = 0.5
            for j, key in enumerate(reversed(seen)):
                kt = (n[key][bit] + .5) / (sum(n[key]) + 1)
                if j == 0:
                    p = kt
                else:
                    s = 1 / (1 + math.exp(-beta[key]))
                    p = s * kt + (1 - s) * p
            total += math.log10(p)
        return total
    return logp


def brute_base(rows):
    """Per row (id, text, train): n_tokens, n_known, N, base."""
    c = Counter()
    tok = lambda t: [w for w in re.findall(rb"[^\x20\x09-\x0D]+", lower(t))] + [None]
    for _, t, y in rows:
        if y:
            c.update(tok(t))
    N, V = c.total(), len(c)
    return [(len(tok(t)), sum(c[w] > 0 for w in tok(t)), N, sum(math.log10((c[w] + .1) / (N + .1 * (V + 1))) for w in tok(t))) for _, t, _ in rows]


@pytest.mark.parametrize("depth", [0, 1, 3])
def test_matches_brute_force(spark, depth):
    texts = ["The cat sat. THE CAT", "the dog\tsat  on the mat", "", None, "é ü\x0bz\x1cq", "the cat sat on the dog", "zebra! xylo", "the cat", "the cat", "a" * 3000]
    rows = [(None if i == 4 else i, t, i not in (5, 6, 7)) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, y boolean, chunk string")
    got = sorted(ctw.score(df, F.col("y"), depth=depth, per_chunk=40).collect(), key=lambda r: (r.doc_id is None, r.doc_id))
    logp = brute_model([lower(t) for _, t, y in rows if y], depth)
    want = sorted([(i, *b, logp(lower(t))) for (i, t, _), b in zip(rows, brute_base(rows))], key=lambda r: (r[0] is None, r[0]))
    for g, w in zip(got, want, strict=True):
        assert (g.doc_id, g.n_tokens, g.n_known, g.train_tokens) == w[:4]
        assert g.base_score == pytest.approx(w[4], rel=1e-9) and g.score == pytest.approx(w[5], rel=1e-6)


def test_edges(spark):
    df = spark.createDataFrame([(1, "ab")], "doc_id long, text string")
    r = ctw.score(df, F.lit(False)).collect()[0]
    assert r.score == pytest.approx(-19 * math.log10(2), rel=1e-6) and r.base_score == pytest.approx(0) and (r.n_tokens, r.n_known, r.train_tokens) == (2, 0, 0)
    assert ctw.score(df.limit(0), F.lit(True)).collect() == []


def test_query_base_and_gain(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    rows = sorted((i, t, zlib.crc32(str(i).encode()) % 10 != 0) for i, t in docs)
    got = sorted(queries.op6_ctw(spark, SF001).collect(), key=lambda r: r.doc_id)
    for g, (i, _, y), b in zip(got, rows, brute_base(rows), strict=True):
        assert (g.doc_id, g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (i, not y, *b[:3]) and g.base_score == pytest.approx(b[3], rel=1e-9)
    test = [g for g in got if g.held_out]
    assert len(test) > 10 and all(g.bits_per_byte < 4 for g in test if g.n_tokens > 50)

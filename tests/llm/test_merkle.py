"""Merkle fingerprints: brute-force pairs, likeness, edges."""

import hashlib
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from conftest import SF001
from streamlens.llm import merkle, queries


def digest(text):
    return hashlib.blake2b(text.encode(), digest_size=16).hexdigest()


def pieces(text):
    """Sentences, character by character; long ones cut after chosen words."""
    out, at = [], 0
    while at < len(text):
        end = at
        for wanted in (lambda c: c not in "\n.!?", lambda c: c in ".!?", lambda c: c in " \t"):
            while end < len(text) and wanted(text[end]):
                end += 1
        if end < len(text) and text[end] == "\n":
            end += 1
        s, at = text[at:end], end
        if len(s) > 400:
            start, words = 0, []
            for m in re.finditer(r"\S+\s*", s):
                words.append(m)
                if m.end() - start >= 50 and zlib.crc32(m.group().encode()) % 16 == 0:
                    out.append(s[start:m.end()])
                    start = m.end()
            s = s[start:]
        if s:
            out.append(s)
    return out


def plain_tree(text):
    """(fingerprint, sections of paragraphs of pieces): the same tree, of texts instead of digests."""
    sections, section, paragraph = [], [], []

    def of(p):
        return digest("".join(f"{digest(x)}.{len(x)}" for x in p))

    every = pieces(text)
    for k, s in enumerate(every):
        paragraph.append(s)
        if s.endswith("\n") or k == len(every) - 1:
            section.append(tuple(paragraph))
            blank = s.endswith("\n") and len(paragraph) == 1 and s.isspace()
            if blank or of(paragraph)[-1] in "08" or k == len(every) - 1:
                sections.append(tuple(section))
                section = []
            paragraph = []
    whole = [digest("".join(of(p) for p in ps)) for ps in sections]
    line = [digest("".join(whole))]
    for d, ps in zip(whole, sections):
        line.append("~".join([d[:16], *[of(p)[:16] + "=" + ",".join(f"{digest(x)[:12]}.{len(x)}" for x in p) for p in ps]]))
    return "|".join(line), sections


def plain_likeness(a, b):
    if a == b:
        return 1.0
    total, common = sum(len(x) for s in a + b for p in s for x in p), 0
    for level in range(3):
        both = Counter(a) & Counter(b)
        flat = lambda n, k: len(n) if k == 2 else sum(flat(m, k + 1) for m in n)
        common += sum(flat(n, level) * c for n, c in both.items())
        rest = [list((Counter(x) - both).elements()) for x in (a, b)]
        if level < 2:
            a, b = ([m for n in x for m in n] for x in rest)
    return 2 * common / total


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for k, (i, t) in enumerate(rows):
        t, nxt = t or "", rows[(k + 1) % len(rows)][1] or ""
        n = len(t) // 3
        e = t[:len(t) - n] + nxt[:n]
        (ft, st), (fe, se), (_, sn) = plain_tree(t), plain_tree(e), plain_tree(nxt)
        out.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), ft, fe, plain_likeness(st, se), plain_likeness(st, sn)))
    return out


def same(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, r[3], r[2])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert all(abs(x - y) < 1e-12 for g, w in zip(got, want) for x, y in zip(g[5:], w[5:]))


def test_whole_table_matches_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()]
    got = queries.op9_merkle(spark, SF001).collect()
    same(got, brute(rows))
    assert sum(r.near_edited for r in got) / len(got) > 0.55


def test_edges(spark):
    rows = [(5, "A b. C d.\nE f."), (5, "A b. C d.\nE f."), (5, ""), (None, "x y z w"), (None, None), (-3, None), (2**62, "long. " * 3000), (1, "é\n\nü. " * 9), (0, "ab")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", F.lit("clash"))
    same(merkle.edited_pairs(df).collect(), brute(rows))
    same(merkle.edited_pairs(df.where("doc_id = 0")).collect(), brute([(0, "ab")]))
    assert merkle.edited_pairs(df.limit(0)).collect() == []


def test_tree_and_edits():
    a = "One two. Three four.\nFive six.\n\nSeven eight nine. Ten."
    b = a.replace("Five", "5")
    fa, fb = (merkle.serialise(merkle.tree(t)) for t in (a, b))
    assert merkle.serialise(merkle.parse(fa)) == fa and fa != fb
    assert [a[s:e] for s, e in merkle.edits(fa, fb)] == ["Five six.\n"]
    assert merkle.edits(fa, fa) == [] and merkle.likeness(merkle.tree(a), merkle.tree(a)) == 1
    assert 0.7 < merkle.likeness(merkle.tree(a), merkle.tree(b)) < 1
    assert merkle.likeness(merkle.tree(""), merkle.tree(None)) == 1 and merkle.likeness(merkle.tree("a"), merkle.tree("")) == 0
    assert merkle.tree("a.\nb.")[0] != merkle.tree("a.b.\n")[0]
    long = " ".join(f"w{i}" for i in range(3000))
    assert "".join(merkle._leaves(long)) == long and len(merkle._leaves(long)) > 50

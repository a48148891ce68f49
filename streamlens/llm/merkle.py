"""Document fingerprints: a Merkle tree over sections, paragraphs and sentences.

Leaves are sentences (long ones cut after words chosen by their content), a paragraph is a line,
a section ends at a blank line or after a paragraph whose digest says so, so an edit moves no
border elsewhere. Leaf digest: 128-bit BLAKE2b of the piece and its length; inner digest: that of the children's
whole digests, up to the root. The fingerprint is the tree in one line of text, with the whole root and the
first 64 bits of sections and paragraphs and 48 of leaves::

    root|section~paragraph=leaf.size,leaf.size~paragraph=...|section~...

so equal texts have equal roots and unequal ones unequal roots (but for one pair in 2^128, however short the
texts), and comparing two fingerprints walks down the differing branches only. Likeness: share of characters in subtrees that both have (matched as sections
first, then paragraphs, then leaves), 1 for equal fingerprints, also of two empty texts.

Null text counts as empty. :func:`edited_pairs` gives every document's successor in descending
id order without a global window: id ranges are dealt to buckets, each bucket gets a copy of the
first document of the one after, and one pass over sorted buckets streams the rows (one row is
kept). Ties of the id are ordered by text; null ids come last; repeated rows are successors of
each other. Only ids' quantiles and one id per bucket reach the driver. Text is shuffled once.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm.common import slices

_SENTENCE = re.compile(r"[^\n.!?]*[.!?]*[ \t]*\n?")
_WORD = re.compile(r"\S+\s*")
#: Sentences beyond this many characters are cut after words whose CRC-32 is a multiple of CUT.
LONG_LEAF, CUT = 400, 16

Leaf = tuple[str, int]
Paragraph = tuple[str, list[Leaf]]
Section = tuple[str, list[Paragraph]]
Tree = tuple[str, list[Section]]


#: Hex digits of a leaf's and of an inner node's digest in the fingerprint.
_SHORT, _INNER = 12, 16


def _digest(data: bytes) -> str:
    return hashlib.blake2b(data, digest_size=16).hexdigest()


def _leaves(text: str) -> list[str]:
    out = []
    for s in _SENTENCE.findall(text):
        if len(s) <= LONG_LEAF:
            if s:
                out.append(s)
            continue
        start = at = 0
        for m in _WORD.finditer(s):
            at = m.end()
            if at - start >= LONG_LEAF // 8 and zlib.crc32(m[0].encode()) % CUT == 0:
                out.append(s[start:at])
                start = at
        if start < len(s):
            out.append(s[start:])
    return out


def tree(text: str | None) -> Tree:
    """The Merkle tree of a text."""
    sections: list[Section] = []
    paragraphs: list[Paragraph] = []
    leaves: list[Leaf] = []
    whole: tuple[list[str], list[str], list[str]] = ([], [], [])  # whole digests of sections, paragraphs, leaves

    def close_section() -> None:
        nonlocal paragraphs
        d = _digest("".join(whole[1]).encode())
        whole[1].clear()
        whole[0].append(d)
        sections.append((d[:_INNER], paragraphs))
        paragraphs = []

    def close_paragraph(blank: bool) -> None:
        nonlocal leaves
        # a one-leaf paragraph is digested again, so a level is part of what is hashed
        d = _digest("".join(whole[2]).encode())
        whole[2].clear()
        whole[1].append(d)
        paragraphs.append((d[:_INNER], leaves))
        leaves = []
        if blank or d[-1] in "08":
            close_section()

    for s in _leaves(text or ""):
        d = _digest(s.encode())
        whole[2].append(f"{d}.{len(s)}")
        leaves.append((d[:_SHORT], len(s)))
        if s[-1] == "\n":
            close_paragraph(len(leaves) == 1 and s.isspace())
    if leaves:
        close_paragraph(False)
    if paragraphs:
        close_section()
    return _digest("".join(whole[0]).encode()), sections


def serialise(t: Tree) -> str:
    return "|".join([t[0], *["~".join([s, *[p + "=" + ",".join([f"{d}.{n}" for d, n in leaves]) for p, leaves in ps]]) for s, ps in t[1]]])


def parse(fingerprint: str) -> Tree:
    root, *sections = fingerprint.split("|")
    out: list[Section] = []
    for s in sections:
        d, *ps = s.split("~")
        out.append((d, [(p, [(x, int(n)) for x, n in (y.split(".") for y in rest.split(","))]) for p, rest in (q.split("=") for q in ps)]))
    return root, out


def _size(leaves: list[Leaf]) -> int:
    return sum([n for _, n in leaves])


def _unmatched(a: list, b: list) -> tuple[list, list, list]:
    """Nodes of a and b without a partner of equal digest, and the matched nodes."""
    left = Counter([x[0] for x in a]) & Counter([x[0] for x in b])
    if not left:
        return a, b, []
    rest_a, both, took = [], [], left.copy()
    for x in a:
        if took[x[0]] > 0:
            took[x[0]] -= 1
            both.append(x)
        else:
            rest_a.append(x)
    rest_b = []
    for x in b:
        if left[x[0]] > 0:
            left[x[0]] -= 1
        else:
            rest_b.append(x)
    return rest_a, rest_b, both


def likeness(a: Tree, b: Tree) -> float:
    """Twice the characters in common subtrees over the characters of both."""
    if a[0] == b[0]:
        return 1.0
    size = lambda t: sum([_size(l) for _, ps in t[1] for _, l in ps])
    total = size(a) + size(b)
    sa, sb, both = _unmatched(a[1], b[1])
    common = sum([_size(l) for _, ps in both for _, l in ps])
    pa_, pb, both = _unmatched([p for _, ps in sa for p in ps], [p for _, ps in sb for p in ps])
    common += sum([_size(l) for _, l in both])
    _, _, both = _unmatched([x for _, l in pa_ for x in l], [x for _, l in pb for x in l])
    return 2 * (common + _size(both)) / total


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Character ranges of the first fingerprint's text in leaves that the second lacks."""
    ta, tb = parse(a), parse(b)
    if ta[0] == tb[0]:
        return []
    known = [Counter(), Counter(), Counter()]
    for s, ps in tb[1]:
        known[0][s] += 1
        for p, leaves in ps:
            known[1][p] += 1
            known[2].update([d for d, _ in leaves])
    out: list[tuple[int, int]] = []
    at = 0
    for s, ps in ta[1]:
        for p, leaves in ps:
            for d, n in leaves:
                if not (known[0][s] or known[1][p] or known[2][d]):
                    if out and out[-1][1] == at:
                        out[-1] = (out[-1][0], at + n)
                    else:
                        out.append((at, at + n))
                at += n
    return out


def fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``df`` with the fingerprint of ``text`` (null: that of the empty text)."""
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: serialise(tree(t)))
    return df.withColumn(out, run(F.col(text)))


_PAIRS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
          ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
_PAIRS_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                 "near_edited double, near_next double")


def edited_pairs(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: the fingerprint of its text and of its edited text (the last third of its
    characters replaced by the start of the next document in descending id order, the last
    document being followed by the first), and the likeness to both. Input columns other than the
    two named are not read. An empty table gives no rows."""
    spark = df.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    probs = [i / n for i in range(1, n)]
    bounds = np.unique(np.array(docs.select("doc_id").approxQuantile("doc_id", probs, 1 / (4 * n)) if probs else [], "float64")).astype("int64")

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy("int64"), side="right")).astype("int32")

    last = len(bounds) + 1  # null ids
    bucket = F.when(F.col("doc_id").isNull(), F.lit(last)).otherwise(range_of(F.coalesce("doc_id", F.lit(0))))
    dealt = docs.withColumn("bucket", bucket)
    # the first row of each bucket: its largest id, and the smallest text among ties
    firsts = sorted((r.bucket, r.top) for r in docs.select("doc_id").withColumn("bucket", bucket).groupBy("bucket").agg(F.max("doc_id").alias("top")).collect())
    before = {top: firsts[i - 1][0] for i, (_, top) in enumerate(firsts)}
    table = spark.createDataFrame([(top, b) for top, b in before.items()], "top long, bucket int")
    heads = docs.join(F.broadcast(table), F.col("doc_id").eqNullSafe(F.col("top"))).drop("top")
    both = dealt.select("bucket", F.lit(0).alias("copy"), "doc_id", "text").unionByName(
        heads.select("bucket", F.lit(1).alias("copy"), "doc_id", "text"))
    parted = both.repartition(n, "bucket").sortWithinPartitions("bucket", "copy", F.desc_nulls_last("doc_id"), "text")

    names, types = zip(*_PAIRS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # (bucket, doc_id, text, tree) of the row that waits for its successor
        out: list[tuple] = []

        def close(nxt: str, nxt_tree: Tree) -> None:
            _, i, t, own = held
            k = len(t) // 3
            edited = t[:len(t) - k] + nxt[:k]
            e = tree(edited) if k else own
            out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), serialise(own), serialise(e), likeness(own, e), likeness(own, nxt_tree)))

        for b in slices(batches, "text", 8 << 20):
            for bk, copy, i, t in zip(*[c.to_pylist() for c in b.columns]):
                if held and held[0] == bk:
                    own = tree(t)
                    close(t, own)
                    held = None if copy else (bk, i, t, own)
                elif not copy:
                    held = (bk, i, t, tree(t))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)
                out.clear()

    return parted.mapInArrow(run, _PAIRS_SCHEMA)

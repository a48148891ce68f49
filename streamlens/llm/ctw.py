"""Language-model scoring by context-tree weighting over bytes.

A text is its lower-cased (A-Z) UTF-8 bytes and an end symbol. Each symbol is decomposed into binary
decisions: whether the text ends, then the eight bits of the byte. A decision is made in the context
of the ``depth`` symbols before (the start counts as end symbols). For every context of 0 to ``depth``
symbols and every decision the training counts give a Krichevsky-Trofimov estimate; context-tree
weighting mixes the estimates of all depths::

    Pw(s) = 1/2 Pe(s) + 1/2 prod Pw(children of s),   at the full depth Pw = Pe

and the frozen tree predicts with b = Pe / prod Pw(children): p = (b KT + p(child)) / (b + 1); a context
that training lacks predicts as its longest suffix that it has. The code length per byte follows.

How the work is spread: documents are dealt by hash to chunks of bounded size. A chunk lists its distinct
contexts-with-symbol (grams) and words with their training counts, packed per hash bucket and compressed;
buckets add them up. A bucket holds all grams that end in the same two context symbols, so it builds the
levels from the full depth up to two by itself; the two levels above (at most 257 x 256 and 256 nodes) are
summed by Spark, and their predictions, of that bounded size, are broadcast. Buckets give each gram its
log-probability once and answer each chunk with the values of its own
grams and words only, so neither model nor vocabulary has to fit into one task or the driver. Frequent
words and grams reach a bucket once per chunk, not once per occurrence. Words are told apart by 64-bit hashes.

Null text counts as empty. Repeated rows are each trained on and scored. Input columns other than the two
named are not read. Without training documents every decision costs one bit.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm.chunks import batch, by_bucket, chunked, distinct, documents, grouped, mix, pack_sorted, pieces, squeeze, unpack_sorted, unsqueeze, word_codes
from streamlens.llm.common import parts_for, written

END = 256
_BASE = 512  # a symbol takes nine bits of a gram's code
_END_TOKEN = 0  # the code of the end among the words' hashes; no word has it


def gram_codes(texts: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all symbols with their contexts, text after text, and the number of each text's symbols."""
    sizes = np.array([len(t) + 1 for t in texts], "int64")
    total = int(sizes.sum()) + depth * (len(texts) + 1)
    sym = np.full(total, END, "int64")
    at = depth
    real = np.zeros(total, bool)
    for t in texts:
        sym[at:at + len(t)] = np.frombuffer(t, "uint8")
        real[at:at + len(t) + 1] = True
        at += len(t) + 1 + depth
    code = sym.copy()
    for j in range(1, depth + 1):
        code[j:] += sym[:-j] << (9 * j)
    return code[real], sizes


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes of some (codes, counts), and the sums of their counts."""
    codes = np.concatenate([np.zeros(0, "int64"), *[p[0] for p in parts]])
    n = np.concatenate([np.zeros(0, "int64"), *[p[1] for p in parts]])
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, "int64")
    return codes[first], np.add.reduceat(n, first).astype("int64") if len(first) else n


_GRAMS, _WORDS = 0, 1
_ASK = [("bucket", pa.int32()), ("kind", pa.int32()), ("chunk", pa.int32()), ("tokens", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())]
_ASK_SCHEMA = "bucket int, kind int, chunk int, tokens long, keys binary, counts binary"


def _spread(codes: np.ndarray, depth: int) -> np.ndarray:
    """Hashes that deal grams to buckets: by their last two context symbols; all together without two."""
    return mix(_cut(codes, 2) >> 9) if depth >= 2 else np.zeros(len(codes), "uint64")


def _gather(rows: list[tuple], chunk: int, depth: int, buckets: int) -> Iterator[tuple]:
    """What a chunk asks of each bucket: its distinct grams and words, with their training counts."""
    _, train, texts = documents(rows)
    grams, words = [], []
    for y in (1, 0):
        own = [t for t, z in zip(texts, train) if bool(z) == bool(y)]
        for s, e in pieces(own):
            for found, codes in ((grams, gram_codes(own[s:e], depth)[0]), (words, word_codes(own[s:e])[0])):
                keys, n = distinct(codes)
                found.append((keys, n * y))
        words.append((np.array([_END_TOKEN]), np.array([len(own) * y])))
    codes, n = _merged(grams)
    for b, at in enumerate(by_bucket(_spread(codes, depth), buckets)):
        if len(at):
            yield b, _GRAMS, chunk, 0, pack_sorted(codes[at]), squeeze(n[at].tobytes())
    words, n = _merged(words)
    tokens = int(n.sum())
    for b, at in enumerate(by_bucket(words.view("uint64"), buckets)):
        if len(at):
            yield b, _WORDS, chunk, tokens, pack_sorted(words[at]), squeeze(n[at].tobytes())
            tokens = 0  # counted once


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Natural log of the gamma function for x > 0, by Stirling's series after a shift of eight."""
    shift = x.copy()
    for i in range(1, 8):
        shift *= x + i
    z = x + 8
    return (z - 0.5) * np.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5) - np.log(shift)


def _estimate(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """Natural log of the Krichevsky-Trofimov estimate of n0 zeros and n1 ones."""
    return _log_gamma(n0 + 0.5) + _log_gamma(n1 + 0.5) - _log_gamma(n0 + n1 + 1) - math.log(math.pi)


def decisions(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram index, key, bit) of all decisions of the grams; a key is ctx * 512 + node. Node 0 asks for the
    end, nodes 1 to 255 are the inner nodes of a byte's binary tree."""
    ctx, sym = codes & ~np.int64(_BASE - 1), codes & (_BASE - 1)
    at = np.arange(len(codes))
    inner = np.flatnonzero(sym != END)
    which, keys, bits = [at], [ctx], [(sym == END).astype("int64")]
    for j in range(8):
        which.append(inner)
        keys.append(ctx[inner] | ((sym[inner] | 256) >> (8 - j)))
        bits.append((sym[inner] >> (7 - j)) & 1)
    return np.concatenate(which), np.concatenate(keys), np.concatenate(bits)


class Level:
    """The nodes of one depth: sorted keys, counts, log Pw, log of b = Pe / (product of the children's Pw)."""

    def __init__(self, keys: np.ndarray, n0: np.ndarray, n1: np.ndarray, below: np.ndarray | None):
        self.keys, self.n0, self.n1 = keys, n0, n1
        pe = _estimate(n0, n1)
        if below is None:
            self.pw, self.log_b = pe, np.zeros(len(keys))
        else:
            most, least = np.maximum(pe, below), np.minimum(pe, below)
            self.pw = math.log(0.5) + most + np.log1p(np.exp(least - most))
            self.log_b = pe - below
        self.seen = n0 + n1 > 0
        self.kt = (n1 + 0.5) / (n0 + n1 + 1)

    def above(self, depth: int) -> Level:
        """The level of contexts cut to ``depth`` symbols."""
        short = _cut(self.keys, depth)
        keys, at = np.unique(short, return_inverse=True)
        add = lambda x: np.bincount(at, x, len(keys))
        return Level(keys, add(self.n0), add(self.n1), add(self.pw))


def _cut(keys: np.ndarray, depth: int) -> np.ndarray:
    """Keys with their contexts cut to the last ``depth`` symbols."""
    return keys & ((1 << (9 * (depth + 1))) - 1)


def build(codes: np.ndarray, n: np.ndarray, depth: int, down_to: int) -> list[Level]:
    """Levels ``depth`` to ``down_to`` over the grams (n = 0 for grams that training lacks)."""
    which, key, bit = decisions(codes)
    count = n[which].astype("float64")
    keys, at = np.unique(key, return_inverse=True)
    levels = [Level(keys, np.bincount(at, count * (1 - bit), len(keys)), np.bincount(at, count * bit, len(keys)), None)]
    for d in range(depth - 1, down_to - 1, -1):
        levels.append(levels[-1].above(d))
    return levels


#: What a prediction carries downwards: the sum so far, the share left, and the node to fall back on.
Carried = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # keys, done, left, kt, log_b


def top(level: Level) -> Carried:
    n = len(level.keys)
    return level.keys, np.zeros(n), np.ones(n), np.where(level.seen, level.kt, 0.5), level.log_b


def down(up: Carried, level: Level, depth: int) -> Carried:
    """The predictions of a level (contexts of ``depth`` symbols) from those one symbol shorter."""
    keys, done, left, kt, log_b = (x[np.searchsorted(up[0], _cut(level.keys, depth - 1))] for x in up)
    with np.errstate(over="ignore"):
        share = 1 / (1 + np.exp(-log_b))  # b / (b + 1) of the context one shorter
    seen = level.seen
    return (level.keys, np.where(seen, done + left * share * kt, done), np.where(seen, left * (1 - share), left),
            np.where(seen, level.kt, kt), np.where(seen, level.log_b, log_b))


def gram_logs(codes: np.ndarray, n: np.ndarray, depth: int, shared: Carried | None, below: int) -> np.ndarray:
    """log10 probability of each gram's symbol after its context; ``shared`` are the predictions of the
    contexts of ``below - 1`` symbols, over all grams (None: there are none above level 0)."""
    levels = build(codes, n, depth, below)[::-1]
    now = top(levels[0]) if shared is None else down(shared, levels[0], below)
    for d, level in enumerate(levels[1:], below + 1):
        now = down(now, level, d)
    keys, done, left, kt, _ = now
    which, key, bit = decisions(codes)
    p = (done + left * kt)[np.searchsorted(keys, key)]
    return np.bincount(which, np.log10(np.where(bit == 1, p, 1 - p)), len(codes))


_ANSWER = [("chunk", pa.int32()), ("kind", pa.int32()), ("bucket", pa.int32()), ("words", pa.int64()), ("data", pa.binary())]
_SCORES = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("log_counts", pa.float64()), ("score", pa.float64()), ("n_bytes", pa.int64())]


def _summed(rows: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a bucket and their training counts, from rows (keys, counts)."""
    return _merged([(unpack_sorted(r[0]), np.frombuffer(unsqueeze(r[1]), "int64")) for r in rows])


def _shared_levels(asked: DataFrame, depth: int, buckets: int) -> Carried | None:
    """The predictions of contexts of one symbol (at most 257 x 256 rows), over all grams. Buckets, which
    hold all grams that end in the same two context symbols, send the nodes of that level."""
    if depth < 2:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches):
            level = build(*_summed([r[1:] for r in rows]), depth, 2)[-1]
            yield pa.RecordBatch.from_arrays([pa.array(_cut(level.keys, 1)), pa.array(level.n0), pa.array(level.n1), pa.array(level.pw)], names=["key", "n0", "n1", "pw"])

    grams = asked.where(F.col("kind") == _GRAMS).select("bucket", "keys", "counts").repartition(buckets, "bucket").sortWithinPartitions("bucket")
    nodes = grams.mapInArrow(run, "key long, n0 double, n1 double, pw double")
    rows = nodes.groupBy("key").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("pw").alias("pw")).orderBy("key").toArrow()
    one = Level(*[rows[c].to_numpy() for c in ("key", "n0", "n1", "pw")])
    return down(top(one.above(0)), one, 1)


def _answered(asked: DataFrame, shared: Carried | None, depth: int, buckets: int) -> DataFrame:
    """Rows (chunk, kind, bucket, words, data): the values of the keys that a chunk asked a bucket for, in
    their order; the sum of ``words`` is the number of distinct training words."""
    known = asked.sparkSession.sparkContext.broadcast(shared)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in grouped(batches):
            for kind in (_GRAMS, _WORDS):
                mine = [r for r in rows if r[1] == kind]
                if not mine:
                    continue
                codes, n = _summed([r[4:6] for r in mine])
                told = 0
                if kind == _GRAMS:
                    n = gram_logs(codes, n, depth, known.value, 2 if known.value is not None else 0).astype("float32")
                else:
                    told = int((n > 0).sum())
                for r in mine:
                    yield batch([(r[2], kind, bucket, told, squeeze(n[np.searchsorted(codes, unpack_sorted(r[4]))].tobytes()))], _ANSWER)
                    told = 0  # once per bucket

    dealt = asked.repartition(buckets, "bucket").sortWithinPartitions("bucket", "kind")
    return dealt.mapInArrow(answer, "chunk int, kind int, bucket int, words long, data binary")


def _score_chunk(packed: list[tuple], answers: list[tuple], depth: int, buckets: int) -> list[tuple]:
    ids, _, texts = documents(packed)
    kinds: dict[int, dict[int, bytes]] = {_GRAMS: {}, _WORDS: {}}
    for kind, bucket, data in answers:
        kinds[kind][bucket] = data

    def table(keys: np.ndarray, kind: int, hashes: np.ndarray, dtype: str) -> np.ndarray:
        """What the buckets told about sorted keys."""
        value = np.empty(len(keys), dtype)
        for b, at in enumerate(by_bucket(hashes, buckets)):
            if len(at):
                value[at] = np.frombuffer(unsqueeze(kinds[kind][b]), dtype)
        return value

    ranges = list(pieces(texts))
    found = []
    for s, e in ranges:
        codes, sizes = gram_codes(texts[s:e], depth)
        place, keys = pd.factorize(codes)
        found.append((place.astype("int32"), keys, sizes))
    keys = distinct(np.concatenate([np.zeros(0, "int64"), *[f[1] for f in found]]))[0]
    logs = table(keys, _GRAMS, _spread(keys, depth), "float32").astype("float64")
    total = [np.add.reduceat(logs[np.searchsorted(keys, own)][place], np.cumsum(sizes) - sizes) for place, own, sizes in found]
    total = np.concatenate([np.zeros(0), *total])
    del found
    words, n = word_codes(texts)
    keys = distinct(np.append(words, _END_TOKEN))[0]  # the end of a text is one more token of each
    count = table(keys, _WORDS, keys.view("uint64"), "int64")
    doc = np.repeat(np.arange(len(texts)), n)
    of = count[np.searchsorted(keys, words)]
    end = int(count[np.searchsorted(keys, _END_TOKEN)])
    known = np.bincount(doc, of > 0, len(texts)).astype("int64") + int(end > 0)
    base = np.bincount(doc, np.log10(of + 0.1), len(texts)) + math.log10(end + 0.1)
    return [(i, k + 1, x, y, z, len(t)) for i, k, x, y, z, t in zip(ids, n.tolist(), known.tolist(), base.tolist(), total.tolist(), texts)]


def score(df: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", depth: int = 5, per_chunk: int = 12 << 20) -> DataFrame:
    """Rows (doc_id, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte) for every row of
    ``df``, the model learned from the rows where ``train`` holds: ``score`` is the tree's log10 probability
    of the text, ``base_score`` that of its words and the end under smoothed word counts."""
    if not 0 <= depth <= 6:
        raise ValueError("depth must be between 0 and 6")
    docs = df.select(F.col(doc_id).cast("long").alias("id"), train.cast("long").alias("tag"), F.col(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = buckets = parts_for(total, per_chunk)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in grouped(batches):
            for x in _gather([r[1:] for r in rows], chunk, depth, buckets):
                yield batch([x], _ASK)

    packed = chunked(docs, chunks)
    asked = written(packed.repartition(chunks, "chunk").sortWithinPartitions("chunk").mapInArrow(gather, _ASK_SCHEMA), "ctw-asked")

    answers = written(_answered(asked, _shared_levels(asked, depth, buckets), depth, buckets), "ctw-answers")
    tokens = asked.where(F.col("kind") == _WORDS).agg(F.sum("tokens")).first()[0] or 0
    known = answers.agg(F.sum("words")).first()[0] or 0
    found = _finished(packed, answers, chunks, depth, buckets)
    base = F.col("log_counts") - F.col("n_tokens") * math.log10(tokens + 0.1 * (known + 1))
    bits = -F.col("score") * math.log2(10) / F.greatest("n_bytes", F.lit(1))
    return found.select("doc_id", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), base.alias("base_score"), "score", bits.alias("bits_per_byte"))


def _finished(packed: DataFrame, answers: DataFrame, chunks: int, depth: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in grouped(batches):
            told = [(r[1], r[2], r[6]) for r in rows if r[1] >= 0]
            yield batch(_score_chunk([r[3:7] for r in rows if r[1] < 0], told, depth, buckets), _SCORES)

    empty = F.lit(None).cast("binary")
    both = packed.select("chunk", F.lit(-1).alias("kind"), F.lit(-1).alias("bucket"), "ids", "tags", "sizes", "data").unionByName(
        answers.select("chunk", "kind", "bucket", empty.alias("ids"), empty.alias("tags"), empty.alias("sizes"), "data"))
    dealt = both.repartition(chunks, "chunk").sortWithinPartitions("chunk", "kind")
    return dealt.mapInArrow(run, "doc_id long, n_tokens long, n_known long, log_counts double, score double, n_bytes long")

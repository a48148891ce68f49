"""Importance resampling towards a target distribution, over hashed n-grams with a head-tail vocabulary.

Features of a text are its runs of 1 to ``longest`` consecutive words, repeats counted; a feature's bucket is
the CRC-32 of its words joined by a space, modulo ``buckets``. A bucket's gain is the log-ratio of its share
in the target texts and in all documents; a document's weight is the sum of gains of its features. Weight
plus Gumbel noise from a digest of the id is its score, and the highest scores are drawn: a sample without
replacement in proportion to exp(weight / 1000).

The head of the vocabulary is broadcast: the exact CRC states of the frequent words, from which the CRC of
a pair goes on, and the buckets of the frequent pairs. Words and pairs of the tail take the direct CRC. Both
feed the same exact totals, so what the head holds changes the cost and never a result. Its size is
bounded by ``most_words``, ``most_pairs`` and ``longest_word`` bytes a word. Every word with a share of
1/most_words of all words is a candidate, because it has that share in at least one slice.

Spread: two passes add counts up (slices to tasks, tasks to at most ``buckets`` rows each), one scores; the
scores, without the texts unless they are asked for, are range-partitioned and numbered by partition offsets, so
neither a global sort in one task nor a limit on the driver takes part. The steps' small tables lie in the shared
folder. Collected on the driver: the head and ``buckets`` gains, both bounded.

Edge cases: a null text has no words (weight 0); a null id is the empty string in the digest and comes last
among equal scores; rows of equal id and score are ranked in any order, each with its own rank; empty tables
give empty results, an empty target leaves all buckets with the gains of smoothing alone; a very long text is
one row's work; columns with an output's name are replaced.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.llm.common import slices, written

#: Bytes of UTF-8: A-Z become a-z, digits, a-z and everything beyond ASCII stay, the rest parts words.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SLICE = 8 << 20


class States(dict):
    """CRC-32 of words: those of the head by look-up, others directly."""

    def __missing__(self, word: bytes) -> int:
        return crc32(word)


class Pairs(dict):
    """Buckets of word pairs: frequent ones by look-up, others by going on from the first word's state."""

    def __init__(self, found: dict, states: States, buckets: int):
        super().__init__(found)
        self.states, self.buckets = states, buckets

    def __missing__(self, pair: tuple[bytes, bytes]) -> int:
        return crc32(b" " + pair[1], self.states[pair[0]]) % self.buckets


class Head(NamedTuple):
    words: dict[bytes, int]
    pairs: dict[tuple[bytes, bytes], int]
    buckets: int
    longest: int


def cut_words(text: bytes | None) -> list[bytes]:
    return text.translate(_WORD_BYTES).split() if text else []


def _texts(b: pa.RecordBatch, column: str) -> list[bytes | None]:
    return b.column(b.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


class Features:
    """Buckets of the features of a slice's documents."""

    def __init__(self, head: Head):
        self.states = States(head.words)
        self.pairs = Pairs(head.pairs, self.states, head.buckets)
        self.buckets, self.longest = head.buckets, head.longest

    def of(self, docs: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each run length: the buckets of all runs, documents in turn, and the number of each document's."""
        sizes = np.array([len(w) for w in docs], "int64")
        words = [x for w in docs for x in w]
        yield np.fromiter(map(self.states.__getitem__, words), "int64", len(words)) % self.buckets, sizes
        for n in range(2, self.longest + 1):
            if n == 2:
                runs = [self.pairs[p] for w in docs for p in zip(w, w[1:])]
            else:
                runs = [crc32(b" ".join(w[i:i + n])) % self.buckets for w in docs for i in range(len(w) - n + 1)]
            yield np.array(runs, "int64"), np.maximum(sizes - n + 1, 0)


def frequent(df: DataFrame, text: str, pairs: bool, most: int, longest_word: int = 64) -> DataFrame:
    """(a, b, n): words ``a``, or word pairs, with a share of 1/most in some slice, with their counts in the slices
    where they have it. A task adds up its slices and hands on at most 4 * most rows at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows() -> pa.RecordBatch:
            a = [k[0] if pairs else k for k in total]
            b = [k[1] if pairs else None for k in total]
            out = pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary()), pa.array(list(total.values()), pa.int64())], names=["a", "b", "n"])
            total.clear()
            return out

        for s in slices(batches, text, _SLICE):
            found: Counter = Counter()
            for t in _texts(s, text):
                w = cut_words(t)
                found.update(zip(w, w[1:]) if pairs else w)
            least = sum(found.values()) / most
            for k, n in found.items():
                if n >= least and (max(len(k[0]), len(k[1])) if pairs else len(k)) <= longest_word:
                    total[k] += n
            if len(total) > 3 * most:
                yield rows()
        if total:
            yield rows()

    return df.select(text).mapInArrow(run, "a binary, b binary, n long")


def learn_head(tables: list[DataFrame], text: str = "text", buckets: int = 10_000, longest: int = 1, most_words: int = 20_000,
               most_pairs: int = 50_000) -> Head:
    """The head of the vocabulary over all rows of the tables."""
    def top(pairs: bool, most: int) -> list:
        found = None
        for t in tables:
            part = frequent(t, text, pairs, most)
            found = part if found is None else found.unionAll(part)
        return found.groupBy("a", "b").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "a", "b").limit(most).collect()

    words = {bytes(r.a): crc32(bytes(r.a)) for r in top(False, most_words)}
    states = States(words)
    pairs = {}
    if longest > 1:
        for r in top(True, most_pairs):
            a, b = bytes(r.a), bytes(r.b)
            pairs[a, b] = crc32(b" " + b, states[a]) % buckets
    return Head(words, pairs, buckets, longest)


def bucket_totals(df: DataFrame, head: Head, text: str = "text") -> DataFrame:
    """(bucket, n): features of all rows in each bucket, zero left out; at most ``buckets`` rows a task are shuffled."""
    shared = df.sparkSession.sparkContext.broadcast(head)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(shared.value), np.zeros(shared.value.buckets, "int64")
        for s in slices(batches, text, _SLICE):
            for found, _ in features.of([cut_words(t) for t in _texts(s, text)]):
                total += np.bincount(found, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    return df.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(source: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of all buckets from the totals of both sides."""
    both = source.select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionAll(
        target.select("bucket", F.lit(0).cast("long"), "n")).unionAll(
        source.sparkSession.range(buckets).select("id", F.lit(0).cast("long"), F.lit(0).cast("long")))
    both = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t"))
    every = Window.partitionBy(F.lit(0))  # over `buckets` rows
    s_all, t_all = F.sum("s").over(every), F.sum("t").over(every)
    up = (F.col("t") + 1).cast("double") * (s_all + buckets).cast("double")
    down = (F.col("s") + 1).cast("double") * (t_all + buckets).cast("double")
    return both.select("bucket", F.floor(F.lit(1000.0) * F.ln(up / down)).alias("gain"))


def noise(row_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first 8 hex digits of the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(row_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long").cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0))))


class Model(NamedTuple):
    head: Head
    gains: np.ndarray


def fit(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", buckets: int = 10_000, longest: int = 1,
        most_words: int = 20_000, most_pairs: int = 50_000) -> Model:
    """Head and gains, from all rows of both tables."""
    if longest < 1 or buckets < 1:
        raise ValueError("longest and buckets must be at least 1")
    target = target.select(F.col(target_text).alias(text))
    head = learn_head([docs.select(text), target], text, buckets, longest, most_words, most_pairs)
    gains = np.zeros(buckets, "int64")
    for r in bucket_gains(bucket_totals(docs, head, text), bucket_totals(target, head, text), buckets).collect():
        gains[r.bucket] = r.gain
    return Model(head, gains)


def weigh(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without its text and with ``n_words``, ``n_features`` and ``weight``, in one pass."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["n_words", "n_features", "weight"]
    keep = [f for f in docs.schema.fields if f.name not in [text, *names]]
    schema = T.StructType(keep + [T.StructField(n, T.LongType()) for n in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, gains = Features(shared.value.head), shared.value.gains
        for s in slices(batches, text, _SLICE):
            words = [cut_words(t) for t in _texts(s, text)]
            count = np.zeros(len(words), "int64")
            weight = np.zeros(len(words), "int64")
            for found, sizes in features.of(words):
                sums = np.concatenate([[0], np.cumsum(gains[found])])
                stops = np.cumsum(sizes)
                weight += sums[stops] - sums[stops - sizes]
                count += sizes
            cols = [s.column(s.schema.get_field_index(f.name)) for f in keep]
            made = [pa.array(np.array([len(w) for w in words], "int64")), pa.array(count), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(cols + made, names=schema.names)

    return docs.mapInArrow(run, schema)


def rank_highest(scored: DataFrame, row_id: str, eligible: Column, percent: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... for the floor(percent * N / 100) highest scores of the N eligible rows,
    equal ones by ``row_id``, null for all others. Rows are range-partitioned and sorted, numbered inside their
    partition, and the partitions' offsets (one row each) are added."""
    rows = scored.withColumn("__out", ~F.coalesce(eligible, F.lit(False)))
    rows = rows.repartitionByRange("__out", F.desc("score"), F.asc_nulls_last(row_id))
    rows = rows.sortWithinPartitions("__out", F.desc("score"), F.asc_nulls_last(row_id)).withColumn("__at", F.monotonically_increasing_id())
    rows = written(rows, "importance-order")  # fixes the partitions and their order
    part, place = F.shiftright("__at", 33), F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.where(~F.col("__out")).groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    every = Window.partitionBy(F.lit(0))  # one row per partition
    offsets = sizes.select("__part", (F.sum("__n").over(every.orderBy("__part")) - F.col("__n")).alias("__before"),
                           F.expr(f"{int(percent)} * sum(__n) OVER (PARTITION BY 0) div 100").alias("__most"))
    found = rows.withColumn("__part", part).join(F.broadcast(offsets), "__part", "left")
    rank = F.col("__before") + place + 1
    return found.select(*scored.columns, F.when(~F.col("__out") & (rank <= F.col("__most")), rank).alias("rank"))


def draw(docs: DataFrame, model: Model, row_id: str = "doc_id", text: str = "text", percent: int = 10, least_words: int = 20,
         seed: int = 2024) -> DataFrame:
    """Every row of ``docs``, without its text, with ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (null: not drawn)."""
    docs = docs.drop("score", "rank")
    scored = weigh(docs, model, text).withColumn("score", F.col("weight") + noise(F.col(row_id), seed))
    return rank_highest(written(scored, "importance-scores"), row_id, F.col("n_words") >= least_words, percent)


def resample(docs: DataFrame, target: DataFrame, row_id: str = "doc_id", text: str = "text", percent: int = 10, least_words: int = 20,
             seed: int = 2024, **fitted) -> DataFrame:
    """The drawn rows of ``docs`` with their text, ``weight``, ``score`` and ``rank``: the text travels as one
    more column."""
    model = fit(docs, target, text, **fitted)
    body = "__text"
    found = draw(docs.withColumn(body, F.col(text)), model, row_id, text, percent, least_words, seed)
    return found.where(F.col("rank").isNotNull()).withColumnRenamed(body, text).select(*docs.drop("weight", "score", "rank").columns, "weight", "score", "rank")

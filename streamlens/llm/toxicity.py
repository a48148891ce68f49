"""Toxicity: a logistic classifier with counterfactual regularisation.

Features of a text: its distinct lower-case letter runs, and their 4-, 5- and 6-letter beginnings.
Learning uses a bounded sample of the labelled rows (``most_rows``, chosen by a hash of the id). Of
its features those are kept that tell the labels apart best (at most ``most_features``, counted by
Spark). Each sampled text that holds identity terms is paired with its counterfactual, in which
every term is replaced by another term of the same axis; the loss is the mean log loss, plus
``invariance`` times the mean squared difference of the two logits over these pairs, plus a small
L2 term. So a term earns weight only where the rest of the text cannot explain the label, and a
neutral mention of a group does not raise the score.

Only the sample's indices of kept features (bounded by the parameters) reach the driver; scoring is
one pass without a shuffle over whole texts. Null and empty texts score by the intercept. A document
with several labels counts as toxic if one says so; null labels teach nothing; without labelled rows,
or with one class only, the intercept gives the smoothed rate. Repeated rows get a row each. Output
columns replace input columns of their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.llm.common import slices

_WORD = re.compile(r"[^\W\d_]+")
PREFIXES = (4, 5, 6)

# Identity terms by axis; a term is swapped for the next of its axis.
AXES = [
    ["women", "men"], ["woman", "man"], ["girls", "boys"], ["girl", "boy"], ["female", "male", "nonbinary"],
    ["she", "he"], ["her", "his"], ["mother", "father"], ["wife", "husband"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "sikh", "atheist", "catholic", "protestant"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "sikhs", "atheists", "catholics", "protestants"],
    ["islam", "christianity", "judaism", "hinduism", "buddhism"],
    ["black", "white", "asian", "latino", "hispanic", "arab", "african", "european", "indigenous"],
    ["gay", "straight", "lesbian", "bisexual", "queer", "heterosexual", "homosexual"], ["transgender", "cisgender"],
    ["immigrant", "citizen", "refugee", "foreigner"], ["immigrants", "citizens", "refugees", "foreigners"],
    ["mexican", "chinese", "indian", "american", "german", "french", "spanish", "turkish", "russian", "japanese"],
    ["blind", "deaf", "disabled", "autistic"], ["old", "young"], ["elderly", "teenage"],
    ["frauen", "männer"], ["frau", "mann"], ["juden", "christen", "muslime"], ["ausländer", "einwanderer", "flüchtlinge"],
    ["femmes", "hommes"], ["femme", "homme"], ["juifs", "chrétiens", "musulmans"], ["étrangers", "immigrés", "réfugiés"],
    ["mujeres", "hombres"], ["mujer", "hombre"], ["judíos", "cristianos", "musulmanes"], ["extranjeros", "inmigrantes", "refugiados"],
]
SWAP = {a: axis[(k + 1) % len(axis)] for axis in AXES for k, a in enumerate(axis)}


def word_set(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def word_features(word: str) -> list[str]:
    """The word itself, and its beginnings (marked)."""
    return ["=" + word, *[word[:n] for n in PREFIXES if len(word) >= n]]


def features(words: set[str]) -> set[str]:
    return {f for w in words for f in word_features(w)}


def swapped(words: set[str]) -> set[str] | None:
    """Words of the counterfactual text; None if it holds no identity term."""
    if words.isdisjoint(SWAP):
        return None
    return {SWAP.get(w, w) for w in words}


def sample(docs: DataFrame, labels: DataFrame, most_rows: int, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """Rows (toxic, text) of at most ``most_rows`` labelled documents, by a hash of the id. The
    chosen ids, bounded by the parameter, are the side that may be broadcast."""
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("_id")).agg(F.max(label).cast("int").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(most_rows)
    return docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("text")).join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("toxic", "text")


def choose_features(rows: DataFrame, most: int, least_rows: int = 3, least_z: float = 3.0) -> dict[str, int]:
    """The features whose log odds differ most between the labels, in standard errors (``least_z`` at least)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            n: dict[str, list[int]] = {}
            for y, t in zip(*[c.to_pylist() for c in b.columns]):
                for f in features(word_set(t)):
                    n.setdefault(f, [0, 0])[1 if y else 0] += 1
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array([x[1] for x in n.values()], pa.int64()),
                                              pa.array([x[0] for x in n.values()], pa.int64())], names=["f", "t", "c"])

    total = rows.groupBy().agg(F.sum(F.col("toxic")).alias("t"), F.count("*").alias("n")).first()
    toxic = total.t or 0
    clean = total.n - toxic
    if not toxic or not clean:
        return {}
    n = rows.mapInArrow(count, "f string, t long, c long").groupBy("f").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).where(F.col("t") + F.col("c") >= least_rows)
    t, c = F.col("t") + 0.5, F.col("c") + 0.5
    z = (F.log(t / (toxic + 1)) - F.log(c / (clean + 1))) / F.sqrt(1 / t + 1 / c)
    best = n.where(F.abs(z) >= least_z).orderBy(F.desc(F.abs(z)), "f").limit(most).select("f").collect()
    return {r.f: i for i, r in enumerate(best)}


class Model:
    """Weights of the kept features; a cache of words' feature indices."""

    def __init__(self, index: dict[str, int], weights: np.ndarray, bias: float):
        self.index, self.weights, self.bias = index, weights, bias
        self.cache: dict[str, tuple[int, ...]] = {}

    def active(self, words: set[str]) -> set[int]:
        if len(self.cache) > 500_000:
            self.cache.clear()
        out: set[int] = set()
        cache, index = self.cache, self.index
        for w in words:
            f = cache.get(w)
            if f is None:
                f = cache[w] = tuple(index[x] for x in word_features(w) if x in index)
            if f:
                out.update(f)
        return out

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[sorted(self.active(word_set(text)))])
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def descend(x: list[list[int]], y: np.ndarray, pairs: list[tuple[list[int], list[int]]], size: int, invariance: float, l2: float, steps: int) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the regularised loss."""
    def flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        none = np.zeros(0, "int32")
        return np.repeat(np.arange(len(rows), dtype="int32"), [len(r) for r in rows]), np.concatenate([none, *[np.asarray(r, "int32") for r in rows]])

    row, col = flat(x)
    pr, pc = flat([a for a, _ in pairs] + [b for _, b in pairs])
    m = len(pairs)
    sign = np.where(pr < m, 1.0, -1.0)
    pr = pr % max(m, 1)
    w = np.zeros(size + 1)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    w[size] = np.log(rate / (1 - rate))
    m1, m2 = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        z = np.bincount(row, w[col], len(x)) + w[size]
        e = 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
        g = np.zeros(size + 1)
        g[:size] = np.bincount(col, e[row], size) / len(x) + l2 * w[:size]
        g[size] = e.mean()
        if m:
            d = np.bincount(pr, sign * w[pc], m)
            g[:size] += invariance * 2 / m * np.bincount(pc, sign * d[pr], size)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        w -= 0.05 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    return w[:size], float(w[size])


def fit(docs: DataFrame, labels: DataFrame, most_rows: int = 30_000, most_features: int = 4096, invariance: float = 1.0,
        l2: float = 1e-5, steps: int = 300, **names) -> Model:
    """A model from at most ``most_rows`` labelled rows of ``docs``."""
    rows = sample(docs, labels, most_rows, **names)
    index = choose_features(rows, most_features)
    reader = Model(index, np.zeros(len(index)), 0.0)

    def indices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            out = []
            for y, t in zip(*[c.to_pylist() for c in b.columns]):
                words = word_set(t)
                other = swapped(words)
                own = sorted(reader.active(words))
                out.append((y, own, None if other is None else sorted(reader.active(other))))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.list_(pa.int32())),
                                              pa.array([o[2] for o in out], pa.list_(pa.int32()))], names=["y", "own", "other"])

    found = rows.mapInArrow(indices, "y int, own array<int>, other array<int>").toArrow()
    y = found["y"].to_numpy().astype("float64")
    lists = found["own"].combine_chunks()
    ends = lists.offsets.to_numpy() if len(lists) else np.zeros(1, "int32")
    own = np.split(lists.values.to_numpy(zero_copy_only=False), ends[1:-1]) if len(lists) else []
    other = found["other"].to_pylist()
    if not index:
        rate = (y.sum() + 0.5) / (len(y) + 1)
        return Model({}, np.zeros(0), float(np.log(rate / (1 - rate))))
    pairs = [(a, b) for a, b in zip(own, other) if b is not None]
    return Model(index, *descend(own, y, pairs, len(index), invariance, l2, steps))


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``df`` with the probability of the toxic label (0 to 1) of the whole text."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    keep = [f for f in df.schema.fields if f.name != out]
    schema = T.StructType([*keep, T.StructField(out, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, text):
            s = [m.score(t) for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[b.column(b.schema.get_field_index(f.name)) for f in keep], pa.array(s, pa.float64())],
                                             names=[*[f.name for f in keep], out])

    return df.mapInArrow(run, schema)

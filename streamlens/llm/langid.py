"""Language identification by rank-order profiles.

A text is lower-cased and reduced to its runs of letters, each padded by a space. Its n-grams
(1 to 3 characters, none across words) are ranked by frequency (ties: by code). A language's
profile is the ranking of its most frequent n-grams over all training texts; a document's
distance to it is the out-of-place measure: the sum of rank differences of the document's most
frequent n-grams, the most possible for those the profile lacks, as a share of its largest value.

Profiles: partial n-gram counts per slice of a partition, summed by Spark, cut to ``size`` ranks
per language. Only profiles (languages x size rows, languages bounded by a checked parameter)
reach the driver. Scoring is one pass without a shuffle.

Null text, or text without a letter: ``und``, score 0. Without any training text: ``und`` for all.
Repeated rows are scored alike, one row each. Output columns replace input columns of their names;
other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.llm.common import slices

UNKNOWN = "und"
_NOT_LETTERS = regex.compile(r"\P{L}+")
_LONG = 1 << 20


def _codes(text: str) -> np.ndarray:
    """Codes of all 1- to 3-grams of a normalised text (space: word border)."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "uint32").astype("int64")
    space = c == 32
    two = (c[:-1] << 21) | c[1:]
    three = (c[:-2] << 42) | two[1:]
    return np.concatenate([c[~space], two, three[~space[1:-1]]])


def letters(text: str | None) -> str:
    """Lower-case letter runs, with a space before, between and after; empty without a letter."""
    t = _NOT_LETTERS.sub(" ", (text or "").lower()).strip()
    return f" {t} " if t else ""


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes and their counts; long texts in pieces, so memory is bounded."""
    found: dict[int, int] = {}
    for start in range(0, len(text), _LONG):
        piece = text[start:start + _LONG + 2]
        codes, n = np.unique(_codes(piece), return_counts=True)
        if len(text) <= _LONG:
            return codes, n
        # grams that begin in the overlap are counted by the next piece
        if start + _LONG < len(text):
            tail = piece[_LONG:]
            over, m = np.unique(_codes(tail), return_counts=True) if len(tail) > 1 else (codes[:0], n[:0])
            n[np.searchsorted(codes, over)] -= m
        for k, v in zip(codes.tolist(), n.tolist()):
            found[k] = found.get(k, 0) + v
    codes = np.array(sorted(found), "int64")
    return codes, np.array([found[k] for k in codes.tolist()], "int64")


def ranked(codes: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes in rank order."""
    return codes[np.lexsort((codes, -n))[:size]]


def learn_profiles(df: DataFrame, text: str = "text", lang: str = "lang", size: int = 300) -> DataFrame:
    """Rows (lang, gram, rank) of the profiles; rows with null text or lang teach nothing."""
    slim = df.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 4 << 20):
            by: dict[str, list[str]] = {}
            for t, g in zip(b.column(1).to_pylist(), b.column(0).to_pylist()):
                by.setdefault(g, []).append(letters(t))
            for g, texts in by.items():
                codes, n = gram_counts("".join(texts).replace("  ", " "))
                yield pa.RecordBatch.from_arrays([pa.array([g] * len(codes), pa.string()), pa.array(codes), pa.array(n.astype("int64"))],
                                                 names=["lang", "gram", "n"])

    total = slim.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return total.withColumn("rank", rank).where(F.col("rank") <= size).select("lang", "gram", "rank")


class Profiles:
    """All profiles as one rank matrix: row per language, column per known n-gram."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        self.grams = np.array(sorted({r[1] for r in rows}), "int64")
        self.ranks = np.full((len(self.langs), len(self.grams) + 1), -1, "int32")
        at = {g: i for i, g in enumerate(self.langs)}
        for g, gram, rank in rows:
            self.ranks[at[g], np.searchsorted(self.grams, gram)] = rank - 1

    def distances(self, text: str) -> np.ndarray:
        """Out-of-place distance to each language, 0 to 1."""
        top = ranked(*gram_counts(text), self.size)
        at = np.searchsorted(self.grams, top)
        at[at < len(self.grams)] = np.where(self.grams[at[at < len(self.grams)]] == top[at < len(self.grams)], at[at < len(self.grams)], len(self.grams))
        r = self.ranks[:, at]
        out = np.where(r < 0, self.size, np.abs(r - np.arange(len(top))))
        return out.sum(axis=1) / (len(top) * self.size)

    def predict(self, raw: str | None, sharpness: float) -> tuple[str, float, float | None]:
        text = letters(raw)
        if not text or not self.langs:
            return UNKNOWN, 0.0, None
        d = self.distances(text)
        best = int(np.argmin(d))
        return self.langs[best], float(1 / np.exp(sharpness * (d[best] - d)).sum()), float(d[best])


def identify(df: DataFrame, profiles: DataFrame, text: str = "text", out: str = "lang_pred", score: str = "score",
             distance: str = "distance", size: int = 300, sharpness: float = 40.0, most_languages: int = 5000) -> DataFrame:
    """``df`` with the nearest language, its share of exp(-sharpness * distance) over all
    languages (0 to 1), and the distance (null for ``und``)."""
    rows = profiles.select("lang", "gram", "rank").limit(most_languages * size + 1).collect()
    if len(rows) > most_languages * size:
        raise ValueError(f"more than {most_languages} languages")
    model = Profiles([tuple(r) for r in rows], size)
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = [out, score, distance]
    keep = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType(keep + [T.StructField(out, T.StringType()), T.StructField(score, T.DoubleType()), T.StructField(distance, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in slices(batches, text):
            found = [m.predict(t, sharpness) for t in b.column(b.schema.get_field_index(text)).to_pylist()]
            cols = [b.column(b.schema.get_field_index(f.name)) for f in keep]
            new = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(cols + new, names=[f.name for f in keep] + names)

    return df.mapInArrow(run, schema)


def learn_and_identify(df: DataFrame, train: Column | None = None, **how) -> DataFrame:
    """Learn from the rows of ``df`` where ``train`` holds (all, if None), identify all rows."""
    profiles = learn_profiles(df if train is None else df.where(train), size=how.get("size", 300))
    return identify(df, profiles, **how)

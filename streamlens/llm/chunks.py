"""Documents dealt to chunks of bounded size, and keys asked of hash buckets, in packed rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm.common import slices

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def mix(x: np.ndarray) -> np.ndarray:
    x = x.astype("uint64")
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def squeeze(x: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x)


def unsqueeze(x: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(x)


def pack_sorted(codes: np.ndarray) -> bytes:
    return squeeze(np.diff(codes, prepend=0).tobytes())


def unpack_sorted(x: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(unsqueeze(x), "int64"))


def by_bucket(hashes: np.ndarray, buckets: int) -> list[np.ndarray]:
    """For each bucket the positions of its keys, in order."""
    b = (hashes % np.uint64(buckets)).astype("int64")
    order = np.argsort(b, kind="stable")
    return np.split(order, np.searchsorted(b[order], np.arange(1, buckets)))


def grouped(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[tuple[int, list[tuple]]]:
    """Rows of a sorted partition by their key column."""
    at, rows = None, []
    for b in batches:
        for r in zip(*[c.to_pylist() for c in b.columns]):
            if r[key] != at and rows:
                yield at, rows
                rows = []
            at = r[key]
            rows.append(r)
    if rows:
        yield at, rows


def batch(rows: list[tuple], fields: list[tuple]) -> pa.RecordBatch:
    names, types = zip(*fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


PACKED = "chunk int, ids binary, tags binary, sizes binary, data binary"


def chunked(docs: DataFrame, chunks: int, taken: int | None = None) -> DataFrame:
    """Documents (id, tag, text), all but the text longs, packed by chunk: compressed texts, one row per
    chunk and slice. Null ids are kept; a null tag becomes 0. With ``taken``, only the first so many chunks are packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "text", 24 << 20):
            chunk = b.column(0).to_numpy()
            ids, tags, text = (b.column(i).to_pylist() for i in (1, 2, 3))
            out: list[tuple] = []
            order = np.argsort(chunk, kind="stable")
            cuts = np.flatnonzero(np.concatenate([[True], chunk[order][1:] != chunk[order][:-1], [True]])) if len(order) else []
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                mine = order[lo:hi].tolist()
                raw = [(text[i] or "").encode() for i in mine]
                known = np.array([0 if ids[i] is None else ids[i] for i in mine], "int64")
                none = np.array([ids[i] is None for i in mine], "int64")
                out.append((int(chunk[mine[0]]), np.stack([known, none]).tobytes(), np.array([tags[i] or 0 for i in mine], "int64").tobytes(), np.array([len(r) for r in raw], "int64").tobytes(), squeeze(b"".join(raw))))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), [pa.int32()] + [pa.binary()] * 4)], names=["chunk", "ids", "tags", "sizes", "data"])

    hashed = docs.select(F.pmod(F.xxhash64("id", "text"), F.lit(chunks)).cast("int").alias("chunk"), "id", "tag", "text")
    return (hashed if taken is None else hashed.where(F.col("chunk") < taken)).mapInArrow(run, PACKED)


def documents(rows: list[tuple]) -> tuple[list[int | None], list[int], list[bytes]]:
    """The (ids, tags, texts) of packed rows; texts in lower case."""
    ids: list[int | None] = []
    tags: list[int] = []
    texts: list[bytes] = []
    for i, g, n, data in rows:
        known, none = np.frombuffer(i, "int64").reshape(2, -1).tolist()
        ids += [None if x else k for k, x in zip(known, none)]
        tags += np.frombuffer(g, "int64").tolist()
        whole = unsqueeze(data).translate(LOWER)
        ends = np.cumsum(np.frombuffer(n, "int64")).tolist()
        texts += [whole[s:e] for s, e in zip([0, *ends], ends)]
    return ids, tags, texts


def pieces(texts: list[bytes], most: int = 2 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of the texts with at most ``most`` bytes each (one text at least)."""
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= most:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def distinct(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct codes and their counts."""
    s = np.sort(codes)
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, "int64")
    return s[first], np.diff(np.append(first, len(s)))


def word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes (never 0) of all words, text after text, and the number of each text's words."""
    parts = [_word_codes(texts[s:e]) for s, e in pieces(texts)]
    none = np.zeros(0, "int64")
    return np.concatenate([none, *[p[0] for p in parts]]), np.concatenate([none, *[p[1] for p in parts]])


def _word_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" ".join([*texts, b""]), "uint8")
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.flatnonzero(space[1:] != space[:-1]) + 1
    first = edge[~space[edge]]
    if len(data) and not space[0]:
        first = np.concatenate([[0], first])
    last = edge[space[edge]]
    up, back = _powers(len(data))
    total = np.concatenate([np.zeros(1, "uint64"), np.cumsum((data.astype("uint64") + np.uint64(1)) * up, dtype="uint64")])
    h = mix((total[last] - total[first]) * back[first] + ((last - first).astype("uint64") << np.uint64(40)))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return np.where(h == 0, 1, h).astype("uint64").view("int64"), np.diff(np.searchsorted(first, ends), prepend=0)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd multiplier modulo 2^64, and of its inverse."""
    step = 0x9E3779B97F4A7C15
    up, back = np.full(n, step, "uint64"), np.full(n, pow(step, -1, 1 << 64), "uint64")
    up[:1] = back[:1] = 1
    return np.cumprod(up, dtype="uint64"), np.cumprod(back, dtype="uint64")

"""BPE encoding and decoding with a pair occurrence index.

A text is cut into whitespace-free chunks (no piece of the vocabulary's splitting rule spans
white space), each distinct chunk into pieces, each piece into byte symbols. All new distinct
pieces of a slice of a partition are merged together: an index maps every adjacent pair to all
its positions; a heap holds the active ranks; the lowest rank is applied at all its positions
and the lists of the neighbouring pairs are updated. As the lowest rank over all pieces is the
lowest of each piece that holds it, the result is that of the greedy rule for each piece.

Null and empty texts give no ids; every input row gives one output row (repeated rows too);
other columns pass through untouched unless they have the output names, which replace them.
Memory: a slice of text plus a bounded cache of pieces; a lost task is simply run again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from streamlens.llm.common import slices

# White space of the splitting rule (Unicode White_Space).
_SPACE = "\t-\r \x85\xa0  -     　"
_CHUNK = re.compile(f"[^{_SPACE}]+")
_ODD = re.compile("[\x1c-\x1f]")  # str.split() cuts at these, the rule does not
_PIECE_OR_END = regex.compile(rf"\n|'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
#: Vocabulary files beyond this size are refused: the vocabulary is the only thing broadcast.
MOST_VOCABULARY_BYTES = 64 << 20


def normal(text: str) -> str:
    """NFC and lower case, character by character (a final sigma is not special)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: printable
    Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class PairIndexBPE:
    """Vocabulary, merge ranks and the bounded caches of one worker. Ids are kept as packed int32."""

    def __init__(self, spec: dict, most_cached: int = 400_000):
        model = spec["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        sym = byte_symbols()
        self.inner = np.array([vocab[s] for s in sym], "int64")
        self.last = np.array([vocab[s + end] for s in sym], "int64")
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        keys = np.array([(a << 32) | b for a, b, _ in self.merges] or [-1], "int64")
        self.keys, self.ranks = np.unique(keys, return_index=True)  # of a pair listed twice, the first rank
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        self.tokens = [names.get(i) for i in range(max(names) + 1)]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.pieces: dict[str, bytes] = {}
        self.chunks: dict[str, bytes] = {}
        self.most_cached = most_cached

    # --- splitting ---------------------------------------------------------------------
    def split(self, text: str) -> list[str]:
        return _CHUNK.findall(text) if _ODD.search(text) else text.split()

    def parts(self, chunks: list[str]) -> list[list[str]]:
        """Pieces of each chunk in order; a special token is a piece that starts with a line end."""
        whole = "\n".join(chunks)
        if self.cut and self.cut.search(whole):
            # no chunk holds white space, so line ends part chunks and carriage returns part runs
            runs = [r if r in self.special else normal(r) for r in self.cut.sub("\r\\1\r", whole).split("\r")]
            out: list[list[str]] = [[]]
            for r in runs:
                if r in self.special:
                    out[-1].append("\n" + r)
                    continue
                for p in _PIECE_OR_END.findall(r):
                    if p == "\n":
                        out.append([])
                    else:
                        out[-1].append(p)
            return out
        out = [[]]
        own = out[0]
        for p in _PIECE_OR_END.findall(normal(whole)):
            if p == "\n":
                own = []
                out.append(own)
            else:
                own.append(p)
        return out

    # --- merging -----------------------------------------------------------------------
    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 for none."""
        key = (left << 32) | right
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == key, self.ranks[at], -1)

    def merge(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece, by the pair occurrence index over all of them."""
        if not pieces:
            return []
        raw = [p.encode() for p in pieces]
        sizes = np.array([len(r) for r in raw], "int64")
        stops = np.cumsum(sizes)
        data = np.frombuffer(b"".join(raw), "uint8")
        n = len(data)
        sym = self.inner[data]
        sym[stops - 1] = self.last[data[stops - 1]]
        nxt = np.arange(1, n + 1)
        nxt[stops - 1] = -1
        prv = np.arange(-1, n - 1)
        prv[stops - sizes] = -1
        # the index: rank -> arrays of left positions
        at = np.flatnonzero(nxt >= 0)
        r = self.rank_of(sym[at], sym[at + 1])
        at, r = at[r >= 0], r[r >= 0]
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def enter(ranks: np.ndarray, where: np.ndarray) -> None:
            if len(ranks) == 1:
                groups = ((int(ranks[0]), where),)
            else:
                order = np.argsort(ranks, kind="stable")
                ranks, where = ranks[order], where[order]
                cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
                groups = zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(where, cuts)) if len(cuts) else ((int(ranks[0]), where),)
            for k, g in groups:
                if k in index:
                    index[k].append(g)
                else:
                    index[k] = [g]
                    heappush(active, k)

        if len(at):
            enter(r, at)
        while active:
            rank = heappop(active)
            left, right, made = self.merges[rank]
            lists = index.pop(rank)
            i = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
            j = nxt[i]
            ok = (sym[i] == left) & (j >= 0)
            ok &= sym[j] == right
            i, j = i[ok], j[ok]
            if left == right and len(i) > 1:  # of overlapping pairs the leftmost counts
                taken, kept = -1, []
                for k, (x, y) in enumerate(zip(np.sort(i).tolist(), np.sort(j).tolist())):
                    if x != taken:
                        kept.append(k)
                        taken = y
                i, j = np.sort(i)[kept], np.sort(j)[kept]
            if not len(i):
                continue
            k = nxt[j]
            sym[i], sym[j] = made, -1
            nxt[i] = k
            inside = k >= 0
            prv[k[inside]] = i[inside]
            h = prv[i]
            before = h >= 0
            where = np.concatenate([i[inside], h[before]])
            if len(where):
                r = self.rank_of(sym[where], sym[nxt[where]])
                found = r >= 0
                if found.any():
                    enter(r[found], where[found])
        alive = sym >= 0
        ids = sym[alive].astype("int32").tobytes()
        ends = (np.cumsum(alive)[stops - 1] * 4).tolist()
        return [ids[s:e] for s, e in zip([0, *ends], ends)]

    def learn(self, chunks: set[str]) -> None:
        """Encode the chunks that are not cached yet, their pieces together."""
        if len(self.chunks) + len(chunks) > self.most_cached:
            self.chunks.clear()
        new_chunks = list(chunks - self.chunks.keys())
        if not new_chunks:
            return
        parts = self.parts(new_chunks)
        wanted = {p for ps in parts for p in ps}
        if len(self.pieces) + len(wanted) > self.most_cached:
            self.pieces.clear()
        new = list(wanted - self.pieces.keys())
        for p in [p for p in new if p[0] == "\n"]:
            self.pieces[p] = np.array([self.special[p[1:]]], "int32").tobytes()
        new = [p for p in new if p[0] != "\n"]
        self.pieces.update(zip(new, self.merge(new)))
        known = self.pieces
        for c, ps in zip(new_chunks, parts):
            self.chunks[c] = known[ps[0]] if len(ps) == 1 else b"".join([known[p] for p in ps])

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [self.split(t) if t else () for t in texts]
        self.learn(set().union(*split))
        known = self.chunks
        return [np.frombuffer(b"".join([known[c] for c in chunks]), "int32") for chunks in split]

    def decode(self, ids: list[int]) -> str:
        """Token texts joined by a space (the vocabulary file names no decoder); unknown ids are skipped."""
        tokens, most = self.tokens, len(self.tokens)
        try:
            return " ".join([tokens[i] for i in ids])
        except (IndexError, TypeError):
            return " ".join([tokens[i] for i in ids if i is not None and 0 <= i < most and tokens[i] is not None])


def read_vocabulary(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        text = f.read(MOST_VOCABULARY_BYTES + 1)
    if len(text) > MOST_VOCABULARY_BYTES:
        raise ValueError(f"{path}: larger than {MOST_VOCABULARY_BYTES} bytes")
    spec = json.loads(text)
    if spec["model"]["type"] != "BPE" or spec.get("decoder") or spec.get("post_processor"):
        raise ValueError(f"{path}: not a BPE vocabulary without decoder and post-processor")
    return text


def _mapper(df: DataFrame, path: str, add: list[tuple[str, T.DataType]], make):
    """One pass over ``df``: ``make(bpe, batch)`` gives the added Arrow columns."""
    shared = df.sparkSession.sparkContext.broadcast(read_vocabulary(path))
    names = [n for n, _ in add]
    keep = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType(keep + [T.StructField(n, t) for n, t in add])
    column = make.column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = PairIndexBPE(json.loads(shared.value))
        for b in slices(batches, column, 12 << 20):
            cols = [b.column(b.schema.get_field_index(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays(cols + make(bpe, b), names=[f.name for f in keep] + names)

    return df.mapInArrow(run, schema)


class _Encode:
    def __init__(self, column: str, decoded: bool):
        self.column, self.decoded = column, decoded

    def __call__(self, bpe: PairIndexBPE, b: pa.RecordBatch) -> list[pa.Array]:
        ids = bpe.encode_batch(b.column(b.schema.get_field_index(self.column)).to_pylist())
        offsets = np.cumsum([0, *[len(x) for x in ids]]).astype("int32")
        out: list[pa.Array] = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))]
        if self.decoded:
            out.append(pa.array([bpe.decode(x.tolist()) for x in ids], pa.string()))
        return out


class _Decode:
    def __init__(self, column: str):
        self.column = column

    def __call__(self, bpe: PairIndexBPE, b: pa.RecordBatch) -> list[pa.Array]:
        ids = b.column(b.schema.get_field_index(self.column)).to_pylist()
        return [pa.array([bpe.decode(x or ()) for x in ids], pa.string())]


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the array column ``ids`` of token ids of ``text`` (special-token strings in a
    text become their ids; none are added); with ``decoded`` named, also the ids decoded again,
    in the same pass. Null or empty text: empty array and empty decoded text."""
    add: list[tuple[str, T.DataType]] = [(ids, T.ArrayType(T.IntegerType()))]
    if decoded:
        add.append((decoded, T.StringType()))
    return _mapper(df, path, add, _Encode(text, bool(decoded)))


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the column ``text`` decoded from the array column ``ids`` (null: empty text)."""
    return _mapper(df, path, [(text, T.StringType())], _Decode(ids))

"""SentencePiece BPE encoding and decoding by a prefix table.

A merge-type model encodes a text greedily: of all neighbouring symbols whose joined text is a piece, the
pair of the best score is merged first, the leftmost of equals. Two tokens are *compatible* if the text of
both, encoded alone, gives just these two. A sequence is the encoding of its text exactly if all neighbours
are compatible: the greedy rule inside the text of two neighbours picks the same merges, in the same order,
as in the whole text, so the first merge across a border would also be one across it in the pair. Every
prefix therefore has one last token, which the table stores: of the pieces that an automaton finds ending
there, the one compatible with the last token of the prefix before it. The ids are read off backwards. Work
is linear in the text (the pieces ending at a place are bounded by the longest piece).

No piece holds white space behind another character (checked when the model is read), so a text is cut in
front of each run of spaces, at control characters no piece holds, and between letters and what follows them
(letters behind which some piece goes on with something else count as no letters); each distinct unit of a
slice is encoded once and short ones are kept in a bounded cache. Characters no piece holds become their bytes.

Null and empty texts give no ids; every input row gives one output row (repeated rows too); columns of
``df`` with an output's name are replaced, the others stay; an empty table gives an empty one; a very long
text is one row's work, linear in its length, also without any space. Memory: a slice of text and the
bounded caches of a worker; a lost task is simply run again. Models with a normaliser other than identity,
user-defined or unused pieces, or without byte fallback are refused.
"""

from __future__ import annotations

import codecs
import hashlib
import re
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from streamlens.llm.common import slices

#: Model files beyond this size are refused: the model is the only thing broadcast.
MOST_MODEL_BYTES = 64 << 20
_SPACE = "▁"  # stands for a space inside pieces
# Piece kinds of the model format.
_NORMAL, _UNKNOWN, _CONTROL, _BYTE = 1, 2, 3, 6
_WORST = float("-inf")


def _varint(data: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[i] & 127) << shift
        i, shift = i + 1, shift + 7
        if data[i - 1] < 128:
            return value, i


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a message in the protocol-buffer wire format."""
    i = 0
    while i < len(data):
        key, i = _varint(data, i)
        if key & 7 == 0:
            value, i = _varint(data, i)
        else:
            size, i = _varint(data, i) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], i)
            value, i = data[i:i + size], i + size
        yield key >> 3, value


def _each_byte(e: UnicodeDecodeError) -> tuple[str, int]:
    return "\ufffd" * (e.end - e.start), e.end


codecs.register_error("streamlens-each-byte", _each_byte)


class PrefixTable:
    """The pieces of a model and the bounded caches of one worker. Ids are kept as packed int32."""

    def __init__(self, model: bytes, most_cached: int = 300_000, longest_cached: int = 64):
        pieces: list[tuple[str, float, int]] = []
        merges, prefix, extra, charsmap, escape, fallback = 1, 1, 1, b"", 1, 0
        for number, value in _fields(model):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f[1].decode(), float(np.frombuffer(f.get(2, b"\0\0\0\0"), "<f4")[0]), f.get(3, _NORMAL)))
            elif number == 2:
                f = dict(_fields(value))
                merges, fallback = f.get(3, 1), f.get(35, 0)
            elif number == 3:
                f = dict(_fields(value))
                charsmap, prefix, extra, escape = f.get(2, b""), f.get(3, 1), f.get(4, 1), f.get(5, 1)
        if merges != 2 or not fallback or charsmap or extra or not prefix or not escape:
            raise ValueError("not a merge-type model with byte fallback, a space put in front and no other normalisation")
        if {k for _, _, k in pieces} - {_NORMAL, _UNKNOWN, _CONTROL, _BYTE}:
            raise ValueError("models with user-defined or unused pieces are not supported")
        if any(re.search(f"[^{_SPACE}]{_SPACE}", p) for p, _, k in pieces if k == _NORMAL):
            raise ValueError("a piece holds white space behind another character")
        self.score = {p: s for p, s, k in pieces if k == _NORMAL}
        self.id = {p: i for i, (p, _, k) in enumerate(pieces) if k == _NORMAL}
        self.size = [len(p) for p, _, _ in pieces]
        self.text = [p for p, _, _ in pieces]
        self.chars = {c for p in self.id for c in p}
        if self.chars - self.id.keys():
            raise ValueError("a character of a piece is no piece")
        byte_id = {int(p[3:5], 16): i for i, (p, _, k) in enumerate(pieces) if k == _BYTE}
        self.byte = [byte_id[b] for b in range(256)]
        out = {_NORMAL: lambda p: p.replace(_SPACE, " ").encode(), _BYTE: lambda p: bytes([int(p[3:5], 16)]),
               _CONTROL: lambda p: b"", _UNKNOWN: lambda p: " \u2047 ".encode()}
        self.out = [out[k](p) for p, _, k in pieces]
        self.unknown = {i for i, (_, _, k) in enumerate(pieces) if k == _UNKNOWN}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.id.items():
            self.automaton.add_word(p, i)
        self.automaton.make_automaton()
        lone = "".join(re.escape(chr(c)) for c in [*range(32), 127] if chr(c) not in self.chars)
        # letters behind which a piece goes on with something else count as no letters
        odd = ""
        while more := {m[0] for p in self.id for m in re.findall(rf"([^\W\d_{odd}])(?=[\W\d_{odd}])", p)}:
            odd += "".join(map(re.escape, more))
        rest = rf" *[^\W\d_{odd}]++(?=[\W\d_{odd}])| *[^ {lone}]+| +"
        self.unit = re.compile(f"[{lone}]|{rest}" if lone else rest)
        self.start = len(pieces)  # stands in front of a text
        self.odd = re.compile(f"[^{''.join(map(re.escape, sorted(self.chars)))}]")
        self.gap = next(chr(c) for c in range(0x10FFFF) if chr(c) not in self.chars)
        self.made: dict[int, tuple[list, list] | None] = {}
        self.compatible: dict[int, bool] = {}
        self.units: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.most_cached, self.longest_cached = most_cached, longest_cached

    # --- the table -----------------------------------------------------------------------
    def history(self, token: int) -> tuple[list, list] | None:
        """The merges that make ``token`` from its characters, in the order of the greedy rule, each with its
        score and the symbol it leaves at the left and at the right end; None if they do not make it."""
        parts, score = list(self.text[token]), self.score
        left, right = [(None, parts[0])], [(None, parts[-1])]
        while True:
            best, at = _WORST, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1], _WORST)
                if s > best:
                    best, at = s, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            left.append((best, parts[0]))
            right.append((best, parts[-1]))
        return (left + [(_WORST, "")], right + [(_WORST, "")]) if len(parts) == 1 else None

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (the start of a text: whether it is its own encoding): the greedy
        rule makes both side by side and no merge across their border ever has its turn. Among equal scores the
        leftmost is first: the merges of ``before``, then the one across, then those of ``token``."""
        for t in (before, token):
            if t != self.start and t not in self.made:
                self.made[t] = self.history(t)
        ok = self.made[token] is not None
        if ok and before != self.start:
            a, b, score = self.made[before][1], self.made[token][0], self.score
            i = j = 1
            end, first = a[0][1], b[0][1]
            across = score.get(end + first, _WORST)
            while True:
                sa, sb = a[i][0], b[j][0]
                if across > sa and across >= sb and across > _WORST:
                    ok = False
                    break
                if sa == sb == _WORST:
                    break
                if sa >= sb:
                    now, i = a[i][1], i + 1
                    if now == end:
                        continue
                    end = now
                else:
                    now, j = b[j][1], j + 1
                    if now == first:
                        continue
                    first = now
                across = score.get(end + first, _WORST)
        if len(self.compatible) >= 3 * self.most_cached:
            self.compatible.clear()
        self.compatible[before << 32 | token] = ok
        return ok

    def last_tokens(self, text: str) -> list[int]:
        """The last token of every prefix of ``text``; behind a character that no piece holds the table starts
        anew, so units parted by such a character share one pass of the automaton."""
        last = [-1] * (len(text) + 1)
        last[0] = self.start
        for m in self.odd.finditer(text):
            last[m.end()] = self.start
        size, known, fits = self.size, self.compatible, self.fits
        for end, token in self.automaton.iter(text):
            stop = end + 1
            if last[stop] < 0:
                before = last[stop - size[token]]
                if before >= 0:
                    ok = known.get(before << 32 | token)
                    if ok or ok is None and fits(before, token):
                        last[stop] = token
        return last

    def ids_of(self, units: list[str]) -> list[bytes]:
        """Packed ids of each unit, read off the table from its end."""
        text = self.gap.join(units).replace(" ", _SPACE)
        last, size, start = self.last_tokens(text), self.size, self.start
        at, out = len(text), []
        for u in reversed(units):
            begin, ids = at - len(u), []
            while at > begin:
                token = last[at]
                if token == start:
                    ids += [self.byte[b] for b in reversed(text[at - 1].encode())]
                    at -= 1
                else:
                    ids.append(token)
                    at -= size[token]
            ids.reverse()
            out.append(array("i", ids).tobytes())
            at = begin - 1
        out.reverse()
        return out

    # --- texts -----------------------------------------------------------------------------
    def learn(self, units: set[str]) -> dict[str, bytes]:
        """Packed ids of the given units. The cache holds two generations of short units: what a slice uses
        stays, what several slices did not use goes."""
        found, old = {}, self.old
        new = []
        for u in units:
            ids = self.units.get(u) or old.get(u)
            if ids is None:
                new.append(u)
            else:
                found[u] = ids
        found.update(zip(new, self.ids_of(new)))
        longest = self.longest_cached
        self.units.update((u, ids) for u, ids in found.items() if len(u) <= longest)
        if len(self.units) > self.most_cached:
            self.old, self.units = self.units, {}
        return found

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self.unit.findall(" " + t.replace(_SPACE, " ")) if t else () for t in texts]
        known = self.learn(set().union(*cut))
        return [np.frombuffer(b"".join(map(known.__getitem__, units)), "int32") for units in cut]

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: the pieces joined, the space put in front taken off; a byte that is no UTF-8 is
        U+FFFD, ids that do not exist are skipped."""
        out, most = self.out, len(self.out)
        try:
            data = b"".join([out[i] for i in ids])
        except (IndexError, TypeError):
            ids = [i for i in ids if i is not None and 0 <= i < most]
            data = b"".join([out[i] for i in ids])
        if data[:1] == b" " and next(i for i in ids if out[i]) not in self.unknown:
            data = data[1:]
        return data.decode(errors="streamlens-each-byte")


_BUILT: dict[str, PrefixTable] = {}


def _table(model: bytes) -> PrefixTable:
    """The worker's table of a model: tasks of one worker share it and its caches; one is kept."""
    digest = hashlib.sha256(model).hexdigest()
    if digest not in _BUILT:
        _BUILT.clear()
        _BUILT[digest] = PrefixTable(model)
    return _BUILT[digest]


def read_model(path: str) -> bytes:
    with open(path, "rb") as f:
        model = f.read(MOST_MODEL_BYTES + 1)
    if len(model) > MOST_MODEL_BYTES:
        raise ValueError(f"{path}: larger than {MOST_MODEL_BYTES} bytes")
    return model


def _mapped(df: DataFrame, path: str, column: str, add: list[tuple[str, T.DataType]], make) -> DataFrame:
    """One pass over ``df``: ``make(table, values)`` gives the added Arrow columns."""
    model = read_model(path)
    PrefixTable(model)  # a model that is not supported fails here
    shared = df.sparkSession.sparkContext.broadcast(model)
    names = [n for n, _ in add]
    keep = [f for f in df.schema.fields if f.name not in names]
    schema = T.StructType(keep + [T.StructField(n, t) for n, t in add])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(shared.value)
        for b in slices(batches, column, 8 << 20):
            at = b.schema.get_field_index
            cols = [b.column(at(f.name)) for f in keep]
            yield pa.RecordBatch.from_arrays(cols + make(table, b.column(at(column)).to_pylist()), names=[f.name for f in keep] + names)

    return df.mapInArrow(run, schema)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str | None = None) -> DataFrame:
    """``df`` with the array column ``ids`` of token ids of ``text``, without begin or end ids; with ``decoded``
    named, also the ids decoded again, in the same pass. Null or empty text: empty array and empty text."""
    def make(table: PrefixTable, texts: list[str | None]) -> list[pa.Array]:
        found = table.encode_batch(texts)
        offsets = np.cumsum([0, *[len(x) for x in found]]).astype("int32")
        out: list[pa.Array] = [pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*found, np.empty(0, "int32")])))]
        if decoded:
            out.append(pa.array([table.decode(x.tolist()) for x in found], pa.string()))
        return out

    add: list[tuple[str, T.DataType]] = [(ids, T.ArrayType(T.IntegerType()))]
    return _mapped(df, path, text, add + ([(decoded, T.StringType())] if decoded else []), make)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the column ``text`` decoded from the array column ``ids`` (null: empty text)."""
    def make(table: PrefixTable, rows: list[list[int] | None]) -> list[pa.Array]:
        return [pa.array([table.decode(x or []) for x in rows], pa.string())]

    return _mapped(df, path, ids, [(text, T.StringType())], make)

"""Sequential folds over independent pieces of a key.

``repartition(piece)`` + ``sortWithinPartitions(piece, order)`` + one ``mapInArrow`` pass: each task receives whole
pieces in order. The fold is given as ``scan(columns, starts, state) -> (records, state)`` and ``close(state) ->
records``: ``scan`` walks a batch's columns (``starts`` marks where pieces begin), closes every piece that ends inside
the batch and returns the open state of the last one; the state -- not the rows -- is carried into the next Arrow
batch, and ``close`` finishes a piece once the next piece (or the partition's end) shows it is complete. Memory is one
batch plus a small state, however long a piece is. Pieces of a hot key are hash-spread over tasks.

Values keep their Arrow types: long integers stay exact, nulls stay nulls and are equal to each other as keys; times
are micro-seconds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Scan = Callable[[dict[str, list], list[bool], object], tuple[list[tuple], object]]
Close = Callable[[object], list[tuple]]


def piece_starts(b: pa.RecordBatch, piece: Sequence[str]) -> list[bool]:
    """True where a new piece begins (rows sorted by piece); the first row always begins one."""
    n = b.num_rows
    starts = pa.array([False] * max(n - 1, 0), pa.bool_())
    for name in piece:
        c = b.column(b.schema.get_field_index(name))
        now, before = c.slice(1), c.slice(0, max(n - 1, 0))
        changed = pc.fill_null(pc.not_equal(now, before), False)
        starts = pc.or_(starts, pc.or_(changed, pc.xor(pc.is_null(now), pc.is_null(before))))
    return ([True] + starts.to_pylist())[:n]


def values(c: pa.Array) -> list:
    """A column as Python values, times as micro-seconds."""
    if pa.types.is_timestamp(c.type):
        c = c.cast(pa.timestamp("us", c.type.tz)).cast(pa.int64())
    return c.to_pylist()


def fold_pieces(df: DataFrame, piece: Sequence[str], order: Sequence[str], schema: T.StructType, scan: Scan, close: Close,
                num_partitions: int | None = None) -> DataFrame:
    """Run the fold over every piece; records are tuples in the order of ``schema``."""
    piece, order = list(piece), list(order)
    # without a count AQE sizes the exchange (it only merges partitions, never splits a piece)
    parts = df.repartition(num_partitions, *piece) if num_partitions else df.repartition(*piece)
    parts = parts.sortWithinPartitions(*piece, *order)
    fields = list(to_arrow_schema(schema))

    def table(records: list[tuple]) -> pa.RecordBatch:
        columns = []
        for f, column in zip(fields, zip(*records)):
            if pa.types.is_timestamp(f.type):
                columns.append(pa.array(column, pa.int64()).cast(pa.timestamp("us", f.type.tz)).cast(f.type))
            else:
                columns.append(pa.array(column, f.type))
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, last = None, None
        for b in batches:
            if not b.num_rows:
                continue
            columns = {name: values(b.column(i)) for i, name in enumerate(b.schema.names)}
            starts = piece_starts(b, piece)
            out: list[tuple] = []
            if state is not None:
                if [columns[c][0] for c in piece] == last:
                    starts[0] = False          # the open piece continues here
                else:
                    out += close(state)
                    state = None
            records, state = scan(columns, starts, state)
            out += records
            last = [columns[c][-1] for c in piece]
            if out:
                yield table(out)
        if state is not None and (out := close(state)):
            yield table(out)

    return parts.mapInArrow(run, schema)

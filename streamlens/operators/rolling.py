"""Rolling (unwindowed) keyed aggregates and value-jump alerts (#24-#26, #53, #54).

One output row per input row, in the order given by ``order`` (ties are taken in
some order: add a tie-break column for a fixed one). Running sums/minimums and the previous value use the
skew-safe scan of :mod:`streamlens.operators.scan`, so a hot key is split over many
tasks instead of one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlens.operators.scan import running, sequence_number


def rolling_sum(df: DataFrame, key: str, value: str, order: Sequence[str], out: str = "sum",
                num_parts: int | None = None) -> DataFrame:
    """#24 ``keyBy(k).sum(v)``: running sum per key."""
    return running(df, keys=[key], order=order, value=value, agg="sum", out=out, num_parts=num_parts)


def rolling_min(df: DataFrame, key: str, value: str, order: Sequence[str], out: str = "min",
                num_parts: int | None = None) -> DataFrame:
    """#26 running minimum per key; the row keeps its own (latest) timestamp."""
    return running(df, keys=[key], order=order, value=value, agg="min", out=out, num_parts=num_parts)


def rolling_list(df: DataFrame, key: str, value: str, order: Sequence[str], out: str = "items") -> DataFrame:
    """#25 rolling reduce by list concatenation: each row carries every earlier value
    of its key plus its own, in order (``value`` may be an array: lists are flattened).

    The output itself grows quadratically with a key's length (that is the
    operator's result), so this uses Spark's sort-based window directly: rows of a
    key stream through one sorted frame rather than a carry-in.
    """
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    is_array = dict(df.dtypes)[value].startswith("array")
    col = F.flatten(F.collect_list(value).over(w)) if is_array else F.collect_list(value).over(w)
    return df.withColumn(out, col)


def list_segments(df: DataFrame, key: str, value: str, order: Sequence[str], size: int = 256) -> DataFrame:
    """#25 stored in linear space: (``key``, segment, rows), the rows of a key in segments of ``size`` as (seq, value)
    structs in order. Any prefix of a key's list is the segments in front of it and a part of one more
    (:func:`list_prefix`); no row of this table and no group holds more than ``size`` values, however long a key is."""
    d = sequence_number(df.select(*dict.fromkeys([key, value, *order])), keys=[key], order=order, out="seq")
    rows = F.array_sort(F.collect_list(F.struct("seq", F.col(value).alias("value"))))
    return d.groupBy(key, F.expr(f"(seq - 1) div {int(size)}").alias("segment")).agg(rows.alias("rows"))


def list_prefix(segments: DataFrame, wanted: DataFrame, key: str, out: str = "items", size: int = 256) -> DataFrame:
    """#25 the list after row ``seq`` of a key, for the (``key``, seq) rows of ``wanted`` (distinct), from segments of
    ``size``: equi-joins on (key, segment), so the segments of a hot key are spread. Nulls are left out, arrays are
    joined, as in :func:`rolling_list`; a ``seq`` behind the key's last row gives its whole list."""
    ask = wanted.select(F.col(key).alias("_k"), "seq", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(seq - 1) div {int(size)}"))).alias("_s")).alias("a")
    hit = ask.join(segments.alias("s"), F.col("a._k").eqNullSafe(F.col(f"s.{key}")) & (F.col("a._s") == F.col("s.segment")))
    part = F.filter("s.rows", lambda r: (r["seq"] <= F.col("a.seq")) & r["value"].isNotNull())
    many = "array<struct<seq:bigint,value:array" in dict(segments.dtypes)["rows"]
    values = F.flatten(F.transform(part, lambda r: r["value"])) if many else F.transform(part, lambda r: r["value"])
    whole = hit.groupBy(F.col("a._k").alias(key), F.col("a.seq").alias("seq")).agg(F.array_sort(F.collect_list(F.struct(F.col("a._s").alias("s"), values.alias("v")))).alias("_p"))
    return whole.select(key, "seq", F.flatten(F.transform("_p", lambda p: p["v"])).alias(out))


def previous_value(df: DataFrame, key: str, value: str, order: Sequence[str], out: str = "last",
                   num_parts: int | None = None) -> DataFrame:
    """``lag(value)`` per key, skew-safe."""
    return running(df, keys=[key], order=order, value=value, agg="last", inclusive=False,
                   out=out, num_parts=num_parts)


def jump_alert(df: DataFrame, key: str, value: str, order: Sequence[str], threshold: float = 1.7,
               initial: float | None = None, out: str = "last") -> DataFrame:
    """#53/#54 rows whose value moved more than ``threshold`` from the key's previous
    value: (row..., last). With ``initial`` set (#53, 0.0 in the reference) the first
    row compares against it; without (#54) the first row never fires."""
    prev = previous_value(df, key, value, order, out=out)
    if initial is not None:
        prev = prev.withColumn(out, F.coalesce(F.col(out), F.lit(float(initial))))
    return prev.filter(F.abs(F.col(value) - F.col(out)) > threshold)

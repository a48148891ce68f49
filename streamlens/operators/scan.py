"""Skew-safe running aggregates and neighbours (segmented prefix scans).

``max(x) OVER (PARTITION BY k ORDER BY t ROWS UNBOUNDED PRECEDING)`` sends every row of a key -- or, with
no key, the whole table -- to one task. At scale a single hot key (or the global event-time watermark) then
runs on one core. Here the order axis is cut, and the same values come from a parallel prefix scan:

1. cut: a row's bucket is the number of cut points below its first order column. The cut points are ``n``
   approximate quantiles of that column, one row that the plan itself computes (a scalar subquery), so the
   cut is one pure expression: nothing is sampled twice, written or checkpointed, and building a query runs
   no job;
2. the aggregate of each (key, bucket): partial aggregation, a few rows per key;
3. the carry into a (key, bucket): a window over those few rows;
4. the carry joins the rows of its (key, bucket) as one more row that sorts first, and a window per
   (key, bucket) runs over both. No join, so null keys and tied order columns are safe, and wide rows
   cross the network once.

A hot key is spread over its buckets. The first order column must be a number, date or timestamp; other
types are not cut (one bucket per key), and rows with one and the same value of it share a bucket.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AGGS = ("sum", "count", "min", "max", "last")


def _axis(df: DataFrame, column: str) -> Column | None:
    """The order column as a long or double that can be cut; None if it can't."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(column).cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("long")
    return F.col(column) if isinstance(kind, T.NumericType) else None


def cut(df: DataFrame, order: Sequence[str], num_parts: int | None = None, out: str = "_b") -> DataFrame:
    """Add the bucket number ``out``, increasing in ``order[0]`` (nulls first)."""
    n = int(num_parts or df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    axis = _axis(df, order[0])
    if axis is None or n < 2:
        return df.withColumn(out, F.lit(0))
    points = df.select(axis.alias("x")).agg(F.percentile_approx("x", [i / n for i in range(1, n)], 10_000).alias("p"))
    # two levels: the block of cut points first, then the points of that block
    step = max(1, math.isqrt(n))
    d = df.withColumn("_x", axis).withColumn("_p", points.scalar())
    heads = F.filter("_p", lambda p, i: (i % step == 0) & (p < F.col("_x")))
    d = d.withColumn("_h", F.greatest(F.size(heads) - 1, F.lit(0)) * step)
    inner = F.size(F.filter(F.slice("_p", F.col("_h") + 1, step), lambda p: p < F.col("_x")))
    bucket = F.when(F.col("_x").isNull() | F.col("_p").isNull(), F.lit(-1)).otherwise(F.col("_h") + inner)
    return d.withColumn(out, bucket).drop("_x", "_p", "_h")


def _nulls(df: DataFrame, but: dict[str, Column]) -> list[Column]:
    """The columns of ``df`` as nulls, except those given."""
    return [but[f.name].alias(f.name) if f.name in but else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]


def running(df: DataFrame, *, order: Sequence[str], out: str, agg: str, value: str | Column | None = None,
            keys: Sequence[str] = (), inclusive: bool = True, num_parts: int | None = None) -> DataFrame:
    """Add ``out`` = ``agg(value)`` over the earlier rows of the same ``keys`` in ``order``.

    Every row comes out once; rows tied in ``order`` are taken in some order (add a tie-break column for a
    fixed one). Null keys are a key. ``inclusive`` includes the row itself; otherwise the frame ends at the
    previous row (so ``agg="last"``, ``inclusive=False`` is ``lag(value, 1)``). ``count`` ignores ``value``.
    An empty frame gives null (0 for ``count``).
    """
    if agg not in _AGGS:
        raise ValueError(f"agg must be one of {_AGGS}")
    keys, order = list(keys), list(order)
    v = F.lit(1).cast("long") if agg == "count" else (F.col(value) if isinstance(value, str) else value)
    if agg == "last":  # the latest row wins: compare (order..., value) structs
        v = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)], v.alias("v"))
    total = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max, "last": F.max}[agg]
    d = cut(df, order, num_parts).withColumn("_v", v)
    edges = d.groupBy(*keys, "_b").agg(total("_v").alias("_v"))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = edges.withColumn("_v", total("_v").over(before)).where(F.col("_v").isNotNull())
    kind = edges.schema["_v"].dataType  # a sum may be wider than its values
    rows = d.withColumn("_v", F.col("_v").cast(kind)).withColumn("_first", F.lit(1))
    first = carry.select(*_nulls(rows, {**{k: F.col(k) for k in keys}, "_b": F.col("_b"), "_v": F.col("_v").cast(kind), "_first": F.lit(0)}))
    both = rows.unionByName(first)
    frame = Window.partitionBy(*keys, "_b").orderBy("_first", *order).rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    res = total("_v").over(frame)
    if agg == "last":
        res = res.getField("v")
    elif agg == "count":
        res = F.coalesce(res, F.lit(0)).cast("long")
    return both.withColumn("_r", res).where("_first = 1").drop("_b", "_v", "_first", *([out] if out in df.columns else [])).withColumnRenamed("_r", out)


def sequence_number(df: DataFrame, *, order: Sequence[str], out: str = "seq",
                    keys: Sequence[str] = (), num_parts: int | None = None) -> DataFrame:
    """1-based position of each row within its key in ``order`` (skew-safe ``row_number``)."""
    return running(df, order=order, out=out, agg="count", keys=keys, num_parts=num_parts)


def following(df: DataFrame, *, keys: Sequence[str], order: Sequence[str], cols: Sequence[str], ahead: int,
              num_parts: int | None = None) -> DataFrame:
    """``lead``: add ``{col}_n{j}`` for j = 1..``ahead``, the values ``j`` rows further in the same key (null
    behind the last row).

    Local windows per (key, bucket); a bucket's last rows look into copies of the next ``ahead`` rows of the
    key, found among the first ``ahead`` rows of each (key, bucket)."""
    keys, order = list(keys), list(order)
    d = cut(df, order, num_parts).withColumn("_next", F.struct(*[F.col(c) for c in cols]))
    local = Window.partitionBy(*keys, "_b").orderBy(*order)
    heads = d.withColumn("_i", F.row_number().over(local)).where(F.col("_i") <= ahead).select(*keys, *[c for c in order if c not in keys], "_b", "_i", "_next")
    # what comes after a bucket: the heads behind its last head, in order
    along = Window.partitionBy(*keys).orderBy("_b", "_i")
    after = F.array(*[F.lead(F.struct("_b", "_next"), j).over(along) for j in range(1, 2 * ahead)])
    last = heads.withColumn("_after", after).where("_i = 1")
    last = last.withColumn("_after", F.slice(F.filter("_after", lambda a: a["_b"] > F.col("_b")), 1, ahead))
    copies = last.select(*keys, "_b", F.posexplode("_after").alias("_at", "_a"))
    rows = d.withColumn("_at", F.lit(-1))
    tail = copies.select(*_nulls(rows, {**{k: F.col(k) for k in keys}, "_b": F.col("_b"), "_next": F.col("_a._next"), "_at": F.col("_at")}))
    both = rows.unionByName(tail)
    w = Window.partitionBy(*keys, "_b").orderBy("_at", *order)
    for j in range(1, ahead + 1):
        both = both.withColumn(f"_n{j}", F.lead("_next", j).over(w))
    named = [F.col(f"_n{j}").getField(c).alias(f"{c}_n{j}") for j in range(1, ahead + 1) for c in cols]
    return both.where("_at = -1").select(*df.columns, *named)

"""Window aggregates (#27-#40).

Tumbling and sliding windows are ``F.window`` (epoch aligned, start inclusive, end
exclusive); results are labelled by window end and only non-empty windows appear.
Aggregates are partial + final hash aggregates, so a hot key or a hot window is
combined map-side before the shuffle. Sliding view and visitor counts use the *pane* form:
aggregate once per slide-sized pane, then expand panes (not rows) into windows.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions.scalar import WORD_SPLIT, poly_hash

_UNITS = {"ms": 0.001, "millisecond": 0.001, "milliseconds": 0.001,
          "s": 1, "sec": 1, "second": 1, "seconds": 1,
          "min": 60, "minute": 60, "minutes": 60,
          "h": 3600, "hour": 3600, "hours": 3600,
          "day": 86400, "days": 86400}


def seconds(duration: str | int | float) -> float:
    """``"5 minutes"`` -> 300.0 (numbers are taken as seconds)."""
    if isinstance(duration, (int, float)):
        return float(duration)
    part = r"\s*(\d+(?:\.\d+)?)\s*([a-zA-Z]+)"
    if not re.fullmatch(f"(?:{part})+\\s*", duration):
        raise ValueError(f"not a duration: {duration!r}")
    total = 0.0
    for num, unit in re.findall(part, duration):
        if unit.lower() not in _UNITS:
            raise ValueError(f"unknown unit in {duration!r}")
        total += float(num) * _UNITS[unit.lower()]
    return total


def interval(duration: str | int | float) -> Column:
    """A day-time interval literal for ``duration`` (a literal, so streaming join
    analysis can read the time bound of a range condition)."""
    return F.expr(f"INTERVAL {int(round(seconds(duration) * 1e6))} MICROSECONDS")


def window_agg(df: DataFrame, ts: str, size: str, aggs: dict[str, Column], slide: str | None = None,
               keys: tuple[str, ...] = ()) -> DataFrame:
    """``groupBy(window(ts, size[, slide]), keys).agg(aggs)`` -> keys, window_end, aggs."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    return (df.groupBy(*keys, w.alias("w")).agg(*[c.alias(n) for n, c in aggs.items()])
            .select(*keys, F.col("w.end").alias("window_end"), *aggs))


def _epoch_us(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))


def pane_counts(df: DataFrame, ts: str, size: str, slide: str, keys: tuple[str, ...] = (),
                out: str = "count", block_windows: int = 16) -> DataFrame:
    """Sliding-window counts in pane form, expanded *after* the shuffle.

    1. count per (keys, slide-sized pane): partial aggregation map-side;
    2. a pane feeds the windows ending in ``[pane_end, pane_end + size - slide]``;
       copy it to the one or two time *blocks* (``block_windows * size`` long) those
       ends fall in;
    3. shuffle panes on (keys, block) -- about 2 rows per pane instead of
       ``size/slide`` rows per input row;
    4. inside each task expand panes to window ends of that block and sum; the
       partitioning on (keys, block) already satisfies the final aggregate, so no
       second exchange.

    Per-task work is bounded by ``(block/slide) * (size/slide)``, a parameter bound:
    a hot key is split over its time blocks. Same rows as the direct form.
    """
    k = int(round(seconds(size) / seconds(slide)))
    if abs(k * seconds(slide) - seconds(size)) > 1e-9:
        raise ValueError("pane form needs size to be a multiple of slide")
    step_us = int(seconds(slide) * 1e6)
    blk_us = int(seconds(size) * 1e6) * block_windows
    panes = (df.groupBy(*keys, F.window(ts, slide).getField("end").alias("_pe"))
             .agg(F.count(F.lit(1)).alias("_n")))
    # integer microseconds from here on: the expansion is plain long arithmetic
    panes = panes.select(*keys, "_n", _epoch_us(F.col("_pe")).alias("_pe"))
    first_blk = F.floor(F.col("_pe") / F.lit(blk_us))
    last_blk = F.floor((F.col("_pe") + F.lit((k - 1) * step_us)) / F.lit(blk_us))
    rep = panes.withColumn("_blk", F.explode(F.sequence(first_blk, last_blk)))
    # explicit count: AQE would coalesce this (small) pane shuffle into a few tasks,
    # but each pane expands size/slide-fold after it
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rep = rep.repartition(n, *keys, "_blk")
    exp = rep.select(*keys, "_blk", "_n",
                     F.explode(F.sequence(F.col("_pe"), F.col("_pe") + F.lit((k - 1) * step_us),
                                          F.lit(step_us))).alias("_we"))
    exp = exp.filter(F.floor(F.col("_we") / F.lit(blk_us)) == F.col("_blk"))
    agg = exp.groupBy(*keys, "_blk", "_we").agg(F.sum("_n").alias(out))
    end = F.timestamp_micros(F.col("_we")).cast(df.schema[ts].dataType)
    return agg.select(*keys, end.alias("window_end"), out)


# ---- named window jobs -------------------------------------------------------

def word_count(docs: DataFrame, size: str = "5 seconds", text: str = "text", ts: str = "ts") -> DataFrame:
    """#27 tokens counted per word in tumbling windows."""
    toks = docs.select(ts, F.explode(F.split(F.col(text), WORD_SPLIT)).alias("word")).filter(F.col("word") != "")
    return window_agg(toks, ts, size, {"count": F.count(F.lit(1))}, keys=("word",))


def avg_count(sensor: DataFrame, size: str = "16 seconds") -> DataFrame:
    """#28 (id, avg temperature, n) per tumbling window (an AggregateFunction with merge
    = Spark's partial/final avg)."""
    return window_agg(sensor, "ts", size, {"avg_temp": F.avg("temperature"),
                                            "n": F.count(F.lit(1))}, keys=("id",))


def min_max(sensor: DataFrame, size: str = "5 seconds") -> DataFrame:
    """#29/#30 (id, min, max, window end); incremental (constant-size state)."""
    return window_agg(sensor, "ts", size, {"min_temp": F.min("temperature"),
                                            "max_temp": F.max("temperature")}, keys=("id",))


def min_reduce(sensor: DataFrame, size: str = "15 seconds") -> DataFrame:
    """#31 windowed reduce keeping the minimum."""
    return window_agg(sensor, "ts", size, {"min_temp": F.min("temperature")}, keys=("id",))


def count_per_key(df: DataFrame, key: str = "key", ts: str = "ts", size: str = "5 seconds",
                  bound: str | None = None) -> DataFrame:
    """#32/#33 element count per key and event-time window. ``bound`` sets the
    watermark on streams (batch input is complete, so it only matters there)."""
    if bound and df.isStreaming:
        df = df.withWatermark(ts, bound)
    return window_agg(df, ts, size, {"count": F.count(F.lit(1))}, keys=(key,))


def view_counts(df: DataFrame, key: str, ts: str = "ts", size: str = "60 minutes",
                slide: str = "5 minutes") -> DataFrame:
    """#34/#35 views per key in sliding windows, in pane form (see :func:`pane_counts`)."""
    return pane_counts(df, ts, size, slide, keys=(key,)).select(key, "window_end", "count")


def pv_count(behavior: DataFrame, size: str = "60 minutes", slide: str = "5 minutes") -> DataFrame:
    """#36 page views per window. No constant key: partial aggregation spreads the load."""
    pv = behavior.filter(F.col("behavior") == "pv")
    return window_agg(pv, "ts", size, {"pv": F.count(F.lit(1))}, slide=slide)


def _distinct_per_window(df: DataFrame, column: str, size: str, slide: str, ts: str = "ts") -> DataFrame:
    """Distinct values of ``column`` per sliding window: a value counts once per pane, so the
    shuffle carries (pane, value) pairs; panes become windows after it, and (window, value) is
    deduplicated again by partial aggregation."""
    k = int(round(seconds(size) / seconds(slide)))
    if abs(k * seconds(slide) - seconds(size)) > 1e-9:
        raise ValueError("pane form needs size to be a multiple of slide")
    pane = df.select(F.window(ts, slide).getField("end").alias("_pe"), column).distinct()
    step = interval(slide)
    ends = F.sequence(F.col("_pe"), F.col("_pe") + interval(seconds(slide) * (k - 1)), step) if k > 1 else F.array("_pe")
    per = pane.select(F.explode(ends).alias("window_end"), column).distinct()
    return per.groupBy("window_end").agg(F.count(column).alias("uv"))


def uv_exact(behavior: DataFrame, size: str = "60 minutes", slide: str = "5 minutes",
             user: str = "user_id") -> DataFrame:
    """#37 distinct users per window."""
    return _distinct_per_window(behavior.filter(F.col("behavior") == "pv").select("ts", user), user, size, slide)


def uv_bitmap(behavior: DataFrame, size: str = "60 minutes", slide: str = "5 minutes",
              user: str = "user_id", bits: int = 16) -> DataFrame:
    """#38 the one-hash bitmap: count distinct ``poly_hash(user as text)`` (2^bits
    positions), so colliding users count once, as in the bitmap job."""
    pv = behavior.filter(F.col("behavior") == "pv").select(
        "ts", poly_hash(F.col(user).cast("string"), bits=bits).alias("_h"))
    return _distinct_per_window(pv, "_h", size, slide)


def uv_approx(behavior: DataFrame, size: str = "60 minutes", slide: str = "5 minutes",
              user: str = "user_id", rsd: float = 0.01) -> DataFrame:
    """Built-in HyperLogLog++ alternative to #37/#38 (fixed-size sketch per window).
    Approximate in general; at the test data's per-window cardinalities (tens of
    users) HLL++ is exact, which is why its reference SQL is the exact count."""
    pv = behavior.filter(F.col("behavior") == "pv")
    return window_agg(pv, "ts", size, {"uv": F.approx_count_distinct(user, rsd)}, slide=slide)


def marketing_total(m: DataFrame, size: str = "5 seconds", slide: str = "1 second") -> DataFrame:
    """#39 all behaviors except UNINSTALL, per sliding window."""
    kept = m.filter(F.col("behavior") != "UNINSTALL")
    return window_agg(kept, "ts", size, {"count": F.count(F.lit(1))}, slide=slide)


def marketing_by_channel(m: DataFrame, size: str = "5 seconds", slide: str = "1 second") -> DataFrame:
    """#40 count per (channel, behavior) per sliding window (behavior kept in the output)."""
    kept = m.filter(F.col("behavior") != "UNINSTALL")
    return window_agg(kept, "ts", size, {"count": F.count(F.lit(1))}, slide=slide,
                      keys=("channel", "behavior"))

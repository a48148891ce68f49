"""Watermarks, late data, allowed lateness and early firings (#45-#52), batch form.

Batch contract: rows arrive in ``arrival`` order; before arrival *i* the watermark is
``wm_i = max(ts of earlier arrivals) - bound`` (null for the first row: nothing is
late then). A window [start, end) closes when ``wm >= end - 1 ms``.

``wm_i`` is a running max over the whole input. A plain global window would run in
one task; here it is the skew-safe prefix scan (range partitions + bounded carry).
The streaming forms (``withWatermark``) live in :mod:`streamlens.streaming`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlens.operators.scan import running
from streamlens.operators.windows import seconds



def _one_ms():
    return F.make_dt_interval(secs=F.lit(0.001))


def with_watermark(df: DataFrame, ts: str, arrival: Sequence[str], bound: str | float,
                   out: str = "wm", num_parts: int | None = None) -> DataFrame:
    """#45-#47 per-row watermark. Bounded out-of-orderness = ``bound``; ascending
    timestamps = ``"1 millisecond"``; the periodic extractor of the reference = 1 s."""
    d = running(df, order=arrival, value=ts, agg="max", inclusive=False, out="_maxts",
                num_parts=num_parts)
    return d.withColumn(out, F.col("_maxts") - F.make_dt_interval(secs=F.lit(seconds(bound)))).drop("_maxts")


def ascending_watermark(df: DataFrame, ts: str, arrival: Sequence[str], out: str = "wm") -> DataFrame:
    """#46 ascending timestamps: the watermark trails the max event time by 1 ms."""
    return with_watermark(df, ts, arrival, "1 millisecond", out=out)


def periodic_watermark(df: DataFrame, ts: str, arrival: Sequence[str], bound: str = "1 second",
                       out: str = "wm") -> DataFrame:
    """#47 the periodic extractor: max event time minus a fixed bound (1 s). Before the
    first row the watermark is null, not a wrapped minimum value."""
    return with_watermark(df, ts, arrival, bound, out=out)


def _tumble_end(ts: str, size: str):
    return F.window(ts, size).getField("end")


def late_rows(df: DataFrame, ts: str, arrival: Sequence[str], bound: str | float,
              num_parts: int | None = None) -> DataFrame:
    """#49 ``is_late = ts < wm_i`` (main output = not late, side output = late)."""
    d = with_watermark(df, ts, arrival, bound, num_parts=num_parts)
    return d.withColumn("is_late", F.coalesce(F.col(ts) < F.col("wm"), F.lit(False)))


def late_windows(df: DataFrame, key: str, ts: str, arrival: Sequence[str], size: str,
                 bound: str | float, num_parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """#48 per-key tumbling counts of on-time rows, and the late rows (whose window had
    closed when they arrived: ``window_end - 1 ms <= wm_i``)."""
    d = with_watermark(df, ts, arrival, bound, num_parts=num_parts)
    d = d.withColumn("window_end", _tumble_end(ts, size))
    d = d.withColumn("is_late", F.coalesce(F.col("window_end") - _one_ms() <= F.col("wm"), F.lit(False)))
    counts = (d.filter(~F.col("is_late")).groupBy(key, "window_end")
              .agg(F.count(F.lit(1)).alias("count")))
    late = d.filter(F.col("is_late")).drop("is_late")
    return counts, late


def allowed_lateness(df: DataFrame, key: str, ts: str, arrival: Sequence[str], size: str,
                     bound: str | float, lateness: str | float,
                     num_parts: int | None = None) -> DataFrame:
    """#50 window firings with allowed lateness.

    The first firing counts the on-time rows (``wm_i < end - 1 ms``). Each row that
    arrives after the window closed but while ``wm_i < end - 1 ms + lateness`` fires
    again with the cumulative count (on-time rows plus the late rows so far, in
    arrival order); with no on-time row, the first such row gives the first firing.
    Later rows are dropped. Output: key, window_end, firing (0 = first), count,
    is_update.
    """
    d = with_watermark(df, ts, arrival, bound, num_parts=num_parts)
    d = d.withColumn("window_end", _tumble_end(ts, size))
    close = F.col("window_end") - _one_ms()
    lat = F.make_dt_interval(secs=F.lit(seconds(lateness)))
    d = d.withColumn("_state", F.when(F.col("wm").isNull() | (F.col("wm") < close), F.lit(0))
                     .when(F.col("wm") < close + lat, F.lit(1)).otherwise(F.lit(2)))
    on_time = (d.filter(F.col("_state") == 0).groupBy(key, "window_end")
               .agg(F.count(F.lit(1)).alias("_n0")))
    late = d.filter(F.col("_state") == 1).select(key, "window_end", *arrival)
    # cumulative rank of each late row within its window (skew-safe running count)
    late = running(late, keys=[key, "window_end"], order=arrival, agg="count", out="_r",
                   num_parts=num_parts)
    first = on_time.select(key, "window_end", F.lit(0).alias("firing"),
                           F.col("_n0").alias("count"), F.lit(False).alias("is_update"))
    has_first = F.col("_n0").isNotNull()
    upd = (late.join(on_time, [key, "window_end"], "left")
           .select(key, "window_end",
                   F.when(has_first, F.col("_r")).otherwise(F.col("_r") - 1).alias("firing"),
                   (F.coalesce(F.col("_n0"), F.lit(0)) + F.col("_r")).alias("count"),
                   (has_first | (F.col("_r") > 1)).alias("is_update")))
    return first.unionByName(upd)


def early_firings(df: DataFrame, key: str, ts: str, size: str, tick: str = "1 second") -> DataFrame:
    """#51 early-firing trigger: per window, the running count at each whole ``tick``
    after the window's first row, and the final count at the window end, also where
    ``tick`` does not divide the window.

    Rows are counted into tick panes (``count(ts < tick)`` = cumulative sum of panes);
    ticks per window are ``size/tick`` at most, a parameter bound, not a data bound.
    Output: key, window_end, fire_time, count, is_final.
    """
    step = F.make_dt_interval(secs=F.lit(seconds(tick)))
    d = df.select(key, ts, F.window(ts, size).getField("end").alias("window_end"))
    # pane = the first tick after ts; a window's last pane ends with the window
    pane = F.least(F.window(ts, tick).getField("end"), F.col("window_end"))
    panes = d.groupBy(key, "window_end", pane.alias("fire_time")).agg(F.count(F.lit(1)).alias("_n"))
    firsts = panes.groupBy(key, "window_end").agg(F.min("fire_time").alias("_first"))
    times = F.array_union(F.sequence("_first", "window_end", step), F.array("window_end"))
    ticks = firsts.select(key, "window_end", F.explode(times).alias("fire_time"))
    rows = (panes.select(key, "window_end", "fire_time", "_n")
            .unionByName(ticks.withColumn("_n", F.lit(0).cast("long")))
            .groupBy(key, "window_end", "fire_time").agg(F.sum("_n").alias("_n")))
    wr = Window.partitionBy(key, "window_end").orderBy("fire_time").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select(key, "window_end", "fire_time", F.sum("_n").over(wr).alias("count"),
                       (F.col("fire_time") == F.col("window_end")).alias("is_final"))


def per_row_updates(df: DataFrame, key: str, ts: str, arrival: Sequence[str], size: str,
                    slide: str | None = None, num_parts: int | None = None) -> DataFrame:
    """#52 per-row trigger: every arriving row re-evaluates its window(s) and emits the
    number of distinct ``key`` values seen so far in that window (arrival order).
    The last update of a window equals the final distinct count."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    d = df.select(*dict.fromkeys([key, ts, *arrival]), w.getField("end").alias("window_end"))
    order_struct = F.struct(*arrival)
    firsts = d.groupBy("window_end", key).agg(F.min(order_struct).alias("_first"))
    d = (d.join(firsts, ["window_end", key])
         .withColumn("_new", (order_struct == F.col("_first")).cast("long")).drop("_first"))
    return running(d, keys=["window_end"], order=arrival, value="_new", agg="sum",
                   out="distinct_so_far", num_parts=num_parts).drop("_new")

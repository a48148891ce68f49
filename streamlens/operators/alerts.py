"""Keyed-state alerts with timers, batch form (#55, #56).

Both are relational: gaps-and-islands with skew-safe scans, partial aggregates and equi-joins; the
re-arming variants follow chains of rows by pointer doubling (:mod:`streamlens.operators.chain`).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.operators.chain import count_inside, spans
from streamlens.operators.rolling import previous_value
from streamlens.operators.scan import running
from streamlens.operators.windows import seconds



def sustained_rise(df: DataFrame, key: str = "id", ts: str = "ts", value: str = "temperature",
                   order: Sequence[str] = ("ts",), hold: str | float = "1 second",
                   rearm: bool = False) -> DataFrame:
    """#55 alert when a key's value keeps rising for ``hold``: the first rise arms a
    timer at ``rise_ts + hold``; a fall cancels it (a fall exactly at the deadline
    too); equal values keep it. The first row of a key has no previous value.

    Default: one alert per run (run = rows between falls). ``rearm=True``: after a
    timer fires, the next rise of the same run arms a new one.
    Output: key, rise_ts, alert_ts.
    """
    h = seconds(hold)
    hold_iv = F.make_dt_interval(secs=F.lit(h))
    d = previous_value(df.select(key, ts, value, *[c for c in order if c not in (key, ts, value)]),
                       key, value, order, out="_prev")
    d = d.withColumn("_rise", F.coalesce(F.col(value) > F.col("_prev"), F.lit(False)))
    d = d.withColumn("_fall", F.coalesce(F.col(value) < F.col("_prev"), F.lit(False)).cast("long"))
    if rearm:
        hold_us = int(round(h * 1e6))
        found = spans(d, key, ts, order, F.col("_rise"), F.col("_fall") == 1, hold_us)
        kind = df.schema[ts].dataType
        return found.select(key, F.timestamp_micros("start_us").cast(kind).alias("rise_ts"), F.timestamp_micros(F.col("start_us") + hold_us).cast(kind).alias("alert_ts"))
    d = running(d, keys=[key], order=order, value="_fall", agg="sum", out="_run")
    runs = d.groupBy(key, "_run").agg(F.min(F.when(F.col("_rise"), F.col(ts))).alias("_first_rise"),
                                      F.min(ts).alias("_start"))
    nxt = runs.select(key, (F.col("_run") - 1).alias("_run"), F.col("_start").alias("_next_fall"))
    runs = runs.join(nxt, [key, "_run"], "left")
    deadline = F.col("_first_rise") + hold_iv
    return (runs.filter(F.col("_first_rise").isNotNull()
                        & (F.col("_next_fall").isNull() | (F.col("_next_fall") > deadline)))
            .select(key, F.col("_first_rise").alias("rise_ts"), deadline.alias("alert_ts")))


def repeated_failures(df: DataFrame, key: str = "user_id", ts: str = "ts", event: str = "event_type",
                      fail: str = "fail", success: str = "success", span: str | float = "5 seconds",
                      min_fails: int = 2, rearm: bool = False) -> DataFrame:
    """#56 the first fail of a key opens ``[t0, t0 + span]``; a success in the span
    cancels it; at the span end, ``min_fails`` or more fails raise one alert.

    Default (the literal keyed-timer rule): only the key's first fail opens a span,
    so a key alerts at most once -- a skew-safe running minimum and a partial aggregate.
    ``rearm=True``: after a cancel or an alert the next
    fail opens a new span. Output: key, span_start, span_end, n_fails.
    """
    sp = seconds(span)
    span_iv = F.make_dt_interval(secs=F.lit(sp))
    # at one instant failures come before successes, so a success cancels them
    ev = df.filter(F.col(event).isin(fail, success)).select(key, ts, event, (F.col(event) == success).cast("int").alias("_tb"))
    if not rearm:
        first = F.when(F.col(event) == fail, F.col(ts))
        inside = running(ev, keys=[key], order=[ts, "_tb"], value=first, agg="min", out="span_start").filter(
            F.col(ts) <= F.col("span_start") + span_iv)
        agg = inside.groupBy(key, "span_start").agg(
            F.sum((F.col(event) == fail).cast("long")).alias("n_fails"),
            F.sum((F.col(event) == success).cast("long")).alias("_n_ok"))
        return (agg.filter((F.col("n_fails") >= min_fails) & (F.col("_n_ok") == 0))
                .select(key, "span_start", (F.col("span_start") + span_iv).alias("span_end"), "n_fails"))
    span_us = int(round(sp * 1e6))
    starts = spans(ev, key, ts, [ts, "_tb"], F.col(event) == fail, F.col(event) == success, span_us)
    found = count_inside(starts, ev.filter(F.col(event) == fail), key, ts, span_us, "n_fails").filter(F.col("n_fails") >= min_fails)
    kind = df.schema[ts].dataType
    return found.select(key, F.timestamp_micros("start_us").cast(kind).alias("span_start"),
                        F.timestamp_micros(F.col("start_us") + span_us).cast(kind).alias("span_end"), "n_fails")

"""Streaming window aggregates (no Python in the plan) and top-N per window.

Inputs must carry an event-time TIMESTAMP column with a watermark
(:func:`with_event_time`). Results keep the ``window`` struct so that a following
aggregation can chain on it in append mode.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from streamlens.functions.scalar import poly_hash
from streamlens.operators.topn import report_line, report_text


def with_event_time(df: DataFrame, ts: str = "ts", bound: str = "0 seconds") -> DataFrame:
    """Cast ``ts`` to TIMESTAMP (watermarks reject TIMESTAMP_NTZ) and set the
    bounded out-of-orderness watermark (#45-#47)."""
    if dict(df.dtypes)[ts] != "timestamp":
        df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withWatermark(ts, bound)


def window_counts(df: DataFrame, key: str | None, ts: str, size: str, slide: str | None = None,
                  out: str = "count") -> DataFrame:
    """#27/#32-#36/#39/#40: count per (window, key). Append mode emits a window once
    the watermark passes its end; state holds one count per open (window, key)."""
    w = F.window(ts, size, slide) if slide else F.window(ts, size)
    keys = [key] if key else []
    return df.groupBy(w.alias("window"), *keys).agg(F.count(F.lit(1)).alias(out))


def distinct_users(df: DataFrame, user: str, ts: str, size: str, slide: str, bitmap: bool = False) -> DataFrame:
    """#37/#38 on a stream: distinct aggregates are not supported on streams, so
    de-duplicate (window, user) in one aggregation and count in a chained one."""
    u = poly_hash(F.col(user).cast("string")) if bitmap else F.col(user)
    per = df.groupBy(F.window(ts, size, slide).alias("window"), u.alias("_u")).agg(F.count(F.lit(1)).alias("_c"))
    return per.groupBy("window").agg(F.count(F.lit(1)).alias("uv"))


class TopRows(StatefulProcessor):
    """The ``n`` best (count, key) of a group, ties to the smaller key, as one short list in a value state. A key that
    comes again replaces its count: counts only grow, so a key outside the list has at most the least count in it and
    enters with the update that lifts it. The list comes out when the watermark reaches the window's end."""

    def __init__(self, n: int, kind: str):
        self.n, self.kind = n, kind

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.top = handle.getValueState("top", f"keys array<{self.kind}>, counts array<bigint>")
        self.make = Row("end_us", "keys", "counts")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if self.top.exists():
            best = dict(zip(*self.top.get()))
        else:
            best = {}
            self.handle.registerTimer(key[0] // 1000 - 2)
        for r in rows:
            for k, c in zip(r["keys"], r["counts"]):
                best[k] = max(c, best.get(k, c))
            if len(best) > 4 * self.n + 1000:
                best = dict(self._cut(best))
        cut = self._cut(best)
        self.top.update(([k for k, _ in cut], [c for _, c in cut]))
        return iter(())

    def _cut(self, best: dict) -> list[tuple]:
        return heapq.nsmallest(self.n, best.items(), key=lambda e: (-e[1], e[0] is not None, e[0] if e[0] is not None else 0))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        keys, counts = self.top.get()
        self.top.clear()
        yield self.make(key[0], list(keys), list(counts))

    def close(self) -> None:
        pass


def _ranked_top(counts: DataFrame, key: str, n: int, count: str, salts: int) -> DataFrame:
    """(end_us, keys, counts) of each window, ranked: the best ``n`` per (window, hash(key) mod ``salts``), then the best
    ``n`` of those ``salts * n``. No state or task holds more than that of a window."""
    kind = counts.schema[key].dataType.simpleString()
    schema = f"end_us long, keys array<{kind}>, counts array<bigint>"
    rows = counts.select(F.unix_micros("window.end").alias("end_us"), F.pmod(F.xxhash64(key), F.lit(salts)).alias("_salt"),
                         F.array(key).alias("keys"), F.array(F.col(count).cast("long")).alias("counts"))
    part = rows.groupBy("end_us", "_salt").transformWithState(TopRows(n, kind), schema, "Append", "EventTime")
    return part.groupBy("end_us").transformWithState(TopRows(n, kind), schema, "Append", "EventTime")


def top_n(counts: DataFrame, key: str, n: int, count: str = "count", salts: int = 16) -> DataFrame:
    """#41/#42 on a stream, from :func:`window_counts` in append mode (``row_number`` is rejected on streams)."""
    ranked = _ranked_top(counts, key, n, count, salts)
    return ranked.select(F.timestamp_micros("end_us").alias("window_end"), F.posexplode(F.arrays_zip("keys", "counts")).alias("_pos", "_e")).select(
        "window_end", F.col("_e.keys").alias(key), F.col("_e.counts").alias(count), (F.col("_pos") + 1).cast("long").alias("rank"))


def early_counts(df: DataFrame, key: str, ts: str, size: str, bound: str = "0 seconds") -> DataFrame:
    """#51 early (per-trigger) results: the same aggregation in **update** mode,
    started with ``trigger(processingTime='1 second')``: every trigger emits the running
    count of each changed window. (#50, #52: :mod:`streamlens.streaming.late`.)"""
    return window_counts(with_event_time(df, ts, bound), key, ts, size)


def top_n_report(counts: DataFrame, key: str, n: int, count: str = "count", style: str = "item", salts: int = 16) -> DataFrame:
    """#44 on a stream: the ranked text per window."""
    ranked = _ranked_top(counts, key, n, count, salts)
    lines = F.transform(F.arrays_zip("keys", "counts"), lambda e, i: report_line(i + 1, e["keys"], e["counts"], style))
    end = F.timestamp_micros("end_us")
    return ranked.select(end.alias("window_end"), report_text(end, lines, style).alias("report"))

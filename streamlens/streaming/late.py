"""Late data on a stream (#48-#50, #52), on the watermark that Spark itself keeps.

Spark's stateful operators drop rows behind the watermark before an operator sees them. Here the event time goes into
``transformWithState`` as a plain number, without its watermark mark, so every row arrives, and the processor
compares it with the watermark of the micro-batch (``getCurrentWatermarkInMs``: the largest event time of all earlier
batches minus the bound). No second watermark is kept anywhere; state and watermark are in the checkpoint together.

The rules are those of :mod:`streamlens.operators.late`, with a micro-batch in place of a single arrival: a window
[start, end) closes when the watermark reaches end - 1 ms. The watermark counts milliseconds.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from streamlens.functions.scalar import poly_hash
from streamlens.operators.windows import seconds
from streamlens.sources.sinks import fan_out_batches
from streamlens.streaming.ordered import sort_key

Sink = Callable[[DataFrame, int], None]


def _us(duration: str | float) -> int:
    return int(round(seconds(duration) * 1e6))


def _plain(df: DataFrame, ts: str) -> DataFrame:
    """``df`` with ``_t`` (micro-seconds) and ``ts`` without its watermark mark; the watermark itself goes on."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.where(F.col(ts).isNotNull()).select(us.alias("_t"), *[F.timestamp_micros(us).alias(c) if c == ts else F.col(c) for c in df.columns])


def _ends(size_us: int, slide_us: int) -> Column:
    """The ends (micro-seconds) of all windows that hold ``_t``."""
    first = F.col("_t") - F.pmod(F.col("_t"), F.lit(slide_us)) + slide_us
    return F.filter(F.transform(F.sequence(F.lit(0), F.lit(-(-size_us // slide_us) - 1)), lambda k: first + k.cast("long") * slide_us),
                    lambda e: e - size_us <= F.col("_t"))


def _closed(end_us: int, wm_ms: int) -> bool:
    return end_us // 1000 - 1 <= wm_ms


def _close_timer(end_us: int) -> int:
    """Fires once the watermark is at end - 1 ms or behind."""
    return end_us // 1000 - 2


class RowTag(StatefulProcessor):
    """#49 each row with ``is_late``: its time is behind the watermark. No state."""

    def __init__(self, names: Sequence[str]):
        self.names = tuple(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.make = Row(*self.names, "is_late")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        for r in rows:
            yield self.make(*[r[c] for c in self.names], r["_t"] < wm)

    def close(self) -> None:
        pass


def late_rows(df: DataFrame, ts: str, salts: int = 64) -> DataFrame:
    """#49 the rows of a watermarked stream with ``is_late``; rows are dealt evenly, whatever their keys."""
    plain = _plain(df, ts)
    schema = T.StructType([plain.schema[c] for c in df.columns] + [T.StructField("is_late", T.BooleanType())])
    dealt = plain.withColumn("_salt", F.pmod(F.xxhash64(*plain.columns), F.lit(salts)))
    return dealt.groupBy("_salt").transformWithState(RowTag(df.columns), schema, "Append", "EventTime")


class WindowTag(StatefulProcessor):
    """#48 counts per open window in a map state; a window comes out when it closes (one timer per window), a row whose
    window had closed when it arrived comes out as late, at once."""

    def __init__(self, names: Sequence[str]):
        self.names = tuple(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.counts = handle.getMapState("counts", "end_us long", "n long")
        self.make = Row("kind", "key", "end_us", "count", "row")
        self.row = Row(*self.names)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm, new = timerValues.getCurrentWatermarkInMs(), Counter()
        for r in rows:
            if _closed(r["_end"], wm):
                yield self.make("late", key[0], r["_end"], None, self.row(*[r[c] for c in self.names]))
            else:
                new[r["_end"]] += 1
        for end, n in new.items():
            old = self.counts.getValue((end,))
            if old is None:
                self.handle.registerTimer(_close_timer(end))
            self.counts.updateValue((end,), (n + (old[0] if old else 0),))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        # two ends can share a timer only if they share a millisecond, which window ends do not
        end = (expiredTimerInfo.getExpiryTimeInMs() + 2) * 1000
        found = self.counts.getValue((end,))
        if found is not None:
            self.counts.removeKey((end,))
            yield self.make("window", key[0], end, found[0], None)

    def close(self) -> None:
        pass


def late_windows(df: DataFrame, key: str, ts: str, size: str, salts: int = 8) -> DataFrame:
    """#48 on a watermarked stream, both outputs tagged in one table: ``kind`` ``window`` (key, window_end, count) or
    ``late`` (key, window_end, the row). A key's rows are dealt to ``salts`` groups, so a hot key is counted by several
    tasks; a window's partial counts come out in one micro-batch and :func:`split` adds them up."""
    us = _us(size)
    if us % 1000:
        raise ValueError("window sizes are whole milliseconds")
    plain = _plain(df, ts)
    src = plain.select(F.explode(_ends(us, us)).alias("_end"), "*").withColumn("_salt", F.pmod(F.xxhash64(*plain.columns), F.lit(salts)))
    row = T.StructType([plain.schema[c] for c in df.columns])
    schema = T.StructType([T.StructField("kind", T.StringType()), T.StructField("key", df.schema[key].dataType), T.StructField("end_us", T.LongType()),
                           T.StructField("count", T.LongType()), T.StructField("row", row)])
    out = src.groupBy(key, "_salt").transformWithState(WindowTag(df.columns), schema, "Append", "EventTime")
    return out.select("kind", F.col("key").alias(key), F.timestamp_micros("end_us").alias("window_end"), "count", "row")


def split(on_time: Sink, late: Sink, key: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler for :func:`late_windows`: closed windows (key, window_end, count) to ``on_time``, late
    rows to ``late``. Both sinks get the batch id and must overwrite what a replayed batch wrote."""
    def windows(batch: DataFrame, batch_id: int) -> None:
        on_time(batch.where("kind = 'window'").groupBy(key, "window_end").agg(F.sum("count").alias("count")), batch_id)

    def rows(batch: DataFrame, batch_id: int) -> None:
        late(batch.where("kind = 'late'").select("row.*"), batch_id)

    return fan_out_batches(windows, rows)


class Lateness(StatefulProcessor):
    """#50 window -> (count, firings) in a map state. The close timer gives the first firing; a row that comes later but
    within the lateness fires again with the count so far; the second timer, at close + lateness, forgets the window."""

    def __init__(self, lateness_ms: int, arrival: Sequence[str]):
        self.lateness, self.arrival = lateness_ms, tuple(arrival)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.windows = handle.getMapState("windows", "end_us long", "n long, firings int")
        self.make = Row("key", "end_us", "firing", "count", "is_update")

    def _fire(self, key, end: int, n: int, firings: int) -> Row:
        return self.make(key[0], end, firings, n, firings > 0)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs()
        on_time, late = Counter(), []
        for r in rows:
            end = r["_end"]
            if not _closed(end, wm):
                on_time[end] += 1
            elif end // 1000 - 1 + self.lateness > wm:
                late.append((end, *[r[c] for c in self.arrival]))
        for end, n in on_time.items():
            old = self.windows.getValue((end,))
            if old is None:
                self.handle.registerTimer(_close_timer(end))
                self.handle.registerTimer(_close_timer(end) + self.lateness)
            self.windows.updateValue((end,), (n + (old[0] if old else 0), 0))
        late.sort(key=lambda x: sort_key(x, list(range(1, len(x)))))
        touched: dict[int, tuple[int, int]] = {}
        for end, *_ in late:
            if end not in touched:
                old = self.windows.getValue((end,))
                if old is None:
                    self.handle.registerTimer(_close_timer(end) + self.lateness)
                elif old[1] == 0:  # the window closes in this very batch: its first firing comes first
                    yield self._fire(key, end, old[0], 0)
                    old = (old[0], 1)
                touched[end] = tuple(old) if old else (0, 0)
            n, firings = touched[end]
            yield self._fire(key, end, n + 1, firings)
            touched[end] = (n + 1, firings + 1)
        for end, found in touched.items():
            self.windows.updateValue((end,), found)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at = expiredTimerInfo.getExpiryTimeInMs() + 2
        end = at * 1000
        found = self.windows.getValue((end,))
        if found is not None and found[1] == 0:
            yield self._fire(key, end, found[0], 0)
            self.windows.updateValue((end,), (found[0], 1))
        gone = (at - self.lateness) * 1000
        old = self.windows.getValue((gone,))
        if old is not None:
            # both timers of a window may be due in one batch, in any order
            if old[1] == 0:
                yield self._fire(key, gone, old[0], 0)
            self.windows.removeKey((gone,))

    def close(self) -> None:
        pass


def allowed_lateness(df: DataFrame, key: str, ts: str, size: str, lateness: str | float, arrival: Sequence[str] = ()) -> DataFrame:
    """#50 on a watermarked stream: (key, window_end, firing, count, is_update). Nothing comes before a window closes,
    then one first firing, then one update with the cumulative count for each row within ``lateness``, rows of one
    micro-batch in the order of ``arrival``; with no row on time the first of those is the first firing. Later rows
    are dropped. A key is counted by one task; its state is one entry per window not yet forgotten."""
    us = _us(size)
    if us % 1000 or _us(lateness) % 1000:
        raise ValueError("window size and lateness are whole milliseconds")
    src = _plain(df, ts).select(F.explode(_ends(us, us)).alias("_end"), key, *[c for c in dict.fromkeys(arrival) if c != key])
    schema = T.StructType([T.StructField("key", df.schema[key].dataType), T.StructField("end_us", T.LongType()), T.StructField("firing", T.IntegerType()),
                           T.StructField("count", T.LongType()), T.StructField("is_update", T.BooleanType())])
    out = src.groupBy(key).transformWithState(Lateness(_us(lateness) // 1000, arrival), schema, "Append", "EventTime")
    return out.select(F.col("key").alias(key), F.timestamp_micros("end_us").alias("window_end"), "firing", "count", "is_update")


#: Bits of a window's bitmap (the range of the 16-bit hash) and of one chunk of it.
BITS, CHUNK_BITS = 1 << 16, 1 << 11


class DistinctSoFar(StatefulProcessor):
    """#52 a bitmap per window, cut into chunks in a map state: a row reads and writes the chunk of its bit only. The
    running number of bits is a value state; a timer at the window's end forgets both."""

    def __init__(self, names: Sequence[str], arrival: Sequence[str]):
        self.names, self.arrival = tuple(names), tuple(arrival)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.chunks = handle.getMapState("chunks", "chunk int", "bits binary")
        self.total = handle.getValueState("total", "n long")
        self.make = Row("end_us", *self.names, "distinct_so_far")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        end = key[0]
        if _closed(end, timerValues.getCurrentWatermarkInMs()):
            return
        if self.total.exists():
            n = self.total.get()[0]
        else:
            n = 0
            self.handle.registerTimer(_close_timer(end))
        places = list(range(len(self.arrival)))
        chunks: dict[int, bytearray] = {}
        changed = set()
        for r in sorted(rows, key=lambda r: sort_key([r[c] for c in self.arrival], places)):
            c, bit = divmod(r["_bit"], CHUNK_BITS)
            if c not in chunks:
                old = self.chunks.getValue((c,))
                chunks[c] = bytearray(old[0]) if old else bytearray(CHUNK_BITS // 8)
            byte, mask = bit >> 3, 1 << (bit & 7)
            if not chunks[c][byte] & mask:
                chunks[c][byte] |= mask
                changed.add(c)
                n += 1
            yield self.make(end, *[r[x] for x in self.names], n)
        for c in changed:
            self.chunks.updateValue((c,), (bytes(chunks[c]),))
        self.total.update((n,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.chunks.clear()
        self.total.clear()
        return iter(())

    def close(self) -> None:
        pass


def distinct_so_far(df: DataFrame, key: str, ts: str, size: str, slide: str | None = None, arrival: Sequence[str] = (),
                    keep: Sequence[str] = ()) -> DataFrame:
    """#52 on a watermarked stream: for every row and each of its open windows, ``keep``, window_end and the number of
    distinct 16-bit hashes of ``key`` seen in that window up to the row (rows of a micro-batch in the order of
    ``arrival``). Rows of a closed window are dropped. A window is one group: its rows of a micro-batch are one
    task's work, its state at most 8 KB in chunks of 256 bytes."""
    us, step = _us(size), _us(slide or size)
    if us % 1000 or step % 1000:
        raise ValueError("window size and slide are whole milliseconds")
    names = [c for c in dict.fromkeys(keep)]
    src = _plain(df, ts).select(F.explode(_ends(us, step)).alias("_end"), poly_hash(F.col(key).cast("string")).cast("int").alias("_bit"),
                                *dict.fromkeys([*names, *arrival]))
    schema = T.StructType([T.StructField("end_us", T.LongType()), *[src.schema[c] for c in names], T.StructField("distinct_so_far", T.LongType())])
    out = src.groupBy("_end").transformWithState(DistinctSoFar(names, arrival), schema, "Append", "EventTime")
    return out.select(*names, F.timestamp_micros("end_us").alias("window_end"), "distinct_so_far")

"""Reorder buffer for keyed operators: rows of a key reach the operator in event-time order.

Rows arrive unordered within a micro-batch and across micro-batches. :class:`Ordered` keeps them in a list
state and releases them once the watermark has passed them: Spark drops every row at or behind the watermark,
so nothing can come in front of a released row any more. What an operator gives on a stream is then
what its batch form gives on the same rows, whatever the order of arrival within the watermark delay.

A subclass has a small own state and three methods: ``step`` (one row, in order), ``deadline`` (the next time at
which something happens without a row, or None) and ``expire`` (the deadline has passed: it is called before the
first row behind it, or once the watermark is there). One event-time timer per key stands at whatever
comes first: the earliest waiting row, the deadline or the end of the idle time.

State per key: the rows within the watermark delay, the own state, one timer. Times are micro-seconds; a timer has
milliseconds, so it may be due a moment early and is then set again.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: The event time as micro-seconds, in the rows a processor gets.
TIME = "_t"
_CHUNK = 10_000


def timer_at(us: int) -> int:
    """The timer that fires as soon as the watermark is at or behind ``us``: a timer fires once the watermark is
    greater than it."""
    return -(-us // 1000) - 1


def sort_key(row: tuple, places: list[int]) -> tuple:
    """Ascending, nulls first, as Spark sorts."""
    return tuple(x for p in places for x in (row[p] is not None, row[p] if row[p] is not None else 0))


class Ordered(StatefulProcessor):
    #: Columns the operator reads besides the time; ``order`` breaks ties of the time.
    columns: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    #: A key starts anew with a row that comes longer than this after the one before, and its state goes once the
    #: watermark shows that it will (None: kept).
    idle_us: int | None = None
    #: Set by :func:`ordered`: the schema of the buffered rows.
    fields: T.StructType
    own_schema: str | T.StructType = "x long"

    # --- to be written by the operator ------------------------------------------------------
    def start(self) -> list:
        """The own state of a new key, one entry per field of ``own_schema``."""
        raise NotImplementedError

    def step(self, key, own: list, row: Row) -> Iterator[Row]:
        raise NotImplementedError

    def deadline(self, own: list) -> int | None:
        return None

    def expire(self, key, own: list) -> Iterator[Row]:
        raise NotImplementedError

    # --- the buffer -----------------------------------------------------------------------------
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.names = [f.name for f in self.fields]
        self.places = [self.names.index(c) for c in (TIME, *self.order)]
        self.buffer = handle.getListState("buffer", self.fields)
        self.own = handle.getValueState("own", self.own_schema)
        self.clock = handle.getValueState("clock", "timer long, last long")

    def _set(self, timer: int | None, last: int) -> None:
        """One timer per key at ``timer``; ``last`` is the time of the latest released row."""
        old = self.clock.get()[0] if self.clock.exists() else None
        if old is not None and old != timer:
            self.handle.deleteTimer(old)
        if timer is not None and old != timer:
            self.handle.registerTimer(timer)
        self.clock.update((timer, last))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        first, chunk = None, []
        for r in rows:
            chunk.append(tuple(r[c] for c in self.names))
            t = r[TIME]
            first = t if first is None or t < first else first
            if len(chunk) == _CHUNK:
                self.buffer.appendList(chunk)
                chunk = []
        if chunk:
            self.buffer.appendList(chunk)
        timer, last = self.clock.get() if self.clock.exists() else (None, -1)
        due = timer_at(first)
        self._set(due if timer is None else min(timer, due), last)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        wm = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [tuple(r) for r in self.buffer.get()] if self.buffer.exists() else []
        ready = [r for r in waiting if r[self.places[0]] <= wm]
        own = list(self.own.get()) if self.own.exists() else self.start()
        last = self.clock.get()[1]
        make = Row(*self.names)
        for r in sorted(ready, key=lambda r: sort_key(r, self.places)):
            before, last = last, r[self.places[0]]
            while (d := self.deadline(own)) is not None and d < last:
                yield from self.expire(key, own)
            if self.idle_us is not None and last > before + self.idle_us and self.deadline(own) is None:
                own = self.start()
            yield from self.step(key, own, make(*r))
        while (d := self.deadline(own)) is not None and d <= wm:
            yield from self.expire(key, own)
        if ready:
            rest = [r for r in waiting if r[self.places[0]] > wm]
            if rest:
                self.buffer.put(rest)
            else:
                self.buffer.clear()
            waiting = rest
        d = self.deadline(own)
        done = self.idle_us is not None and not waiting and d is None and wm >= last + self.idle_us
        if done or own == self.start() and not waiting:
            self.own.clear()
            self._set(None, last)
            self.clock.clear()
            return
        self.own.update(tuple(own))
        times = [r[self.places[0]] for r in waiting] + ([d] if d is not None else [])
        if not times and self.idle_us is not None:
            times = [last + self.idle_us]
        self._set(timer_at(min(times)) if times else None, last)

    def close(self) -> None:
        pass


def ordered(df: DataFrame, key: str, ts: str, processor: Ordered, schema: str | T.StructType) -> DataFrame:
    """Run ``processor`` over the rows of each ``key`` in the order of ``ts``. ``df`` must carry a watermark on
    ``ts``; rows without a time are left out. Output columns ending in ``_us`` become timestamps."""
    wanted = dict.fromkeys((*processor.order, *processor.columns))
    time = F.unix_micros(F.col(ts).cast("timestamp")).alias(TIME)
    src = df.where(F.col(ts).isNotNull()).select(key, ts, time, *[c for c in wanted if c not in (key, ts)])
    processor.fields = T.StructType([f for f in src.schema.fields if f.name == TIME or f.name in wanted])
    out = src.groupBy(key).transformWithState(processor, schema, "Append", "EventTime")
    return out.select(*[F.timestamp_micros(c).alias(c[:-3] + "_ts") if c.endswith("_us") else F.col(c) for c in out.columns])

"""Keyed state and timers on a stream (#22-#26, #53-#60).

Each operator is a :class:`~streamlens.streaming.ordered.Ordered` processor plus a function that takes a
watermarked stream and returns the rows its batch form in :mod:`streamlens.operators` gives, once the
watermark has passed them. Rows behind the watermark are dropped by Spark (and counted in its progress).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from streamlens.operators.windows import seconds
from streamlens.streaming.ordered import Ordered, ordered


def _us(duration: str | float) -> int:
    return int(round(seconds(duration) * 1e6))


def _type(df: DataFrame, column: str) -> str:
    return df.schema[column].dataType.simpleString()


def _kept(df: DataFrame, keep: Sequence[str]) -> str:
    return "".join(f"`{c}` {_type(df, c)}, " for c in keep)


class RunningAggregate(Ordered):
    """#24 rolling sum, #26 rolling min. Nulls leave the aggregate as it is; integers and decimals are exact."""

    def __init__(self, value: str, order: Sequence[str], agg: str, out: str, keep: Sequence[str], kind: str, idle_us: int | None = None):
        if agg not in ("sum", "min", "max"):
            raise ValueError("agg must be sum, min or max")
        self.value, self.agg, self.idle_us = value, {"sum": lambda a, b: a + b, "min": min, "max": max}[agg], idle_us
        self.order, self.columns, self.keep = tuple(order), (value, *keep), tuple(keep)
        self.own_schema, self.make = f"acc {kind}", Row(*keep, out)

    def start(self) -> list:
        return [None]

    def step(self, key, own, row) -> Iterator[Row]:
        v = row[self.value]
        if v is not None:
            own[0] = v if own[0] is None else self.agg(own[0], v)
        yield self.make(*[row[c] for c in self.keep], own[0])


def rolling(df: DataFrame, key: str, value: str, ts: str, order: Sequence[str] = (), agg: str = "sum", out: str = "sum",
            keep: Sequence[str] = (), idle: str | float | None = None) -> DataFrame:
    """#24/#26 per row, in the order of ``ts`` and ``order``: ``keep`` and the running ``agg`` of ``value``. A sum of
    integers is a long, one of decimals has ten more digits, others are doubles. With ``idle`` a key starts anew after
    so long without a row; without it its aggregate is kept."""
    kind = df.schema[value].dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        df = df.withColumn(value, F.col(value).cast("double"))
        name = "double"
    elif agg != "sum":
        name = kind.simpleString()
    elif isinstance(kind, T.DecimalType):
        name = f"decimal({min(38, kind.precision + 10)},{kind.scale})"
    else:
        name = "bigint"
    p = RunningAggregate(value, order, agg, out, keep, name, None if idle is None else _us(idle))
    return ordered(df, key, ts, p, f"{_kept(df, keep)}`{out}` {name}")


class RunningList(Ordered):
    """#25 rolling list: every value so far in a list state of its own, to which rows are only added."""

    own_schema = "n long"

    def __init__(self, value: str, order: Sequence[str], out: str, keep: Sequence[str], kind: str, many: bool):
        self.value, self.kind, self.many = value, kind, many
        self.order, self.columns, self.keep, self.make = tuple(order), (value, *keep), tuple(keep), Row(*keep, out)

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.items = handle.getListState("items", f"v {self.kind}")

    def start(self) -> list:
        return [0]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.seen, self.old = None, 0
        yield from super().handleExpiredTimer(key, timerValues, expiredTimerInfo)
        if self.seen is not None and len(self.seen) > self.old:
            self.items.appendList([(v,) for v in self.seen[self.old:]])

    def step(self, key, own, row) -> Iterator[Row]:
        if self.seen is None:
            self.seen = [r[0] for r in self.items.get()] if self.items.exists() else []
            self.old = len(self.seen)
        v = row[self.value]
        self.seen += [x for x in (v or [] if self.many else [v]) if self.many or x is not None]
        own[0] = len(self.seen)
        yield self.make(*[row[c] for c in self.keep], list(self.seen))


def rolling_list(df: DataFrame, key: str, value: str, ts: str, order: Sequence[str] = (), out: str = "items", keep: Sequence[str] = ()) -> DataFrame:
    """#25 per row: ``keep`` and the list of all values of the key up to it (nulls left out; arrays are joined)."""
    kind = df.schema[value].dataType
    many = isinstance(kind, T.ArrayType)
    name = (kind.elementType if many else kind).simpleString()
    return ordered(df, key, ts, RunningList(value, order, out, keep, name, many), f"{_kept(df, keep)}`{out}` array<{name}>")


class JumpAlert(Ordered):
    """#53/#54 a row whose value is more than ``threshold`` from the one before; null compares with nothing."""

    own_schema = "last double"

    def __init__(self, value: str, order: Sequence[str], threshold: float, initial: float | None, keep: Sequence[str], idle_us: int | None = None):
        self.value, self.threshold, self.initial, self.idle_us = value, threshold, initial, idle_us
        self.order, self.columns, self.keep, self.make = tuple(order), (value, *keep), tuple(keep), Row(*keep, "last")

    def start(self) -> list:
        return [None]

    def step(self, key, own, row) -> Iterator[Row]:
        v, last = row[self.value], own[0] if own[0] is not None else self.initial
        if v is not None and last is not None and abs(v - last) > self.threshold:
            yield self.make(*[row[c] for c in self.keep], float(last))
        own[0] = None if v is None else float(v)


def jump_alert(df: DataFrame, key: str, value: str, ts: str, order: Sequence[str] = (), threshold: float = 1.7,
               initial: float | None = None, keep: Sequence[str] = (), idle: str | float | None = None) -> DataFrame:
    """#53 (``initial`` set) / #54: ``keep`` and ``last`` of the rows that jump."""
    p = JumpAlert(value, order, threshold, initial, keep, None if idle is None else _us(idle))
    return ordered(df, key, ts, p, f"{_kept(df, keep)}last double")


class SustainedRise(Ordered):
    """#55 the first rise sets a deadline ``hold`` later; a fall up to the deadline, itself included, takes it away;
    at the deadline an alert, and the next rise sets a new one."""

    own_schema = "last double, due long"
    make = Row("key", "rise_us", "alert_us")

    def __init__(self, value: str, order: Sequence[str], hold_us: int):
        self.value, self.hold, self.order, self.columns = value, hold_us, tuple(order), (value,)

    def start(self) -> list:
        return [None, None]

    def step(self, key, own, row) -> Iterator[Row]:
        v, last = row[self.value], own[0]
        if v is not None and last is not None:
            if v > last and own[1] is None:
                own[1] = row["_t"] + self.hold
            elif v < last:
                own[1] = None
        own[0] = None if v is None else float(v)
        return iter(())

    def deadline(self, own) -> int | None:
        return own[1]

    def expire(self, key, own) -> Iterator[Row]:
        due, own[1] = own[1], None
        yield self.make(key[0], due - self.hold, due)


def sustained_rise(df: DataFrame, key: str, ts: str, value: str, order: Sequence[str] = (), hold: str | float = "1 second") -> DataFrame:
    """#55, re-arming: (key, rise_ts, alert_ts)."""
    out = ordered(df, key, ts, SustainedRise(value, order, _us(hold)), f"key {_type(df, key)}, rise_us long, alert_us long")
    return out.withColumnRenamed("key", key)


class RepeatedFailures(Ordered):
    """#56 the first fail opens a span; a success in it closes it; at its end ``min_fails`` fails are an alert.
    ``rearm``: the next fail opens a new span; otherwise a key has one span, ever, and keeps that mark."""

    own_schema = "n long, opened_us long, used boolean"
    make = Row("key", "start_us", "end_us", "n_fails")
    columns, order = ("_what",), ("_what",)

    def __init__(self, span_us: int, min_fails: int, rearm: bool):
        self.span, self.min_fails, self.rearm = span_us, min_fails, rearm

    def start(self) -> list:
        return [0, None, False]

    def step(self, key, own, row) -> Iterator[Row]:
        if row["_what"] == 0:
            if own[1] is None and (self.rearm or not own[2]):
                own[0], own[1], own[2] = 0, row["_t"], not self.rearm
            if own[1] is not None:
                own[0] += 1
        else:
            own[0], own[1] = 0, None
        return iter(())

    def deadline(self, own) -> int | None:
        return None if own[1] is None else own[1] + self.span

    def expire(self, key, own) -> Iterator[Row]:
        n, opened, own[0], own[1] = own[0], own[1], 0, None
        if n >= self.min_fails:
            yield self.make(key[0], opened, opened + self.span, n)


def repeated_failures(df: DataFrame, key: str = "user_id", ts: str = "ts", event: str = "event_type", fail: str = "fail",
                      success: str = "success", span: str | float = "5 seconds", min_fails: int = 2, rearm: bool = False) -> DataFrame:
    """#56: (key, span_start, span_end, n_fails)."""
    ev = df.where(F.col(event).isin(fail, success)).withColumn("_what", (F.col(event) == success).cast("int"))
    out = ordered(ev, key, ts, RepeatedFailures(_us(span), min_fails, rearm), f"key {_type(df, key)}, start_us long, end_us long, n_fails long")
    return out.select(F.col("key").alias(key), F.col("start_ts").alias("span_start"), F.col("end_ts").alias("span_end"), "n_fails")


class OrderTimeout(Ordered):
    """#57 the first create waits for a pay within ``wait`` on either side, both ends included. A key keeps one mark
    that its create is decided, so that a later create does not count (for ``idle_us``, if given); a pay alone is
    forgotten when it can no longer match."""

    own_schema = "created_us long, paid_us long, done boolean"
    make = Row("key", "created_us")
    columns, order = ("_what",), ("_what",)

    def __init__(self, wait_us: int, idle_us: int | None = None):
        self.wait, self.idle_us = wait_us, idle_us

    def start(self) -> list:
        return [None, None, False]

    def step(self, key, own, row) -> Iterator[Row]:
        if not own[2]:
            if row["_what"] == 1:
                own[:] = [None, None, True] if own[0] is not None else [None, row["_t"], False]
            elif own[0] is None:
                own[:] = [row["_t"], None, False] if own[1] is None else [None, None, True]
        return iter(())

    def deadline(self, own) -> int | None:
        at = own[0] if own[0] is not None else own[1]
        return None if at is None else at + self.wait

    def expire(self, key, own) -> Iterator[Row]:
        created = own[0]
        own[:] = [None, None, created is not None]
        if created is not None:
            yield self.make(key[0], created)


def order_timeout(events: DataFrame, wait: str | float, key: str = "order_id", ts: str = "ts", op: str = "op", create: str = "create",
                  pay: str = "pay", idle: str | float | None = None) -> DataFrame:
    """#57: (key, op, ts) of creates without a pay in time."""
    ev = events.where(F.col(op).isin(create, pay)).withColumn("_what", (F.col(op) == pay).cast("int"))
    out = ordered(ev, key, ts, OrderTimeout(_us(wait), None if idle is None else _us(idle)), f"key {_type(events, key)}, created_us long")
    return out.select(F.col("key").alias(key), F.lit(create).alias("op"), F.col("created_ts").alias("ts"))


class ForwardSwitch(Ordered):
    """#22 a switch (tag 0) lets its key's readings (tag 1) pass until it ends; the end is forgotten behind it."""

    own_schema = "until_us long"

    def __init__(self, keep: Sequence[str], duration: str, tiebreak: Sequence[str]):
        self.keep, self.duration, self.order, self.make = tuple(keep), duration, ("_tag", *tiebreak), Row(*keep)
        self.columns = (duration, *keep)

    def start(self) -> list:
        return [None]

    def step(self, key, own, row) -> Iterator[Row]:
        if row["_tag"] == 0:
            if row[self.duration] is not None:
                own[0] = max(own[0] or 0, row["_t"] + row[self.duration])
        elif own[0] is not None and row["_t"] < own[0]:
            yield self.make(*[row[c] for c in self.keep])

    def deadline(self, own) -> int | None:
        return own[0]

    def expire(self, key, own) -> Iterator[Row]:
        own[0] = None
        return iter(())


def forward_switch(readings: DataFrame, switches: DataFrame, key: str = "id", ts: str = "ts", duration: str | float = "10 seconds",
                   duration_col: str | None = None, keep: Sequence[str] = (), tiebreak: Sequence[str] = ()) -> DataFrame:
    """#22: ``keep`` of the readings that pass (``duration_col`` in milliseconds). Both streams carry a watermark on
    ``ts``."""
    columns = [c for c in dict.fromkeys((*keep, *tiebreak)) if c not in (key, ts)]
    long = F.lit(None).cast("long")
    span = F.col(duration_col).cast("long") * 1000 if duration_col else F.lit(_us(duration))
    both = readings.select(key, ts, F.lit(1).alias("_tag"), long.alias("_span"), *columns).unionByName(
        switches.select(key, ts, F.lit(0).alias("_tag"), span.alias("_span"), *[F.lit(None).cast(readings.schema[c].dataType).alias(c) for c in columns]))
    schema = ", ".join(f"`{c}` {_type(readings, c)}" for c in keep)
    return ordered(both, key, ts, ForwardSwitch(keep, "_span", tiebreak), schema)


class MatchOneToOne(Ordered):
    """#23 a row takes the longest waiting row of the other side or waits itself. Rows wait on one side only, in one
    queue; the deadline is that of its head."""

    own_schema = "side int, times array<bigint>, channels array<string>"
    make = Row("key", "order_us", "pay_us", "channel", "kind")
    columns, order = ("_side", "channel"), ("_side", "channel")

    def __init__(self, wait_us: int):
        self.wait = wait_us

    def start(self) -> list:
        return [None, [], []]

    def _head(self, own: list) -> tuple:
        t, c = own[1][0], own[2][0]
        own[1], own[2] = list(own[1][1:]), list(own[2][1:])
        if not own[1]:
            own[0] = None
        return t, c

    def step(self, key, own, row) -> Iterator[Row]:
        side, t = row["_side"], row["_t"]
        if own[0] is None or own[0] == side:
            own[0], own[1], own[2] = side, [*own[1], t], [*own[2], row["channel"]]
        else:
            other, channel = self._head(own)
            yield self.make(key[0], t, other, channel, "matched") if side == 0 else self.make(key[0], other, t, row["channel"], "matched")

    def deadline(self, own) -> int | None:
        return own[1][0] + self.wait if own[1] else None

    def expire(self, key, own) -> Iterator[Row]:
        side = own[0]
        t, channel = self._head(own)
        yield self.make(key[0], t, None, None, "order_only") if side == 0 else self.make(key[0], None, t, channel, "pay_only")


def match_one_to_one(orders: DataFrame, pays: DataFrame, wait: str | float, key: str = "order_id", ts: str = "ts") -> DataFrame:
    """#23, one with one, as :func:`streamlens.operators.match.match_one_to_one`. Both streams carry a watermark on
    ``ts``; a row behind it is dropped, a row without a partner leaves when its wait is over."""
    both = orders.select(F.col(key).alias("order_id"), ts, F.lit(0).alias("_side"), F.lit(None).cast("string").alias("channel")).unionByName(
        pays.select(F.col(key).alias("order_id"), ts, F.lit(1).alias("_side"), "channel"))
    out = ordered(both, "order_id", ts, MatchOneToOne(_us(wait)), f"key {_type(orders, key)}, order_us long, pay_us long, channel string, kind string")
    return out.withColumnRenamed("key", "order_id")


def apply(df: DataFrame, key: str, processor: StatefulProcessor, schema: str,
          time_mode: str = "None", output_mode: str = "Append") -> DataFrame:
    """``groupBy(key).transformWithState(processor, ...)``."""
    return df.groupBy(key).transformWithState(processor, schema, output_mode, time_mode)


def _ms(ts) -> int:
    return int(ts.timestamp() * 1000)


class SequencePattern(StatefulProcessor):
    """#58-#60 on a stream: strict-contiguity pattern of ``k`` steps within ``within``.

    Input rows carry the step predicates as boolean columns ``_s0.._s{k-1}`` and a
    ``payload`` string. Rows of a key are buffered (list state) and decided in event
    time order once they are final: a start row is decided when its next ``k-1`` rows
    are at or below the watermark, or when the watermark passes ``start + within``
    (any row still to come would be too late). Outcomes equal the batch
    :func:`streamlens.operators.patterns.sequence_pattern`.
    Output: key, kind (``match``/``timeout``), payloads (one per matched step; the
    first step's for a time-out).
    """

    def __init__(self, ts: str, k: int, within_ms: int, tiebreak: str):
        self.ts, self.k, self.within_ms, self.tb = ts, k, within_ms, tiebreak

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buf = handle.getListState("buf", "t long, tb long, flags string, payload string")

    def _decide(self, key, rows: list[tuple], wm: int) -> tuple[list[Row], list[tuple]]:
        out, i, k = [], 0, self.k
        while i < len(rows):
            s = rows[i]
            nxt = rows[i + 1:i + k]
            final = len(nxt) == k - 1 and all(r[0] <= wm for r in nxt)
            if not (final or wm >= s[0] + self.within_ms):
                break
            if s[2][0] == "1":
                pays = [s[3]]
                kind = "match"
                for j in range(1, k):
                    r = rows[i + j] if i + j < len(rows) and rows[i + j][0] <= wm else None
                    if r is None or r[0] - s[0] >= self.within_ms:
                        kind = "timeout"
                        break
                    if r[2][j] != "1":
                        kind = None
                        break
                    pays.append(r[3])
                if kind == "match":
                    out.append(Row(key=key[0], kind="match", payloads=pays))
                elif kind == "timeout":
                    out.append(Row(key=key[0], kind="timeout", payloads=[s[3]]))
            i += 1
        return out, rows[i:]

    def _store(self, rows: list[tuple]) -> None:
        self.buf.clear()
        if rows:
            self.buf.put(rows)
            self.handle.registerTimer(max(r[0] for r in rows))
            self.handle.registerTimer(rows[0][0] + self.within_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        old = list(self.buf.get()) if self.buf.exists() else []
        new = [(_ms(r[self.ts]), int(r[self.tb]),
                "".join("1" if r[f"_s{j}"] else "0" for j in range(self.k)), r["payload"]) for r in rows]
        allrows = sorted([tuple(x) for x in old] + new, key=lambda x: (x[0], x[1]))
        out, keep = self._decide(key, allrows, timerValues.getCurrentWatermarkInMs())
        self._store(keep)
        return iter(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        rows = sorted([tuple(x) for x in self.buf.get()], key=lambda x: (x[0], x[1])) if self.buf.exists() else []
        wm = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs())
        out, keep = self._decide(key, rows, wm)
        self._store(keep)
        return iter(out)

    def close(self) -> None:
        pass


def pattern_rows(df: DataFrame, key: str, steps, select, ts: str = "ts") -> DataFrame:
    """Input of :class:`SequencePattern` from the same ``steps`` (name, predicate) as the
    batch :func:`streamlens.operators.patterns.sequence_pattern`: one boolean column per
    step and the selected columns as a JSON ``payload``."""
    preds = [F.expr(p) if isinstance(p, str) else p for _, p in steps]
    return df.select(key, ts, *[c for c in df.columns if c not in (key, ts)],
                     *[p.alias(f"_s{j}") for j, p in enumerate(preds)],
                     F.to_json(F.struct(*select)).alias("payload"))

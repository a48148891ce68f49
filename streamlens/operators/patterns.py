"""Event-sequence patterns with strict contiguity (#58-#60).

A pattern is a list of named steps (a predicate each) that must hold on
consecutive rows of a key, with the last row less than ``within`` after the first.

Plan: the next rows of a key by local windows over cut time (:func:`scan.following`): one shuffle of the
rows and one small one of the buckets' first rows. No self-join, and a hot key is spread over its buckets.
Matches and time-outs come out of one pass as one tagged frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.operators.scan import following
from streamlens.operators.windows import seconds


def _pred(p: Column | str) -> Column:
    return F.expr(p) if isinstance(p, str) else p


def tagged_pattern(df: DataFrame, key: str, order: Sequence[str], steps: Sequence[tuple[str, Column | str]],
                   within: str | float, select: Sequence[str], ts: str = "ts",
                   num_parts: int | None = None) -> DataFrame:
    """#60 ``begin(name).where(p).next(...)...within(t)``: rows (key, kind, ``{step}_{col}``...).

    ``kind`` is ``match`` or ``timeout``. A match: every step holds on consecutive rows and
    ``last.ts - first.ts < within`` (exclusive). Every start row yields its own match, so overlapping matches
    are all reported. A time-out: the first ``j >= 1`` steps hold in time and the row for step ``j+1`` is
    missing or not earlier than ``first.ts + within``; a row that arrives in time but fails its step ends the
    partial match with no output. Matches carry ``{step}_{col}`` for each selected column; time-outs carry
    the first step's columns, the others are null.
    """
    k = len(steps)
    names = [n for n, _ in steps]
    d = df.select(key, *[c for c in dict.fromkeys([*order, ts, *select]) if c != key],
                  *[_pred(p).alias(f"_s{i}") for i, (_, p) in enumerate(steps)])
    carried = list(dict.fromkeys([ts, *select])) + [f"_s{i}" for i in range(1, k)]
    if k > 1:
        d = following(d, keys=[key], order=order, cols=carried, ahead=k - 1, num_parts=num_parts)
    lim = F.lit(int(seconds(within) * 1e6))

    def micros(c: str) -> Column:
        return F.unix_micros(F.col(c).cast("timestamp"))

    def at(c: str, j: int) -> str:
        return c if j == 0 else f"{c}_n{j}"

    ok_prefix = F.coalesce(F.col("_s0"), F.lit(False))
    in_time = {j: (micros(at(ts, j)) - micros(ts)) < lim for j in range(1, k)}
    timeout = F.lit(False)
    for j in range(1, k):
        missing_or_late = F.col(at(ts, j)).isNull() | ~in_time[j]
        timeout = timeout | (ok_prefix & missing_or_late)
        ok_prefix = ok_prefix & F.coalesce(in_time[j] & F.col(at(f"_s{j}", j)), F.lit(False))
    kind = F.when(ok_prefix, "match").when(timeout, "timeout")
    cols = [(F.col(c) if j == 0 else F.when(F.col("kind") == "match", F.col(at(c, j)))).alias(f"{names[j]}_{c}") for j in range(k) for c in select]
    return d.withColumn("kind", kind).where(F.col("kind").isNotNull()).select(F.col(key), "kind", *cols)


def sequence_pattern(df: DataFrame, key: str, order: Sequence[str], steps: Sequence[tuple[str, Column | str]],
                     within: str | float, select: Sequence[str], ts: str = "ts",
                     num_parts: int | None = None) -> tuple[DataFrame, DataFrame]:
    """The two outputs of :func:`tagged_pattern` apart: ``(matches, timeouts)``; time-outs with the first
    step's columns under their own names."""
    both = tagged_pattern(df, key, order, steps, within, select, ts, num_parts)
    first = steps[0][0]
    return (both.where("kind = 'match'").drop("kind"),
            both.where("kind = 'timeout'").select(key, *[F.col(f"{first}_{c}").alias(c) for c in select]))


def fail_sequence(login: DataFrame, within: str | float = "10 seconds", n: int = 3,
                  key: str = "user_id", order: Sequence[str] = ("ts", "event_id"),
                  select: Sequence[str] = ("ip", "ts")) -> DataFrame:
    """#58 ``n`` strictly consecutive ``fail`` rows of a user within ``within``."""
    names = ["begin", "next", "third"] if n == 3 else [f"step{i}" for i in range(n)]
    steps = [(nm, F.col("event_type") == "fail") for nm in names]
    m, _ = sequence_pattern(login, key, order, steps, within, select)
    return m


def order_pay_pattern(order_events: DataFrame, within: str | float = "5 seconds",
                      key: str = "order_id", order: Sequence[str] = ("ts", "op"),
                      select: Sequence[str] = ("op", "ts")) -> tuple[DataFrame, DataFrame]:
    """#59 ``create`` then, on the very next row, ``pay`` within ``within``:
    (matches, time-outs); the time-out side output is the ``create`` row."""
    steps = [("create", F.col("op") == "create"), ("pay", F.col("op") == "pay")]
    return sequence_pattern(order_events, key, order, steps, within, select)

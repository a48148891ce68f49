"""Two-stream operators: forward switch, match with time-out, order time-out
(#22, #23, #57).

Every time-range join here carries an equality key, and the time range is turned
into an equality too: rows are bucketed by ``floor(ts / wait)`` and the other side
is replicated to the neighbouring buckets, so the join is a hash/sort-merge equi-join
on ``(key, bucket)`` plus a residual range check. A hot key is then spread over its
time buckets, and no task compares all pairs of a key.
"""

from __future__ import annotations

from collections import deque

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.operators.fold import fold_pieces
from streamlens.operators.scan import running
from streamlens.operators.windows import seconds

_HASHES = 1 << 18  # by which the rows of keys are counted


def _bucket(ts: str, width_s: float) -> Column:
    if width_s <= 0:
        raise ValueError("the wait must be positive")
    return F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(int(width_s * 1e6)))


def _spread(df: DataFrame, ts: str, width_s: float) -> DataFrame:
    """Replicate each row to its bucket and both neighbours (3 copies)."""
    b = _bucket(ts, width_s)
    return df.withColumn("_b", F.explode(F.array(b - 1, b, b + 1)))


def forward_switch(readings: DataFrame, switches: DataFrame, key: str = "id", ts: str = "ts",
                   duration: str | float = "10 seconds", duration_col: str | None = None,
                   tiebreak: str | None = None) -> DataFrame:
    """#22 a switch row opens forwarding of its key's readings for ``duration``
    (or the per-row ``duration_col`` in milliseconds): a reading passes iff some
    switch has ``s.ts <= r.ts < s.ts + dur``. Each reading passes at most once.

    Formulated without pairs: union both streams and keep a running max of
    ``switch end`` per key in time order (skew-safe scan); a reading passes when it
    is below that max. Overlapping switches give the union of their spans.
    """
    if duration_col:
        dur = F.make_dt_interval(secs=F.col(duration_col) / F.lit(1000.0))
    else:
        dur = F.make_dt_interval(secs=F.lit(seconds(duration)))
    payload = [c for c in readings.columns]
    tb = F.col(tiebreak) if tiebreak else F.monotonically_increasing_id()
    r = readings.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), F.lit(1).alias("_tag"),
                        tb.alias("_id"), F.lit(None).cast(readings.schema[ts].dataType).alias("_end"),
                        F.struct(*payload).alias("_row"))
    s = switches.select(F.col(key).alias("_k"), F.col(ts).alias("_t"), F.lit(0).alias("_tag"),
                        F.lit(0).cast("long").alias("_id"), (F.col(ts) + dur).alias("_end"),
                        F.lit(None).cast(r.schema["_row"].dataType).alias("_row"))
    u = running(r.unionByName(s), keys=["_k"], order=["_t", "_tag", "_id"], value="_end",
                agg="max", out="_open_until")
    return u.filter((F.col("_tag") == 1) & (F.col("_open_until") > F.col("_t"))).select("_row.*")


def match_with_timeout(orders: DataFrame, pays: DataFrame, wait: str | float, key: str = "order_id",
                       ts: str = "ts") -> DataFrame:
    """#23, all pairs: every order and pay row of the same key whose times differ by at most
    ``wait`` (either side may come first). Output rows tagged ``kind``:
    ``matched`` (order_ts, pay_ts both set), ``order_only``, ``pay_only``.
    :func:`match_one_to_one` pairs each row once."""
    w = seconds(wait)
    o = orders.select(F.col(key).alias("order_id"), F.col(ts).alias("order_ts"))
    p = pays.select(F.col(key).alias("pay_id"), F.col(ts).alias("pay_ts"), "channel")
    ob = o.withColumn("_b", _bucket("order_ts", w))
    pb = _spread(p, "pay_ts", w)
    near = F.abs(F.unix_micros(F.col("pay_ts").cast("timestamp"))
                 - F.unix_micros(F.col("order_ts").cast("timestamp"))) <= F.lit(int(w * 1e6))
    pairs = (ob.join(pb, (ob["order_id"] == pb["pay_id"]) & (ob["_b"] == pb["_b"]) & near)
             .select("order_id", "order_ts", "pay_ts", "channel"))
    o_only = ob.join(pb, (ob["order_id"] == pb["pay_id"]) & (ob["_b"] == pb["_b"]) & near, "left_anti")
    pbo = p.withColumn("_b", _bucket("pay_ts", w))
    os_ = _spread(o, "order_ts", w)
    p_only = pbo.join(os_, (pbo["pay_id"] == os_["order_id"]) & (pbo["_b"] == os_["_b"]) & near, "left_anti")
    null_ts = F.lit(None).cast(o.schema["order_ts"].dataType)
    return (pairs.withColumn("kind", F.lit("matched"))
            .unionByName(o_only.select("order_id", "order_ts", null_ts.alias("pay_ts"),
                                       F.lit(None).cast("string").alias("channel"),
                                       F.lit("order_only").alias("kind")))
            .unionByName(p_only.select(F.col("pay_id").alias("order_id"), null_ts.alias("order_ts"),
                                       "pay_ts", "channel", F.lit("pay_only").alias("kind"))))


def _pieces(rows: DataFrame, order: list[str], wait: str | float, hot: int) -> DataFrame:
    """Add ``_piece``: 0, but for keys of over ``hot`` rows the number of gaps of more than ``wait`` before the row. The scans
    that find the gaps see only those keys' rows. Keys are counted by a hash, so the counts are few; a key that shares
    a hot one's hash is cut as well."""
    hashed = F.pmod(F.xxhash64("order_id"), F.lit(_HASHES))
    many = F.broadcast(rows.groupBy(hashed.alias("_hash")).agg(F.count("*").alias("_n")).where(F.col("_n") > hot).select("_hash"))
    cold = rows.join(many, hashed == F.col("_hash"), "left_anti").withColumn("_piece", F.lit(0).cast("long"))
    u = running(rows.join(many, hashed == F.col("_hash"), "left_semi"), keys=["order_id"], order=order, value="_t", agg="last", inclusive=False, out="_prev")
    gap = F.col("_prev").isNull() | (F.col("_t") > F.col("_prev") + F.make_dt_interval(secs=F.lit(seconds(wait))))
    u = running(u.withColumn("_gap", gap.cast("long")).drop("_prev"), keys=["order_id"], order=order, value="_gap", agg="sum", out="_piece")
    return cold.unionByName(u.drop("_gap"))


def match_one_to_one(orders: DataFrame, pays: DataFrame, wait: str | float, key: str = "order_id",
                     ts: str = "ts", hot: int = 100_000) -> DataFrame:
    """#23, one with one: in time order (orders before pays at one instant, then by channel), a row takes the
    longest waiting row of the other side, if that waits no longer than ``wait``, or waits itself. A row
    serves once; rows that nothing took come out as ``order_only`` or ``pay_only``. Output as
    :func:`match_with_timeout`.

    A key's rows fold in one sorted pass that carries only the waiting rows. What can match is parted by a gap of more
    than ``wait`` between a key's rows; keys of over ``hot`` rows are cut there into pieces that fold independently
    (:func:`_pieces`), others are one piece. Rows without a time match nothing.
    """
    wait_us = int(round(seconds(wait) * 1e6))
    ts_type = orders.schema[ts].dataType
    o = orders.select(F.col(key).alias("order_id"), F.col(ts).alias("_t"), F.lit(0).alias("_side"), F.lit(None).cast("string").alias("channel"))
    p = pays.select(F.col(key).alias("order_id"), F.col(ts).cast(ts_type).alias("_t"), F.lit(1).alias("_side"), "channel")
    order = ["_t", "_side", "channel"]
    u = _pieces(o.unionByName(p), order, wait, hot)

    # fold state: [key, waiting orders, waiting pays]; records: (key, order time, pay time, channel, kind)
    def leave(k, side: int, row: tuple) -> tuple:
        return (k, row[0], None, None, "order_only") if side == 0 else (k, None, row[0], row[1], "pay_only")

    def close(st) -> list[tuple]:
        return [leave(st[0], side, row) for side in (0, 1) for row in st[1 + side]]

    def scan(columns: dict[str, list], starts: list[bool], st):
        out: list[tuple] = []
        for start, k, t, side, channel in zip(starts, columns["order_id"], columns["_t"], columns["_side"], columns["channel"]):
            if start:
                if st is not None:
                    out += close(st)
                st = [k, deque(), deque()]
            if t is None:
                out.append(leave(k, side, (t, channel)))
                continue
            for s in (0, 1):
                while st[1 + s] and t - st[1 + s][0][0] > wait_us:
                    out.append(leave(k, s, st[1 + s].popleft()))
            other = st[2 - side]
            if other:
                row = other.popleft()
                out.append((k, t, row[0], row[1], "matched") if side == 0 else (k, row[0], t, channel, "matched"))
            else:
                st[1 + side].append((t, channel))
        return out, st

    schema = T.StructType([T.StructField("order_id", u.schema["order_id"].dataType), T.StructField("order_ts", ts_type), T.StructField("pay_ts", ts_type),
                           T.StructField("channel", T.StringType()), T.StructField("kind", T.StringType())])
    return fold_pieces(u.select("order_id", "_t", "_side", "channel", "_piece"), ["order_id", "_piece"], order, schema, scan, close)


def order_timeout(creates: DataFrame, pays: DataFrame, wait: str | float = "5 seconds",
                  key: str = "order_id", ts: str = "ts") -> DataFrame:
    """#57 creates with no pay within ``wait`` on either side (both ends inclusive):
    the keyed-timer job as a bucketed anti-join. One create per order (the earliest)."""
    w = seconds(wait)
    c = creates.groupBy(key).agg(F.min(ts).alias("ts")).withColumn("_b", _bucket("ts", w))
    p = _spread(pays.select(F.col(key).alias("_pk"), F.col(ts).alias("_pt")), "_pt", w)
    near = F.abs(F.unix_micros(F.col("_pt").cast("timestamp"))
                 - F.unix_micros(F.col("ts").cast("timestamp"))) <= F.lit(int(w * 1e6))
    timed_out = c.join(p, (c[key] == p["_pk"]) & (c["_b"] == p["_b"]) & near, "left_anti")
    return timed_out.select(key, F.lit("create").alias("op"), "ts")

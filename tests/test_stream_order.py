"""Stream = batch for rows out of order across micro-batches, with a restart from the checkpoint: keyed state (#22-#26,
#53-#57)."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from stream_util import FLUSH, parts_out_of_order, run_in_parts
from streamlens.operators import alerts, match, rolling
from streamlens.sources import testdata as td
from streamlens.streaming import aggregates as sa
from streamlens.streaming import processors as sp

DAY = 86400


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*[F.col(c).cast("timestamp").alias(c) if t.startswith("timestamp") else F.col(c)
                                                 for c, t in df.select(*cols).dtypes]).collect()), key=repr)


def run(spark, tmp_path, df, build, ts="ts", bound_s=2 * DAY, flush=None, parts=4):
    return run_in_parts(spark, tmp_path, parts_out_of_order(df, ts, bound_s, parts),
                        lambda s: build(sa.with_event_time(s, ts, f"{bound_s} seconds")), restart_after=parts // 2, flush=flush)


def test_rolling_and_jump(spark, tmp_path):
    b = td.sensor(spark, SF001).select("event_id", "id", "ts", "temperature")
    b = b.withColumn("temperature", F.when(F.col("event_id") % 7 != 0, F.col("temperature")))
    flush = (-1, "zz", FLUSH, 0.0)
    got = run(spark, tmp_path, b, lambda s: sp.rolling(s, "id", "temperature", "ts", ("event_id",), "min", "m", ("event_id",)), flush=flush)
    want = rolling.rolling_min(b, "id", "temperature", ("ts", "event_id"), out="m")
    assert rows(got.where("event_id >= 0"), "event_id", "m") == rows(want, "event_id", "m")
    got = run(spark, tmp_path, b, lambda s: sp.jump_alert(s, "id", "temperature", "ts", ("event_id",), 1.7, 20.0, ("event_id", "ts")), flush=flush)
    want = rolling.jump_alert(b, "id", "temperature", ("ts", "event_id"), 1.7, 20.0)
    assert rows(got.where("event_id >= 0"), "event_id", "ts", "last") == rows(want, "event_id", "ts", "last") != []


def test_sums_are_exact(spark, tmp_path):
    big = 2**53 + 1
    data = [("a", datetime(2024, 1, 1) + timedelta(seconds=7 * i % 60, microseconds=i), big, Decimal("0.10") if i % 3 else None, i) for i in range(30)]
    df = spark.createDataFrame(data, "k string, ts timestamp, n long, d decimal(10,2), i int")
    flush = ("zz", FLUSH, 0, Decimal(0), -1)
    for value in ("n", "d"):
        got = run(spark, tmp_path, df, lambda s: sp.rolling(s, "k", value, "ts", ("i",), out="s", keep=("i",)), bound_s=60, flush=flush, parts=3)
        want = rolling.rolling_sum(df, "k", value, ("ts", "i"), out="s")
        assert got.schema["s"].dataType.simpleString() == {"n": "bigint", "d": "decimal(20,2)"}[value]
        assert rows(got.where("i >= 0"), "i", "s") == rows(want, "i", "s")


def test_rolling_list(spark, tmp_path):
    b = td.behavior(spark, SF001).select("event_id", "user_id", "behavior", "ts").where("event_id % 3 = 0")
    got = run(spark, tmp_path, b, lambda s: sp.rolling_list(s, "user_id", "behavior", "ts", ("event_id",), keep=("event_id",)), flush=(-1, -1, "x", FLUSH))
    want = rolling.rolling_list(b, "user_id", "behavior", ("ts", "event_id"))
    join = F.array_join("items", ",").alias("i")
    assert rows(got.where("event_id >= 0").select("event_id", join), "event_id", "i") == rows(want.select("event_id", join), "event_id", "i")


def test_sustained_rise(spark, tmp_path):
    b = td.sensor(spark, SF001).select("id", "ts", "temperature", "event_id")
    got = run(spark, tmp_path, b, lambda s: sp.sustained_rise(s, "id", "ts", "temperature", ("event_id",), "10 minutes"), flush=("zz", FLUSH, 0.0, 0))
    want = alerts.sustained_rise(b, "id", "ts", "temperature", ("ts", "event_id"), "10 minutes", rearm=True)
    assert rows(got, "id", "rise_ts", "alert_ts") == rows(want, "id", "rise_ts", "alert_ts") != []


@pytest.mark.parametrize("rearm", [False, True])
def test_repeated_failures(spark, tmp_path, rearm):
    b = td.login(spark, SF001).select("user_id", "ts", "event_type")
    got = run(spark, tmp_path, b, lambda s: sp.repeated_failures(s, span="1 day", rearm=rearm), flush=("zz", FLUSH, "success"))
    want = alerts.repeated_failures(b, span="1 day", rearm=rearm)
    cols = ("user_id", "span_start", "span_end", "n_fails")
    assert rows(got, *cols) == rows(want, *cols) != []


def test_order_timeout(spark, tmp_path):
    ev = td.order_events(spark, SF001)
    flush = tuple({"order_id": "zz", "op": "none"}.get(c, FLUSH) for c in ev.columns)
    got = run(spark, tmp_path, ev, lambda s: sp.order_timeout(s, "30 days"), bound_s=20 * DAY, flush=flush)
    want = match.order_timeout(td.order_creates(spark, SF001), td.pays(spark, SF001), "30 days")
    assert rows(got, "order_id", "op", "ts") == rows(want, "order_id", "op", "ts") != []


def tagged(o, p):
    return o.select("order_id", "ts", F.lit("o").alias("side"), F.lit(None).cast("string").alias("channel")).unionByName(
        p.select("order_id", "ts", F.lit("p").alias("side"), "channel"))


@pytest.mark.parametrize("dense", [False, True])
def test_match_one_to_one(spark, tmp_path, dense):
    o, p = td.order_creates(spark, SF001).select("order_id", "ts"), td.pays(spark, SF001)
    if dense:  # few keys with many rows each, so that rows queue
        o, p = (d.withColumn("order_id", F.pmod(F.xxhash64("order_id"), F.lit(5)).cast("string")) for d in (o, p))

    def build(s):
        return sp.match_one_to_one(s.where("side = 'o'").select("order_id", "ts"), s.where("side = 'p'").select("order_id", "ts", "channel"), "1 day")

    got = run(spark, tmp_path, tagged(o, p), build, bound_s=20 * DAY, flush=("zz", FLUSH, "o", None))
    want = match.match_one_to_one(o, p, "1 day")
    cols = ("order_id", "order_ts", "pay_ts", "channel", "kind")
    assert rows(got.where("order_id <> 'zz'"), *cols) == rows(want, *cols)
    assert {"order_only", "pay_only", "matched"} >= {r.kind for r in got.collect()}


def test_forward_switch(spark, tmp_path):
    readings = td.sensor(spark, SF001).select("id", "ts", "event_id")
    e = td.events(spark, SF001).where("event_type = 'signup'")
    switches = e.select(F.concat(F.lit("sensor_"), (F.col("user_id") % 10 + 1).cast("string")).alias("id"), "ts")
    both = readings.withColumn("what", F.lit("r")).unionByName(switches.select("id", "ts", F.lit(-1).cast("long").alias("event_id"), F.lit("s").alias("what")))

    def build(s):
        return sp.forward_switch(s.where("what = 'r'"), s.where("what = 's'"), duration="10 hours", keep=("event_id",), tiebreak=("event_id",))

    got = run(spark, tmp_path, both, build, flush=("zz", FLUSH, -1, "r"))
    want = match.forward_switch(readings, switches, "id", "ts", "10 hours", tiebreak="event_id")
    assert rows(got, "event_id") == rows(want, "event_id") != []


def test_null_keys_and_idle_state(spark, tmp_path):
    """A null key is a key; with an idle time a key starts anew after it."""
    t = datetime(2024, 1, 1)
    data = [(None, t, 1), (None, t + timedelta(seconds=5), 2), ("a", t, 10), ("a", t + timedelta(hours=2), 20)]
    parts = [spark.createDataFrame([d], "k string, ts timestamp, n long") for d in [data[0], data[1], data[2], ("x", t + timedelta(hours=1), 0), data[3]]]
    got = run_in_parts(spark, tmp_path, parts, lambda s: sp.rolling(sa.with_event_time(s, "ts", "10 seconds"), "k", "n", "ts", keep=("n",), idle="30 minutes"),
                       flush=("zz", FLUSH, 0))
    found = sorted((r.n, r["sum"]) for r in got.collect() if r.n)
    assert found == [(1, 1), (2, 3), (10, 10), (20, 20)]

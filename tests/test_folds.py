"""Re-arming timers and one-to-one matching against plain Python loops, with tiny Arrow batches so that pieces
straddle batch boundaries; null and long keys."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest

from conftest import SF001
from pyspark.sql import functions as F

from streamlens.operators import alerts, match
from streamlens.sources import testdata as td


@pytest.fixture
def tiny_batches(spark):
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def _brute_failures(rows, span, min_fails):
    by = defaultdict(list)
    for r in rows:
        if r.event_type in ("fail", "success"):
            by[r.user_id].append((r.ts, r.event_id, r.event_type))
    out = []
    for k, evs in by.items():
        t0, n = None, 0
        for t, _, e in sorted(evs):
            if t0 is not None and t > t0 + span:
                if n >= min_fails:
                    out.append((k, t0, n))
                t0, n = None, 0
            if e == "fail":
                n += 1
                t0 = t if t0 is None else t0
            else:
                t0, n = None, 0
        if t0 is not None and n >= min_fails:
            out.append((k, t0, n))
    return sorted(out)


def _brute_rise(rows, hold):
    by = defaultdict(list)
    for r in rows:
        by[r.id].append((r.ts, r.event_id, r.temperature))
    out = []
    for k, evs in by.items():
        last, deadline = None, None
        for t, _, v in sorted(evs):
            if deadline is not None and t > deadline:
                out.append((k, deadline - hold, deadline))
                deadline = None
            if last is not None and v > last and deadline is None:
                deadline = t + hold
            elif last is not None and v < last:
                deadline = None
            last = v
        if deadline is not None:
            out.append((k, deadline - hold, deadline))
    return sorted(out)


def test_failures_rearm_equals_brute_force(spark, tiny_batches):
    lg = td.login(spark, SF001)
    got = sorted((r.user_id, r.span_start, r.n_fails)
                 for r in alerts.repeated_failures(lg, span="1 day", rearm=True).collect())
    assert got == _brute_failures(lg.collect(), timedelta(days=1), 2) and got


def test_rise_rearm_equals_brute_force(spark, tiny_batches):
    s = td.sensor(spark, SF001)
    got = sorted((r.id, r.rise_ts, r.alert_ts) for r in
                 alerts.sustained_rise(s, "id", "ts", "temperature", ("ts", "event_id"), "10 minutes",
                                       rearm=True).collect())
    assert got == _brute_rise(s.collect(), timedelta(minutes=10)) and got


KEYS = (None, 2**53 + 1, 2**53)


def test_null_and_long_keys_alert(spark):
    t = datetime(2024, 1, 1)
    data = [(k, t + timedelta(seconds=s), "fail") for k in KEYS for s in (0, 1, 20, 21)]
    df = spark.createDataFrame(data, "user_id long, ts timestamp, event_type string")
    got = [(r.user_id, r.span_start, r.n_fails) for r in alerts.repeated_failures(df, rearm=True).collect()]
    assert sorted(got, key=repr) == sorted(((k, t + timedelta(seconds=s), 2) for k in KEYS for s in (0, 20)), key=repr)
    first = [(r.user_id, r.span_start, r.n_fails) for r in alerts.repeated_failures(df).collect()]
    assert sorted(first, key=repr) == sorted(((k, t, 2) for k in KEYS), key=repr)
    values = spark.createDataFrame([(k, t + timedelta(seconds=s), float(s)) for k in KEYS for s in range(5)], "id long, ts timestamp, temperature double")
    got = [(r.id, r.rise_ts) for r in alerts.sustained_rise(values, hold="1 second", rearm=True).collect()]
    assert sorted(got, key=repr) == sorted(((k, t + timedelta(seconds=s)) for k in KEYS for s in (1, 3)), key=repr)


def test_null_and_long_keys_match(spark, tiny_batches):
    t = datetime(2024, 1, 1)
    orders = spark.createDataFrame([(k, t + timedelta(seconds=s)) for k in KEYS for s in (0, 1, 50)], "order_id long, ts timestamp")
    pays = spark.createDataFrame([(k, "c", t + timedelta(seconds=s)) for k in KEYS for s in (2, 3, 99)], "order_id long, channel string, ts timestamp")
    got = sorted(((r.order_id, r.kind, r.order_ts, r.pay_ts) for r in match.match_one_to_one(orders, pays, "5 seconds").collect()), key=repr)
    at = lambda s: t + timedelta(seconds=s)
    want = [(k, *x) for k in KEYS for x in (("matched", at(0), at(2)), ("matched", at(1), at(3)), ("order_only", at(50), None), ("pay_only", None, at(99)))]
    assert got == sorted(want, key=repr)


def test_match_cuts_only_hot_keys(spark, capsys):
    """A plan without keys of many rows has no window over the rows; keys that are cut into pieces give the same rows."""
    t = datetime(2024, 1, 1)
    rng = random.Random(5)
    at = lambda: None if rng.random() < 0.05 else t + timedelta(seconds=rng.randrange(600))
    key = lambda: rng.choice([None, 1, 1, 1, 2, 3])
    orders = spark.createDataFrame([(key(), at()) for _ in range(150)], "order_id long, ts timestamp")
    pays = spark.createDataFrame([(key(), rng.choice("abc"), at()) for _ in range(200)], "order_id long, channel string, ts timestamp")
    found = {hot: match.match_one_to_one(orders, pays, "2 seconds", hot=hot) for hot in (0, 60, 100_000)}
    rows = {hot: sorted(map(tuple, df.collect()), key=repr) for hot, df in found.items()}
    assert rows[0] == rows[60] == rows[100_000] and {r[4] for r in rows[0]} == {"matched", "order_only", "pay_only"}
    whole = match.match_one_to_one(orders, pays, "2 seconds")
    whole.collect()
    capsys.readouterr()
    whole.explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan[plan.index("Final Plan"):plan.index("Initial Plan")]


def test_dense_key_equals_loop(spark):
    """One key without a gap: long chains inside runs, few cancels."""
    n = 20_000
    d = spark.range(n).select(F.lit(7).cast("long").alias("user_id"), F.timestamp_micros(F.col("id") * 700_000 + F.pmod(F.xxhash64("id"), F.lit(300_000))).alias("ts"),
                              F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(200)) == 0, "success").otherwise("fail").alias("event_type"), F.col("id").alias("event_id"))
    got = sorted((r.user_id, r.span_start, r.n_fails) for r in alerts.repeated_failures(d, span="5 seconds", rearm=True).collect())
    assert got == _brute_failures(d.collect(), timedelta(seconds=5), 2) and len(got) > 2000

"""Late data on streams (#48-#50, #52) and bounded top-N (#41, #42, #44)."""

import random
from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from stream_util import FLUSH, parts_out_of_order, run_in_parts
from streamlens.functions.scalar import poly_hash
from streamlens.operators import late as batch_late
from streamlens.operators import topn, windows
from streamlens.sources import testdata as td
from streamlens.streaming import aggregates as sa
from streamlens.streaming import late

T0 = datetime(2024, 1, 1)


@pytest.fixture(autouse=True)
def few_partitions(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def arrivals(spark, seconds):
    """One row per micro-batch, in this order; ``id`` is the arrival."""
    data = [("ab"[s % 2], T0 + timedelta(seconds=s), i) for i, s in enumerate(seconds)]
    df = spark.createDataFrame(data, "key string, ts timestamp, id long")
    return df, [spark.createDataFrame([d], df.schema) for d in data]


# jumps, rows late for the row but not for the window, rows late for both, ties, long silences
SECONDS = [1, 3, 12, 4, 13, 2, 25, 14, 11, 26, 5, 60, 27, 58, 59, 47, 61]


def test_late_rows_equal_batch(spark, tmp_path):
    df, parts = arrivals(spark, SECONDS)
    got = run_in_parts(spark, tmp_path, parts, lambda s: late.late_rows(sa.with_event_time(s, "ts", "5 seconds"), "ts", 4), restart_after=6)
    want = batch_late.late_rows(df, "ts", ["id"], "5 seconds")
    assert sorted((r.id, r.key, r.ts, r.is_late) for r in got.collect()) == sorted((r.id, r.key, r.ts, r.is_late) for r in want.collect())
    assert got.where("is_late").count() > 3


def test_late_windows_equal_batch(spark, tmp_path):
    df, parts = arrivals(spark, SECONDS)
    main, side = str(tmp_path / "main"), str(tmp_path / "side")
    sink = late.split(lambda b, i: b.write.mode("overwrite").parquet(f"{main}/batch_id={i}"),
                      lambda b, i: b.write.mode("overwrite").parquet(f"{side}/batch_id={i}"), "key")
    run_in_parts(spark, tmp_path, parts, lambda s: late.late_windows(sa.with_event_time(s, "ts", "5 seconds"), "key", "ts", "10 seconds", 3),
                 restart_after=7, flush=("zz", FLUSH, -1), foreach=sink)
    counts, rows = batch_late.late_windows(df, "key", "ts", ["id"], "10 seconds", "5 seconds")
    got = sorted((r.key, r.window_end, r["count"]) for r in spark.read.parquet(main).where("key <> 'zz'").collect())
    assert got == sorted((r.key, r.window_end, r["count"]) for r in counts.collect())
    got = sorted((r.id, r.key, r.ts) for r in spark.read.parquet(side).collect())
    assert got == sorted((r.id, r.key, r.ts) for r in rows.collect()) != []


def test_many_rows_a_batch_follow_the_watermark_of_earlier_batches(spark, tmp_path):
    rng = random.Random(3)
    batches = [[("ab"[rng.randrange(2)], T0 + timedelta(seconds=max(0, 20 * k + rng.randrange(-60, 20))), 100 * k + j) for j in range(30)] for k in range(5)]
    schema = "key string, ts timestamp, id long"
    parts = [spark.createDataFrame(b, schema) for b in batches]
    sink = {"main": [], "side": []}
    run_in_parts(spark, tmp_path, parts, lambda s: late.late_windows(sa.with_event_time(s, "ts", "5 seconds"), "key", "ts", "10 seconds"),
                 restart_after=3, flush=("zz", FLUSH, -1),
                 foreach=late.split(lambda b, i: sink["main"].extend(b.collect()), lambda b, i: sink["side"].extend(b.collect()), "key"))
    counts, gone, most = {}, [], None
    for b in batches:
        for k, t, i in b:
            end = T0 + timedelta(seconds=((t - T0).seconds // 10 + 1) * 10)
            if most is not None and end - timedelta(milliseconds=1) <= most - timedelta(seconds=5):
                gone.append(i)
            else:
                counts[k, end] = counts.get((k, end), 0) + 1
        most = max([t for _, t, _ in b] + ([most] if most else []))
    assert {(r.key, r.window_end): r["count"] for r in sink["main"] if r.key != "zz"} == counts
    assert sorted(r.id for r in sink["side"]) == sorted(gone) != []


def test_allowed_lateness_equals_batch(spark, tmp_path):
    df, parts = arrivals(spark, SECONDS)
    got = run_in_parts(spark, tmp_path, parts, lambda s: late.allowed_lateness(sa.with_event_time(s, "ts", "5 seconds"), "key", "ts", "10 seconds", "12 seconds", ("id",)),
                       restart_after=7, flush=("zz", FLUSH, -1)).where("key <> 'zz'")
    want = batch_late.allowed_lateness(df, "key", "ts", ["id"], "10 seconds", "5 seconds", "12 seconds")
    cols = ("key", "window_end", "firing", "count", "is_update")
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())
    assert got.where("is_update").count() > 0
    firsts = got.where("firing = 0").groupBy("key", "window_end").count()
    assert firsts.where("count > 1").count() == 0 and got.where("firing = 0").where("is_update").count() == 0


def test_distinct_so_far_equals_batch(spark, tmp_path):
    b = td.behavior(spark, SF001).select("event_id", "user_id", "ts").where("event_id % 4 = 0")
    parts = parts_out_of_order(b, "ts", 2 * 86400, 4)
    numbered = [p.withColumn("batch", F.lit(k)) for k, p in enumerate(parts)]
    got = run_in_parts(spark, tmp_path, numbered, lambda s: late.distinct_so_far(sa.with_event_time(s, "ts", "2 days"), "user_id", "ts", "60 minutes", "20 minutes",
                       ("batch", "event_id"), ("event_id",)), restart_after=2)
    every = numbered[0]
    for p in numbered[1:]:
        every = every.unionByName(p)
    every = every.withColumn("bit", poly_hash(F.col("user_id").cast("string"))).withColumn("ts", F.col("ts").cast("timestamp"))
    want = batch_late.per_row_updates(every, "bit", "ts", ["batch", "event_id"], "60 minutes", "20 minutes")
    cols = ("event_id", "window_end", "distinct_so_far")
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(tuple(r) for r in want.select(*cols).collect())


def test_top_n_and_report_out_of_order(spark, tmp_path):
    b = td.behavior(spark, SF001).select("item_id", "ts")
    parts = parts_out_of_order(b, "ts", 2 * 86400, 4)

    def counts(s):
        return sa.window_counts(sa.with_event_time(s, "ts", "2 days"), "item_id", "ts", "60 minutes", "20 minutes")

    want = topn.top_n(windows.view_counts(b, "item_id", "ts", "60 minutes", "20 minutes"), "item_id", 3)
    got = run_in_parts(spark, tmp_path, parts, lambda s: sa.top_n(counts(s), "item_id", 3, salts=4), restart_after=2, flush=(-1, FLUSH))
    got = got.where(F.col("window_end") < FLUSH - timedelta(days=1))
    rows = sorted((r.window_end, r.item_id, r["count"], r["rank"]) for r in got.collect())
    assert rows == sorted((r.window_end, r.item_id, r["count"], r["rank"]) for r in want.collect()) != []
    got = run_in_parts(spark, tmp_path, parts, lambda s: sa.top_n_report(counts(s), "item_id", 3), restart_after=2, flush=(-1, FLUSH))
    got = {r.report for r in got.where(F.col("window_end") < FLUSH - timedelta(days=1)).collect()}
    assert got == {r.report for r in topn.ranked_report(want, "item_id").collect()}


class State:
    """A value state that remembers the largest value it held."""

    def __init__(self):
        self.value, self.most = None, 0

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.most = value, max(self.most, len(value[0]))

    def clear(self):
        self.value = None


def test_top_rows_keep_n_rows_of_many_keys():
    """100,000 keys in 8 batches of updates, counts growing: never more than n rows in the state."""
    rng = random.Random(1)
    state = State()
    p = sa.TopRows(5, "bigint")
    p.init(SimpleNamespace(getValueState=lambda *_: state, registerTimer=lambda t: None))
    count = {}
    for _ in range(8):
        batch = {}
        for _ in range(30_000):
            k = rng.randrange(100_000)
            count[k] = count.get(k, 0) + rng.randrange(1, 4)
            batch[k] = count[k]
        p.handleInputRows((1_000_000,), iter([{"keys": [k], "counts": [c]} for k, c in batch.items()]), None)
    (out,) = p.handleExpiredTimer((1_000_000,), None, None)
    want = sorted(count.items(), key=lambda e: (-e[1], e[0]))[:5]
    assert list(zip(out["keys"], out["counts"])) == want and state.most == 5 and state.value is None

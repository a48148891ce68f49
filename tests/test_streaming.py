"""Stream = batch: the same rows fed as a file stream (several micro-batches) must
give the batch operator's rows. A far-future flush row closes the last windows."""

import time
import uuid
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF001
from streamlens.operators import windows
from streamlens.sources import testdata as td
from streamlens.streaming import aggregates as sa
from streamlens.streaming import processors as sp
from streamlens.streaming.runner import file_stream, run_available

FLUSH = datetime(2100, 1, 1)
EPOCH = datetime(2024, 1, 1)


def T(s):
    return EPOCH + timedelta(seconds=s)


def _as_files(spark, df, tmp_path, slices=3, flush_row=None):
    """Write ``df`` as time-ordered files (one write per slice, later mtimes later)."""
    d = str(tmp_path / f"src_{uuid.uuid4().hex[:6]}")
    df = df.withColumn("ts", F.col("ts").cast("timestamp"))
    b = df.select(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    step = (b.b - b.a) / slices
    for i in range(slices):
        lo, hi = b.a + step * i, b.a + step * (i + 1)
        part = df.filter((F.col("ts") >= lo) & ((F.col("ts") < hi) if i < slices - 1 else F.lit(True)))
        part.coalesce(1).write.mode("append").parquet(d)
        time.sleep(1.1)
    if flush_row is not None:
        spark.createDataFrame([flush_row], df.schema).write.mode("append").parquet(d)
    return d, df.schema


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_uv_stream_equals_batch(spark, tmp_path):
    b = td.behavior(spark, SF001).filter("behavior = 'pv'").select("user_id", "ts")
    d, schema = _as_files(spark, b, tmp_path, flush_row=(-1, FLUSH))
    s = sa.with_event_time(file_stream(spark, d, schema), "ts", "10 minutes")
    got = run_available(sa.distinct_users(s, "user_id", "ts", "60 minutes", "5 minutes", bitmap=True))
    got = got.select(F.col("window.end").alias("window_end"), "uv").filter(F.col("window_end") < FLUSH - timedelta(days=1))
    exp = windows.uv_bitmap(b.withColumn("behavior", F.lit("pv")), "60 minutes", "5 minutes")
    exp = exp.select(F.col("window_end").cast("timestamp").alias("window_end"), "uv")
    assert _rows(got, "window_end", "uv") == _rows(exp, "window_end", "uv")


def _event_stream(spark, tmp_path, data, schema, flush_event="zz_flush"):
    d = str(tmp_path / f"ev_{uuid.uuid4().hex[:6]}")
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(d)
    time.sleep(1.1)
    zero = {"string": "zz_flush", "double": 0.0}
    flush = [tuple(FLUSH if f.name == "ts" else flush_event if f.name in ("event_type", "op") else zero.get(f.dataType.simpleString(), 0)
                   for f in spark.createDataFrame(data, schema).schema)]
    spark.createDataFrame(flush, schema).coalesce(1).write.mode("append").parquet(d)
    return sa.with_event_time(file_stream(spark, d, spark.createDataFrame(data, schema).schema), "ts", "0 seconds")


def test_sustained_rise_processor(spark, tmp_path):
    data = [("k", T(0), 60.0), ("k", T(0.5), 61.0), ("k", T(1.6), 62.0), ("k", T(2.0), 60.0),
            ("k", T(2.2), 61.0), ("k", T(2.5), 60.0)]
    s = _event_stream(spark, tmp_path, data, "id string, ts timestamp, temperature double")
    out = run_available(sp.sustained_rise(s, "id", "ts", "temperature", hold="1 second"))
    assert _rows(out.filter("id = 'k'"), "rise_ts", "alert_ts") == [(T(0.5), T(1.5))]


def test_repeated_failures_processor(spark, tmp_path):
    data = [("1", T(1), "fail"), ("1", T(2), "success"), ("1", T(3), "fail"), ("1", T(4), "fail"),
            ("2", T(1), "fail"), ("2", T(3), "fail"), ("2", T(4), "fail"), ("9", T(100), "success")]
    s = _event_stream(spark, tmp_path, data, "user_id string, ts timestamp, event_type string", flush_event="success")
    lit = run_available(sp.repeated_failures(s, span="5 seconds"))
    assert _rows(lit, "user_id", "span_start", "n_fails") == [("2", T(1), 3)]
    s2 = _event_stream(spark, tmp_path, data, "user_id string, ts timestamp, event_type string", flush_event="success")
    re = run_available(sp.repeated_failures(s2, span="5 seconds", rearm=True))
    assert _rows(re, "user_id", "span_start", "n_fails") == [("1", T(3), 2), ("2", T(1), 3)]


def test_order_timeout_processor(spark, tmp_path):
    data = [("1", "create", T(842)), ("2", "create", T(843)), ("2", "pay", T(844)),
            ("3", "pay", T(942)), ("4", "pay", T(943)), ("9", "create", T(0)), ("9", "pay", T(5))]
    s = _event_stream(spark, tmp_path, data, "order_id string, op string, ts timestamp", flush_event="pay")
    out = run_available(sp.order_timeout(s, "5 seconds"))
    assert _rows(out, "order_id", "op", "ts") == [("1", "create", T(842))]


def test_forward_switch_processor(spark, tmp_path):
    data = [("sensor_2", T(t), 1, 0, i) for i, t in enumerate([0, 5, 9.99, 10, 15])] + [
        ("sensor_2", T(5), 0, 10000, 99), ("sensor_1", T(6), 1, 0, 7)]
    s = _event_stream(spark, tmp_path, data, "id string, ts timestamp, tag int, dur_ms long, rid long")
    out = run_available(sp.forward_switch(s.filter("tag = 1"), s.filter("tag = 0"), duration_col="dur_ms", keep=("rid",)))
    assert _rows(out, "rid") == [(1,), (2,), (3,)]


def test_pattern_processor_equals_batch(spark, tmp_path):
    from streamlens.operators import patterns
    lg = td.login(spark, SF001)
    within = "2 days"
    m_b = patterns.fail_sequence(lg, within)
    steps = [(n, F.col("event_type") == "fail") for n in ("begin", "next", "third")]
    src = sp.pattern_rows(lg, "user_id", steps, ("ip", "ts")).select(
        "user_id", "ts", "event_id", "_s0", "_s1", "_s2", "payload")
    d, schema = _as_files(spark, src, tmp_path, flush_row=("zz_flush", FLUSH, 0, False, False, False, "{}"))
    s = sa.with_event_time(file_stream(spark, d, schema), "ts", "0 seconds")
    out = run_available(sp.apply(s, "user_id", sp.SequencePattern("ts", 3, 2 * 86400 * 1000, "event_id"),
                                 "key string, kind string, payloads array<string>", time_mode="EventTime"))
    got = sorted((r.key, r.payloads[0]) for r in out.filter("kind = 'match'").collect())
    exp = lg.select("user_id", "ip", "ts").join(m_b.select("user_id", F.col("begin_ip").alias("ip"),
                                                         F.col("begin_ts").alias("ts")), ["user_id", "ip", "ts"])
    exp = sorted((r.user_id, r.p) for r in exp.select("user_id", F.to_json(F.struct(
        "ip", "ts")).alias("p")).collect())
    assert len(got) == m_b.count() > 0
    assert got == exp


def test_stream_join_match_with_timeout(spark, tmp_path):
    from streamlens.streaming import joins
    o = [("1", T(842)), ("2", T(843)), ("3", T(849))]
    p = [("1", "weixin", T(847)), ("2", "zhifubao", T(848)), ("4", "zhifubao", T(850))]
    do, dp = str(tmp_path / "o"), str(tmp_path / "p")
    spark.createDataFrame(o + [("zz", FLUSH)], "order_id string, ts timestamp").coalesce(1).write.parquet(do)
    spark.createDataFrame(p + [("zz", "x", FLUSH)], "order_id string, channel string, ts timestamp").coalesce(1).write.parquet(dp)
    so = file_stream(spark, do, "order_id string, ts timestamp")
    sp_ = file_stream(spark, dp, "order_id string, channel string, ts timestamp")
    out = run_available(joins.match_with_timeout(so, sp_, "5 seconds"))
    got = {(r.kind, r.order_id) for r in out.filter("order_id <> 'zz'").collect()}
    assert ("matched", "1") in got and ("matched", "2") in got
    # outer rows appear once the watermark passes them; the flush row moves it
    assert ("order_only", "3") in got and ("pay_only", "4") in got


def test_hot_items_report_from_text_lines(spark, tmp_path):
    from streamlens.plans.streams import hot_items_report_stream
    from streamlens.sources import read_lines
    from streamlens.operators import topn as btopn
    lines = td.behavior_lines(spark, SF001)
    d = str(tmp_path / "lines")
    lines.coalesce(1).write.text(d)
    time.sleep(1.1)
    spark.createDataFrame([("-1,-1,0,pv,4102444800",)], "value string").write.mode("append").text(d)
    rep = run_available(hot_items_report_stream(read_lines(spark, d, stream=True, max_files_per_trigger=1),
                                                bound="10 minutes"))
    rep = rep.filter(F.col("window_end") < FLUSH - timedelta(days=1))
    b = td.behavior(spark, SF001)
    b = b.withColumn("ts", F.date_trunc("second", "ts"))
    exp = btopn.ranked_report(btopn.top_n(windows.view_counts(b, "item_id", "ts", "60 minutes", "5 minutes"),
                                          "item_id", 3), "item_id")
    assert rep.count() == exp.count() > 0
    got = {r.report for r in rep.collect()}
    assert got == {r.report for r in exp.collect()}


def test_restart_from_checkpoint_is_exactly_once(spark, tmp_path):
    """Stop after the first files, add more, restart from the same checkpoint: the file
    sink holds every window once, equal to the batch result."""
    b = td.behavior(spark, SF001).select("item_id", "ts").withColumn("ts", F.col("ts").cast("timestamp"))
    src_dir, out_dir, ck = str(tmp_path / "src"), str(tmp_path / "out"), str(tmp_path / "ck")
    bounds = b.select(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
    mid = bounds.a + (bounds.b - bounds.a) / 2
    b.filter(F.col("ts") < mid).coalesce(1).write.parquet(src_dir)

    def run():
        s = sa.with_event_time(file_stream(spark, src_dir, b.schema), "ts", "10 minutes")
        c = sa.window_counts(s, "item_id", "ts", "60 minutes", "5 minutes")
        c = c.select(F.col("window.end").alias("window_end"), "item_id", "count")
        q = (c.writeStream.format("parquet").option("path", out_dir).option("checkpointLocation", ck)
             .outputMode("append").trigger(availableNow=True).start())
        assert q.awaitTermination(180)

    run()
    time.sleep(1.1)
    b.filter(F.col("ts") >= mid).coalesce(1).write.mode("append").parquet(src_dir)
    time.sleep(1.1)
    spark.createDataFrame([(-1, FLUSH)], b.schema).write.mode("append").parquet(src_dir)
    run()
    got = spark.read.parquet(out_dir).filter(F.col("window_end") < FLUSH - timedelta(days=1))
    exp = windows.view_counts(b, "item_id", "ts", "60 minutes", "5 minutes")
    assert _rows(got, "window_end", "item_id", "count") == _rows(exp, "window_end", "item_id", "count")


def test_order_pattern_timeouts_stream_equals_batch(spark, tmp_path):
    from streamlens.operators import patterns
    ev = td.order_events(spark, SF001)
    m_b, t_b = patterns.order_pay_pattern(ev, "30 days")
    src = ev.select("order_id", "ts", (F.col("op") == "create").alias("_s0"), (F.col("op") == "pay").alias("_s1"),
                    F.when(F.col("op") == "create", 0).otherwise(1).cast("long").alias("tb"),
                    F.col("op").alias("payload"))
    d, schema = _as_files(spark, src, tmp_path, flush_row=("zz_flush", FLUSH, False, False, 0, "flush"))
    s = sa.with_event_time(file_stream(spark, d, schema), "ts", "0 seconds")
    out = run_available(sp.apply(s, "order_id", sp.SequencePattern("ts", 2, 30 * 86400 * 1000, "tb"),
                                 "key string, kind string, payloads array<string>", time_mode="EventTime"))
    got_t = sorted(r.key for r in out.filter("kind = 'timeout'").collect())
    got_m = sorted(r.key for r in out.filter("kind = 'match'").collect())
    assert got_m == sorted(r.order_id for r in m_b.collect())
    assert got_t == sorted(r.order_id for r in t_b.collect())


def test_stream_join_order_timeout(spark, tmp_path):
    from streamlens.streaming import joins
    c = [("1", T(842)), ("2", T(843)), ("9", T(0))]
    p = [("2", T(844)), ("3", T(942)), ("9", T(5))]
    dc, dp = str(tmp_path / "c"), str(tmp_path / "p")
    spark.createDataFrame(c + [("zz", FLUSH)], "order_id string, ts timestamp").coalesce(1).write.parquet(dc)
    spark.createDataFrame(p + [("zz", FLUSH)], "order_id string, ts timestamp").coalesce(1).write.parquet(dp)
    out = run_available(joins.order_timeout(file_stream(spark, dc, "order_id string, ts timestamp"),
                                            file_stream(spark, dp, "order_id string, ts timestamp"), "5 seconds"))
    assert sorted(r.order_id for r in out.filter("order_id <> 'zz'").collect()) == ["1"]


def test_early_counts_update_mode(spark, tmp_path):
    """#51/#52: each trigger re-emits the running count of a still-open window."""
    d = str(tmp_path / "early")
    for t in [0.2, 1.4]:
        spark.createDataFrame([("a", T(t))], "key string, ts timestamp").write.mode("append").parquet(d)
        time.sleep(1.1)
    out = run_available(sa.early_counts(file_stream(spark, d, "key string, ts timestamp", 1), "key", "ts",
                                        "5 seconds", "10 seconds"), output_mode="update")
    assert sorted(r["count"] for r in out.collect()) == [1, 2]


def test_match_with_timeout_stream_equals_batch(spark, tmp_path):
    from streamlens.operators import match
    from streamlens.streaming import joins
    o, p = td.order_creates(spark, SF001).select("order_id", "ts"), td.pays(spark, SF001)
    do, _ = _as_files(spark, o, tmp_path, slices=2, flush_row=("zz", FLUSH))
    dp, _ = _as_files(spark, p, tmp_path, slices=2, flush_row=("zz", "x", FLUSH))
    so = file_stream(spark, do, "order_id string, ts timestamp", 10)
    sp_ = file_stream(spark, dp, "order_id string, channel string, ts timestamp", 10)
    out = run_available(joins.match_with_timeout(so, sp_, "30 days"))
    got = sorted((r.kind, r.order_id) for r in out.filter("order_id <> 'zz'").collect())
    exp = sorted((r.kind, r.order_id) for r in match.match_with_timeout(o, p, "30 days").collect())
    assert got == exp

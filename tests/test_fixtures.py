"""Literal fixtures (FIXTURES.md) and boundary cases, one block per operator."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from streamlens.operators import alerts, basic, late, match, patterns, rolling, topn, windows
from streamlens.sources import from_rows, parse
from streamlens.functions import poly_hash

EPOCH = datetime(1970, 1, 1)


def T(s):
    return EPOCH + timedelta(seconds=s)


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect()) if cols else sorted(tuple(r) for r in df.collect())


# ---- sources, parsing --------------------------------------------------------------

def test_in_memory_source(spark):
    data = [("sensor_1", T(1547718199), 35.80018327300259), ("sensor_6", T(1547718199), 15.402984393403084),
            ("sensor_7", T(1547718199), 6.720945201171228), ("sensor_10", T(1547718199), 38.101067604893444)]
    df = from_rows(spark, data, "id string, ts timestamp_ntz, temperature double")
    assert df.count() == 4 and rows(df, "id")[0] == ("sensor_1",)


def test_parsers_route_malformed_lines(spark):
    lines = spark.createDataFrame([("543462,1715,1464116,pv,1511658000",), ("x,1715,1,pv,1",),
                                   ("1,2,3,pv",), ("1,2,3,pv,4,5",)], "value string")
    ok, bad = parse.parse_behavior_csv(lines)
    assert rows(ok, "user_id", "item_id", "category_id", "behavior") == [(543462, 1715, 1464116, "pv")]
    assert ok.first().ts == datetime(2017, 11, 26, 1, 0) and bad.count() == 3
    log = spark.createDataFrame([("83.149.9.216 - - 17/05/2015:10:05:03 +0000 GET /presentations/",),
                                 ("1.2.3.4 - - notadate +0000 GET /x",), ("short line",)], "value string")
    ok, bad = parse.parse_access_log(log)
    r = ok.first()
    assert (r.ip, r.user_id, r.method, r.url) == ("83.149.9.216", "-", "GET", "/presentations/")
    assert r.ts == datetime(2015, 5, 17, 10, 5, 3) and bad.count() == 2
    ks = spark.createDataFrame([("a,1",), ("b,notanumber",), ("c",)], "value string")
    ok, bad = parse.parse_key_seconds(ks)
    assert rows(ok, "key") == [("a",)] and bad.count() == 2


def test_tokenise_drops_empty_words(spark):
    df = spark.createDataFrame([("a b, ,a.",), ("",)], "text string")
    got = basic.tokenise(df).groupBy("word").count()
    assert rows(got) == [("a", 2), ("b", 1)]


def test_rich_map_plus_one(spark):
    df = spark.createDataFrame([(1,), (2,), (3,)], "v long")
    assert rows(basic.plus_one(df, "v", "w"), "w") == [(2,), (3,), (4,)]


def test_alarm_split(spark):
    df = spark.createDataFrame([("s1", T(0), 59.0), ("s2", T(0), 60.0)], "id string, ts timestamp_ntz, temperature double")
    main, alarms = basic.alarm_split(df, 60.0)
    assert main.count() == 2
    assert rows(alarms) == [("templuter less than 60 alarm :s1",)]


def test_union_and_co_map(spark):
    a = spark.createDataFrame([(1,), (4,), (4,)], "v int")
    b = spark.createDataFrame([(2,), (5,)], "v int")
    c = spark.createDataFrame([(3,), (6,)], "v int")
    assert sorted(r.v for r in basic.union_all(a, b, c).collect()) == [1, 2, 3, 4, 4, 5, 6]
    left = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    right = spark.createDataFrame([(1, 1), (1, 2)], "k int, v int")
    got = basic.co_map(left, right, basic.suffix_map1("v"), basic.suffix_map2("v"))
    assert rows(got) == sorted([("a：from map1",), ("b：from map1",), ("1：from map2",), ("2：from map2",)])


# ---- rolling ---------------------------------------------------------------------------

def test_rolling_sum_and_list(spark):
    df = spark.createDataFrame([(1, 3, 0), (2, 2, 1), (1, 2, 2)], "k int, v int, seq int")
    assert rows(rolling.rolling_sum(df, "k", "v", ["seq"]), "k", "sum", "seq") == [(1, 3, 0), (1, 5, 2), (2, 2, 1)]
    lists = spark.createDataFrame([("en", ["tea"], 0), ("fr", ["vin"], 1), ("en", ["cake"], 2), ("fr", ["je"], 3)],
                                  "k string, v array<string>, seq int")
    got = {r.seq: list(r.items) for r in rolling.rolling_list(lists, "k", "v", ["seq"]).collect()}
    assert got == {0: ["tea"], 1: ["vin"], 2: ["tea", "cake"], 3: ["vin", "je"]}


def test_rolling_min_keeps_latest_ts(spark):
    df = spark.createDataFrame([("a", T(1), 5.0), ("a", T(2), 7.0), ("a", T(3), 4.0)],
                               "id string, ts timestamp_ntz, t double")
    got = rows(rolling.rolling_min(df, "id", "t", ["ts"]), "ts", "min")
    assert got == [(T(1), 5.0), (T(2), 5.0), (T(3), 4.0)]


def test_jump_alerts(spark):
    df = spark.createDataFrame([("a", T(0), 65.0), ("a", T(1), 66.0), ("a", T(2), 68.0)],
                               "id string, ts timestamp_ntz, t double")
    with_init = rows(rolling.jump_alert(df, "id", "t", ["ts"], 1.7, initial=0.0), "t", "last")
    assert with_init == [(65.0, 0.0), (68.0, 66.0)]
    assert rows(rolling.jump_alert(df, "id", "t", ["ts"], 1.7), "t", "last") == [(68.0, 66.0)]


# ---- windows -----------------------------------------------------------------------------

def test_tumbling_boundaries(spark):
    df = spark.createDataFrame([("a", T(0)), ("a", T(4.999)), ("a", T(5.0))], "key string, ts timestamp_ntz")
    got = rows(windows.count_per_key(df, "key", "ts", "5 seconds"), "window_end", "count")
    assert got == [(T(5), 2), (T(10), 1)]


def test_sliding_one_row_twelve_windows_and_pane_equal(spark):
    df = spark.createDataFrame([("i", T(0))], "item string, ts timestamp_ntz")
    direct = windows.view_counts(df, "item", size="60 minutes", slide="5 minutes")
    ends = [r.window_end for r in direct.orderBy("window_end").collect()]
    assert len(ends) == 12 and ends[0] == T(300) and ends[-1] == T(3600)
    many = spark.range(0, 500).select((F.col("id") % 7).cast("string").alias("item"),
                                      F.timestamp_seconds(F.col("id") * 37).cast("timestamp_ntz").alias("ts"))
    a = windows.window_agg(many, "ts", "10 minutes", {"count": F.count("*")}, slide="1 minute", keys=("item",))
    b = windows.view_counts(many, "item", size="10 minutes", slide="1 minute")
    assert rows(a, "item", "window_end", "count") == rows(b, "item", "window_end", "count")


def test_aggregates(spark):
    df = spark.createDataFrame([("s", T(1), 10.0), ("s", T(2), 20.0), ("s", T(17), 5.0)],
                               "id string, ts timestamp_ntz, temperature double")
    assert rows(windows.avg_count(df, "16 seconds"), "avg_temp", "n") == [(5.0, 1), (15.0, 2)]
    assert rows(windows.min_max(df, "5 seconds"), "min_temp", "max_temp") == [(5.0, 5.0), (10.0, 20.0)]
    assert rows(windows.min_reduce(df, "15 seconds"), "min_temp") == [(5.0,), (10.0,)]


def test_uv_bitmap_hash(spark):
    h = spark.range(1).select(poly_hash(F.lit("12345")).alias("h")).first().h
    assert h == 25247
    # find two user ids with equal 16-bit hash: they count once in the bitmap, twice exactly
    ids = spark.range(0, 70000).select(F.col("id").cast("string").alias("u"),
                                       poly_hash(F.col("id").cast("string")).alias("h"))
    pair = ids.groupBy("h").agg(F.collect_list("u").alias("us")).filter(F.size("us") > 1).first().us[:2]
    b = spark.createDataFrame([(int(pair[0]), "pv", T(0)), (int(pair[1]), "pv", T(1))],
                              "user_id long, behavior string, ts timestamp_ntz")
    assert rows(windows.uv_bitmap(b, "1 hour", "1 hour"), "uv") == [(1,)]
    assert rows(windows.uv_exact(b, "1 hour", "1 hour"), "uv") == [(2,)]
    two = spark.createDataFrame([(1, "pv", T(0)), (2, "pv", T(1))], "user_id long, behavior string, ts timestamp_ntz")
    assert rows(windows.uv_bitmap(two, "1 hour", "1 hour"), "uv") == [(2,)]


def test_topn_ties_by_key_and_report(spark):
    c = spark.createDataFrame([("a", T(60), 3), ("b", T(60), 2), ("c", T(60), 2), ("d", T(60), 1)],
                              "k string, window_end timestamp_ntz, count long")
    top = topn.top_n(c, "k", 3)
    assert rows(top, "k", "rank") == [("a", 1), ("b", 2), ("c", 3)]
    rep = topn.ranked_report(top, "k").first().report
    assert rep.startswith("=============================时间： 1970-01-01 00:01:00.0\nNo1:商品ID = a浏览量=3\n")
    assert rep.endswith("No3:商品ID = c浏览量=2\n==============================")


# ---- late data ---------------------------------------------------------------------------

def _arr(spark, data):
    return spark.createDataFrame([(k, T(t), i) for i, (k, t) in enumerate(data)],
                                 "key string, ts timestamp_ntz, arrival long")


def test_late_rows_and_windows(spark):
    df = _arr(spark, [("a", 1), ("a", 6), ("a", 2)])
    lr = {r.arrival: r.is_late for r in late.late_rows(df, "ts", ["arrival"], "0.001 seconds").collect()}
    assert lr == {0: False, 1: False, 2: True}
    counts, lt = late.late_windows(df, "key", "ts", ["arrival"], "5 seconds", "0.001 seconds")
    assert rows(counts, "window_end", "count") == [(T(5), 1), (T(10), 1)]
    assert rows(lt, "arrival") == [(2,)]


def test_allowed_lateness(spark):
    df = _arr(spark, [("a", 1), ("a", 10), ("a", 2), ("a", 20), ("a", 3)])
    got = rows(late.allowed_lateness(df, "key", "ts", ["arrival"], "5 seconds", "5 seconds", "5 seconds"),
               "window_end", "firing", "count", "is_update")
    assert (T(5), 0, 1, False) in got and (T(5), 1, 2, True) in got
    assert [g for g in got if g[0] == T(5)] == [(T(5), 0, 1, False), (T(5), 1, 2, True)]


def test_early_firings(spark):
    df = spark.createDataFrame([("a", T(0.2)), ("a", T(1.4)), ("a", T(2.6)), ("a", T(6))],
                               "key string, ts timestamp_ntz")
    got = rows(late.early_firings(df, "key", "ts", "5 seconds", "1 second").filter(F.col("window_end") == T(5)),
               "fire_time", "count", "is_final")
    assert got == [(T(1), 1, False), (T(2), 2, False), (T(3), 3, False), (T(4), 3, False), (T(5), 3, True)]


def test_early_firings_with_a_tick_that_does_not_divide_the_window(spark):
    df = spark.createDataFrame([("a", T(0.2)), ("a", T(4.5))], "key string, ts timestamp_ntz")
    got = rows(late.early_firings(df, "key", "ts", "5 seconds", "2 seconds"), "fire_time", "count", "is_final")
    assert got == [(T(2), 1, False), (T(4), 1, False), (T(5), 2, True)]


def test_durations_that_cannot_be_read_are_refused():
    for bad in ("abc", "", "5", "5 parsecs", "1 hour x"):
        with pytest.raises(ValueError):
            windows.seconds(bad)
    assert windows.seconds("1 hour 30 min") == 5400


def test_plus_one_is_exact_beside_nulls(spark):
    df = spark.createDataFrame([(9007199254740993,), (None,)], "v long")
    assert {r.o for r in basic.plus_one(df, "v", "o").collect()} == {9007199254740994, None}


def test_match_one_to_one(spark):
    o = spark.createDataFrame([("a", T(0)), ("a", T(1)), ("b", T(0)), ("c", T(0))], "order_id string, ts timestamp_ntz")
    p = spark.createDataFrame([("a", T(2), "x"), ("b", T(1), "x"), ("b", T(1), "y"), ("c", T(9), "x"), ("d", T(0), "z")], "order_id string, ts timestamp_ntz, channel string")
    got = sorted(((r.kind, r.order_id, r.order_ts, r.pay_ts, r.channel) for r in match.match_one_to_one(o, p, "5 seconds").collect()), key=str)
    assert got == sorted([("matched", "a", T(0), T(2), "x"), ("order_only", "a", T(1), None, None), ("matched", "b", T(0), T(1), "x"),
                          ("pay_only", "b", None, T(1), "y"), ("order_only", "c", T(0), None, None), ("pay_only", "c", None, T(9), "x"),
                          ("pay_only", "d", None, T(0), "z")], key=str)


# ---- keyed state, timers -------------------------------------------------------------------

def test_sustained_rise(spark):
    sch = "id string, ts timestamp_ntz, t double"
    run1 = spark.createDataFrame([("k", T(0), 60.0), ("k", T(0.5), 61.0), ("k", T(1.6), 62.0),
                                  ("k", T(2.0), 60.0), ("k", T(2.2), 61.0), ("k", T(2.5), 60.0)], sch)
    got = rows(alerts.sustained_rise(run1, "id", "ts", "t", ["ts"], "1 second"), "rise_ts", "alert_ts")
    assert got == [(T(0.5), T(1.5))]
    exact = spark.createDataFrame([("k", T(0), 60.0), ("k", T(0.5), 61.0), ("k", T(1.5), 59.0)], sch)
    assert alerts.sustained_rise(exact, "id", "ts", "t", ["ts"], "1 second").count() == 0
    lone = spark.createDataFrame([("k", T(0), 60.0), ("k", T(0.5), 61.0)], sch)
    assert alerts.sustained_rise(lone, "id", "ts", "t", ["ts"], "1 second").count() == 1
    # re-arm: rise at 0.5 fires at 1.5, the rise at 1.6 re-arms (2.6), no fall follows
    rearm = spark.createDataFrame([("k", T(0), 60.0), ("k", T(0.5), 61.0), ("k", T(1.6), 62.0)], sch)
    got = rows(alerts.sustained_rise(rearm, "id", "ts", "t", ["ts"], "1 second", rearm=True), "rise_ts", "alert_ts")
    assert got == [(T(0.5), T(1.5)), (T(1.6), T(2.6))]


def test_repeated_failures(spark):
    sch = "user_id string, ts timestamp_ntz, event_type string"
    base = spark.createDataFrame([("1", T(1), "fail"), ("1", T(3), "fail"), ("1", T(4), "fail")], sch)
    got = rows(alerts.repeated_failures(base), "user_id", "span_start", "span_end")
    assert got == [("1", T(1), T(6))]
    var = spark.createDataFrame([("1", T(1), "fail"), ("1", T(2), "success"), ("1", T(3), "fail"),
                                 ("1", T(4), "fail")], sch)
    assert alerts.repeated_failures(var).count() == 0
    got = rows(alerts.repeated_failures(var, rearm=True), "user_id", "span_start", "span_end", "n_fails")
    assert got == [("1", T(3), T(8), 2)]


def test_order_timeout_timer(spark):
    sch = "order_id string, op string, ts timestamp_ntz"
    ev = spark.createDataFrame([("1", "create", T(1558430842)), ("2", "create", T(1558430843)),
                                ("2", "pay", T(1558430844)), ("3", "pay", T(1558430942)),
                                ("4", "pay", T(1558430943))], sch)
    creates, pays = ev.filter("op = 'create'"), ev.filter("op = 'pay'")
    assert rows(match.order_timeout(creates, pays, "5 seconds")) == [("1", "create", T(1558430842))]
    edge = spark.createDataFrame([("9", "create", T(0)), ("9", "pay", T(5))], sch)
    assert match.order_timeout(edge.filter("op='create'"), edge.filter("op='pay'"), "5 seconds").count() == 0


def test_order_pay_pattern(spark):
    sch = "order_id string, op string, ts timestamp_ntz"
    ev = spark.createDataFrame([("1", "create", T(1558430842)), ("2", "create", T(1558430843)),
                                ("2", "pay", T(1558430844)), ("3", "pay", T(1558430942)),
                                ("4", "pay", T(1558430943))], sch)
    m, t = patterns.order_pay_pattern(ev, "5 seconds")
    assert rows(m, "order_id") == [("2",)]
    assert rows(t) == [("1", "create", T(1558430842))]
    edge = spark.createDataFrame([("9", "create", T(0)), ("9", "pay", T(5))], sch)
    m, t = patterns.order_pay_pattern(edge, "5 seconds")
    assert m.count() == 0 and t.count() == 1


def test_fail_sequence(spark):
    sch = "user_id string, ip string, event_type string, ts timestamp_ntz, event_id long"
    ev = spark.createDataFrame([("1", "192.168.0.1", "fail", T(1), 0), ("1", "192.168.0.2", "fail", T(2), 1),
                                ("1", "192.168.0.3", "fail", T(3), 2), ("2", "192.168.10.10", "fail", T(4), 3)], sch)
    got = patterns.fail_sequence(ev, "10 seconds").collect()
    assert len(got) == 1 and (got[0].begin_ip, got[0].next_ip, got[0].third_ip) == (
        "192.168.0.1", "192.168.0.2", "192.168.0.3")
    span = spark.createDataFrame([("1", "a", "fail", T(0), 0), ("1", "b", "fail", T(5), 1),
                                  ("1", "c", "fail", T(10), 2)], sch)
    assert patterns.fail_sequence(span, "10 seconds").count() == 0
    inside = spark.createDataFrame([("1", "a", "fail", T(0), 0), ("1", "b", "fail", T(5), 1),
                                    ("1", "c", "fail", T(9), 2)], sch)
    assert patterns.fail_sequence(inside, "10 seconds").count() == 1


def test_match_with_timeout(spark):
    o = spark.createDataFrame([("1", T(1558430842)), ("2", T(1558430843)), ("3", T(1558430849))],
                              "order_id string, ts timestamp_ntz")
    p = spark.createDataFrame([("1", "weixin", T(1558430847)), ("2", "zhifubao", T(1558430848)),
                               ("4", "zhifubao", T(1558430850))], "order_id string, channel string, ts timestamp_ntz")
    got = {(r.kind, r.order_id) for r in match.match_with_timeout(o, p, "5 seconds").collect()}
    assert got == {("matched", "1"), ("matched", "2"), ("order_only", "3"), ("pay_only", "4")}
    got = {(r.kind, r.order_id) for r in match.match_with_timeout(o, p, "1 second").collect()}
    assert got == {("order_only", "1"), ("order_only", "2"), ("order_only", "3"),
                   ("pay_only", "1"), ("pay_only", "2"), ("pay_only", "4")}


def test_forward_switch(spark):
    readings = spark.createDataFrame([("sensor_2", T(t), 1.0, i) for i, t in enumerate([0, 5, 9.99, 10, 15])]
                                     + [("sensor_1", T(6), 1.0, 9)],
                                     "id string, ts timestamp_ntz, temperature double, rid long")
    switches = spark.createDataFrame([("sensor_2", T(5), 10000)], "id string, ts timestamp_ntz, dur_ms long")
    got = rows(match.forward_switch(readings, switches, "id", "ts", duration_col="dur_ms", tiebreak="rid"), "rid")
    assert got == [(1,), (2,), (3,)]


def test_fan_out_and_key_by(spark):
    df = spark.createDataFrame([("s1", T(0), 70.0), ("s2", T(0), 10.0)], "id string, ts timestamp_ntz, temperature double")
    hot, ids = basic.fan_out(df, lambda d: basic.readings_above(d, 60.0), lambda d: d.select("id"))
    assert rows(hot, "id") == [("s1",)] and ids.count() == 2
    keyed = basic.key_by(df, "id", num_partitions=4)
    assert keyed.rdd.getNumPartitions() == 4 and keyed.count() == 2


def test_text_source_batch(spark, tmp_path):
    from streamlens.sources import read_lines
    p = tmp_path / "lines.txt"
    p.write_text("a,1\nb,2\nbad\n")
    ok, bad = parse.parse_key_seconds(read_lines(spark, str(p)))
    assert rows(ok, "key") == [("a",), ("b",)] and bad.count() == 1


def test_watermark_variants(spark):
    df = _arr(spark, [("a", 1), ("a", 6), ("a", 2)])
    asc = {r.arrival: r.wm for r in late.ascending_watermark(df, "ts", ["arrival"]).collect()}
    per = {r.arrival: r.wm for r in late.periodic_watermark(df, "ts", ["arrival"]).collect()}
    assert asc[0] is None and asc[1] == T(1) - timedelta(milliseconds=1) and asc[2] == T(6) - timedelta(milliseconds=1)
    assert per[0] is None and per[2] == T(5)


def test_views_and_parsers_carry_the_record_schemas(spark):
    from conftest import SF001
    from streamlens import schemas as S
    from streamlens.sources import testdata as td

    def norm(t):
        return "timestamp" if t.startswith("timestamp") else t

    def check(df, record):
        have = {f.name: norm(f.dataType.simpleString()) for f in df.schema.fields}
        for f in record.fields:
            assert have.get(f.name) == norm(f.dataType.simpleString()), (f.name, have)

    check(td.sensor(spark, SF001), S.SENSOR)
    check(td.behavior(spark, SF001).withColumn("item_id", F.col("item_id")), S.BEHAVIOR)
    check(td.login(spark, SF001), S.LOGIN)
    check(td.marketing(spark, SF001), S.MARKETING)
    check(td.order_creates(spark, SF001), S.ORDER)
    check(td.pays(spark, SF001), S.PAY)
    rows_, _ = parse.parse_access_log(td.access_lines(spark, SF001))
    check(rows_, S.ACCESS_LOG)
    counts = windows.count_per_key(td.arrivals(spark, SF001), "key", "ts", "1 hour")
    check(counts, S.KEYED_COUNT)


def test_top_n_beyond_the_group_limit(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("window_end"), F.col("id").cast("string").alias("k"), (F.col("id") % 97).alias("count"))
    got = rows(topn.top_n(df, "k", 1500), "window_end", "k", "rank")
    want = []
    for w in (0, 1):
        own = sorted(((-(i % 97), str(i)) for i in range(5000) if i % 2 == w))[:1500]
        want += [(w, k, r + 1) for r, (_, k) in enumerate(own)]
    assert got == sorted(want)

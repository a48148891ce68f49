"""Named jobs: each reads the test tables under ``sf_dir`` and runs one operator of
the event model over the whole input. Parameters are the reference's where the data
allows; window sizes are minutes/hours because events are minutes apart.

Every job returns a DataFrame with aliased columns whose names and types match the
reference SQL in :mod:`streamlens.plans.oracle`; doubles are rounded to 6 places
on both sides.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from streamlens.functions.scalar import poly_hash
from streamlens.operators import alerts, basic, late, match, patterns, rolling, topn, windows
from streamlens.session import checkpoint_dir
from streamlens.sources import parse, sinks, store
from streamlens.sources import testdata as td

Job = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered jobs (also used by the reference SQL).
P = {
    "hot_size": "60 minutes", "hot_slide": "5 minutes", "hot_n": 3,
    "url_size": "10 minutes", "url_slide": "5 seconds", "url_n": 5,
    "wc_size": "5 seconds",
    "sensor_size": "1 hour", "min_reduce_size": "3 hours", "count_size": "1 hour",
    "mkt_size": "1 hour", "mkt_slide": "10 minutes",
    "threshold": 60.0, "jump": 1.7,
    "late_size": "1 hour", "late_bound": "10 minutes", "lateness": "30 minutes",
    "tick": "10 minutes", "tick_uneven": "7 minutes",
    "switch_duration": "10 minutes",
    "match_wait": "30 days", "timeout_wait": "30 days",
    "rise_hold": "10 minutes",
    "fail_span": "1 day", "fail_min": 2,
    "pattern_within": "3 days",
}


def _r(c: str, places: int = 6):
    return F.round(F.col(c), places).alias(c)


def _ntz(c: str):
    return F.col(c).cast("timestamp_ntz").alias(c)


# ---- sources and parsing -------------------------------------------------------

def parse_behavior_csv(spark, d):
    rows, _ = parse.parse_behavior_csv(td.behavior_lines(spark, d))
    return rows.select("user_id", "item_id", "category_id", "behavior", _ntz("ts"))


def parse_access_log(spark, d):
    rows, _ = parse.parse_access_log(td.access_lines(spark, d))
    return rows.select("ip", "user_id", _ntz("ts"), "method", "url")


def _key_lines(spark, d):
    e = td.events(spark, d)
    return e.select(F.concat_ws(",", "event_type",
                                F.unix_seconds(F.col("ts").cast("timestamp")).cast("string")).alias("value"))


def parse_key_seconds(spark, d):
    rows, _ = parse.parse_key_seconds(_key_lines(spark, d))
    return rows.select("key", _ntz("ts"))


def _broken(lines):
    """The lines, and a cut copy of each: the first half of its characters."""
    half = lines.select(F.expr("substring(value, 1, length(value) div 2)").alias("value"))
    return lines.unionByName(half)


def behavior_rejects(spark, d):
    return parse.parse_behavior_csv(_broken(td.behavior_lines(spark, d).select("value")))[1].select("line")


def access_rejects(spark, d):
    return parse.parse_access_log(_broken(td.access_lines(spark, d).select("value")))[1].select("line")


def index_documents(spark, d):
    return sinks.index_documents(td.behavior_lines(spark, d))


def fan_out(spark, d):
    """One source, three outputs, told apart by name."""
    s = td.sensor(spark, d)
    hot, cold, ids = basic.fan_out(s, lambda x: x.where(F.col("temperature") > P["threshold"]).select("event_id"),
                                   lambda x: x.where(F.col("temperature") <= P["threshold"]).select("event_id"), lambda x: x.select("event_id"))
    named = [x.withColumn("output", F.lit(n)) for x, n in ((hot, "hot"), (cold, "cold"), (ids, "all"))]
    return basic.union_all(*named)


# ---- projection, routing ---------------------------------------------------------

def filter_map(spark, d):
    s = td.sensor(spark, d)
    return basic.readings_above(s, P["threshold"], cols=("event_id", "id", "ts", "temperature"))


def tokenise(spark, d):
    docs = td.table(spark, d, "documents")
    toks = basic.tokenise(docs, keep=("doc_id",))
    return toks.groupBy("doc_id", "word").agg(F.count(F.lit(1)).alias("n"))


def rich_map(spark, d):
    return basic.plus_one(td.events(spark, d), "user_id", "plus_one", keep=("event_id",))


def alarm_split(spark, d):
    _, alarms = basic.alarm_split(td.sensor(spark, d), P["threshold"], keep=("event_id",))
    return alarms


def union_all(spark, d):
    e = td.events(spark, d).select(F.lit("events").alias("source"), F.col("event_id").alias("id"))
    o = td.table(spark, d, "orders").select(F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"))
    li = td.table(spark, d, "lineitem").select(F.lit("lineitem").alias("source"), F.col("l_orderkey").alias("id"))
    return basic.union_all(e, o, li)


def co_map(spark, d):
    return basic.co_map(td.events(spark, d), td.table(spark, d, "orders"),
                        basic.suffix_map1("event_type"), basic.suffix_map2("o_orderstatus"),
                        key=("user_id", "o_custkey"))


# ---- window aggregates -----------------------------------------------------------

def word_count(spark, d):
    return windows.word_count(td.documents_timed(spark, d), P["wc_size"])


def avg_count(spark, d):
    r = windows.avg_count(td.sensor(spark, d), P["sensor_size"])
    return r.select("id", "window_end", _r("avg_temp"), "n")


def min_max(spark, d):
    return windows.min_max(td.sensor(spark, d), P["sensor_size"])


def min_reduce(spark, d):
    return windows.min_reduce(td.sensor(spark, d), P["min_reduce_size"])


def count_event_time(spark, d):
    rows, _ = parse.parse_key_seconds(_key_lines(spark, d))
    rows = rows.select("key", _ntz("ts"))
    return windows.count_per_key(rows, "key", "ts", P["count_size"], bound="5 seconds")


def item_views(spark, d):
    return windows.view_counts(td.behavior(spark, d), "item_id", size=P["hot_size"], slide=P["hot_slide"])


def _access(spark, d):
    rows, _ = parse.parse_access_log(td.access_lines(spark, d))
    return rows.select("url", _ntz("ts"))


def url_views(spark, d):
    return windows.view_counts(_access(spark, d), "url", size=P["url_size"], slide=P["url_slide"])


def pv(spark, d):
    return windows.pv_count(td.behavior(spark, d, only=("pv",)), P["hot_size"], P["hot_slide"])


def uv_exact(spark, d):
    return windows.uv_exact(td.behavior(spark, d, only=("pv",)), P["hot_size"], P["hot_slide"])


def uv_bitmap(spark, d):
    return windows.uv_bitmap(td.behavior(spark, d, only=("pv",)), P["hot_size"], P["hot_slide"])


def uv_approx(spark, d):
    return windows.uv_approx(td.behavior(spark, d, only=("pv",)), P["hot_size"], P["hot_slide"])


def marketing_total(spark, d):
    return windows.marketing_total(td.marketing(spark, d, exclude=("UNINSTALL",)), P["mkt_size"], P["mkt_slide"])


def marketing_by_channel(spark, d):
    return windows.marketing_by_channel(td.marketing(spark, d, exclude=("UNINSTALL",)), P["mkt_size"],
                                        P["mkt_slide"])


# ---- top-N ---------------------------------------------------------------------------

def hot_items_top3(spark, d):
    t = topn.top_n(item_views(spark, d), "item_id", P["hot_n"])
    return t.select("item_id", "window_end", "count", F.col("rank").cast("long").alias("rank"))


def url_top5(spark, d):
    t = topn.top_n(url_views(spark, d), "url", P["url_n"])
    return t.select("url", "window_end", "count", F.col("rank").cast("long").alias("rank"))


def hot_items_report(spark, d):
    t = topn.top_n(item_views(spark, d), "item_id", P["hot_n"])
    return topn.ranked_report(t, "item_id", style="item")


# ---- rolling, jumps -------------------------------------------------------------------

_ORDER = ("ts", "event_id")


def rolling_sum(spark, d):
    r = rolling.rolling_sum(td.sensor(spark, d), "id", "temperature", _ORDER)
    return r.select("event_id", "id", "ts", _r("sum"))


def rolling_list(spark, d):
    r = rolling.rolling_list(td.behavior(spark, d), "user_id", "behavior", _ORDER)
    return r.select("event_id", "user_id", F.array_join("items", ",").alias("items"))


def rolling_min(spark, d):
    r = rolling.rolling_min(td.sensor(spark, d), "id", "temperature", _ORDER)
    return r.select("event_id", "id", "ts", F.col("min").alias("min_temp"))


def jump_alert(spark, d):
    r = rolling.jump_alert(td.sensor(spark, d), "id", "temperature", _ORDER, P["jump"])
    return r.select("event_id", "id", "ts", "temperature", "last")


def jump_alert_with_initial(spark, d):
    r = rolling.jump_alert(td.sensor(spark, d), "id", "temperature", _ORDER, P["jump"], initial=0.0)
    return r.select("event_id", "id", "ts", "temperature", "last")


# ---- late data --------------------------------------------------------------------------

_ARRIVAL = ("arrival", "event_id")


def late_windows(spark, d):
    counts, _ = late.late_windows(td.arrivals(spark, d), "key", "ts", _ARRIVAL, P["late_size"],
                                  P["late_bound"])
    return counts


def late_windows_side(spark, d):
    _, late_rows = late.late_windows(td.arrivals(spark, d), "key", "ts", _ARRIVAL, P["late_size"],
                                     P["late_bound"])
    return late_rows.select("event_id", "key", "ts", "window_end")


def late_rows(spark, d):
    r = late.late_rows(td.arrivals(spark, d), "ts", _ARRIVAL, P["late_bound"])
    return r.select("event_id", "key", "ts", "wm", "is_late")


def allowed_lateness(spark, d):
    r = late.allowed_lateness(td.arrivals(spark, d), "key", "ts", _ARRIVAL, P["late_size"],
                              P["late_bound"], P["lateness"])
    return r.select("key", "window_end", F.col("firing").cast("long").alias("firing"), "count", "is_update")


def early_firings(spark, d):
    e = td.events(spark, d).select(F.col("event_type").alias("key"), "ts")
    return late.early_firings(e, "key", "ts", P["late_size"], P["tick"])


def early_firings_uneven(spark, d):
    e = td.events(spark, d).select(F.col("event_type").alias("key"), "ts")
    return late.early_firings(e, "key", "ts", P["late_size"], P["tick_uneven"])


def ascending_watermark(spark, d):
    r = late.ascending_watermark(td.arrivals(spark, d), "ts", _ARRIVAL)
    return r.select("event_id", "key", "ts", "wm")


def periodic_watermark(spark, d):
    r = late.periodic_watermark(td.arrivals(spark, d), "ts", _ARRIVAL)
    return r.select("event_id", "key", "ts", "wm")


def uv_per_row(spark, d):
    b = td.behavior(spark, d, only=("pv",)).filter(F.col("behavior") == "pv")
    b = b.select("event_id", "ts", poly_hash(F.col("user_id").cast("string")).alias("h"))
    r = late.per_row_updates(b, "h", "ts", ("ts", "event_id"), P["hot_size"], P["hot_slide"])
    return r.select("window_end", "event_id", "distinct_so_far")


# ---- two streams, timers, patterns ----------------------------------------------------

def _switches(spark, d):
    e = td.events(spark, d).filter(F.col("event_type") == "signup")
    return e.select(F.concat(F.lit("sensor_"), (F.col("user_id") % 10 + 1).cast("string")).alias("id"), "ts")


def forward_switch(spark, d):
    return match.forward_switch(td.sensor(spark, d), _switches(spark, d), "id", "ts",
                                P["switch_duration"], tiebreak="event_id")


def order_pay_match(spark, d):
    return match.match_with_timeout(td.order_creates(spark, d), td.pays(spark, d), P["match_wait"])


def order_pay_match_one(spark, d):
    li = td.table(spark, d, "lineitem")
    ships = li.select(F.col("l_orderkey").cast("string").alias("order_id"), F.col("l_linenumber").cast("string").alias("channel"), F.col("l_shipdate").alias("ts"))
    return match.match_one_to_one(td.order_creates(spark, d), ships, P["match_wait"])


def sustained_rise(spark, d):
    return alerts.sustained_rise(td.sensor(spark, d), "id", "ts", "temperature", _ORDER, P["rise_hold"])


def sustained_rise_rearm(spark, d):
    return alerts.sustained_rise(td.sensor(spark, d), "id", "ts", "temperature", _ORDER, P["rise_hold"],
                                 rearm=True)


def login_fail_timer(spark, d):
    return alerts.repeated_failures(td.login(spark, d), span=P["fail_span"], min_fails=P["fail_min"])


def login_fail_timer_rearm(spark, d):
    return alerts.repeated_failures(td.login(spark, d), span=P["fail_span"], min_fails=P["fail_min"],
                                    rearm=True)


def order_timeout_timer(spark, d):
    return match.order_timeout(td.order_creates(spark, d), td.pays(spark, d), P["timeout_wait"])


def login_fail_pattern(spark, d):
    return patterns.fail_sequence(td.login(spark, d), P["pattern_within"])


def order_pay_pattern(spark, d):
    m, _ = patterns.order_pay_pattern(td.order_events(spark, d), P["timeout_wait"])
    return m


def order_timeout_pattern(spark, d):
    _, t = patterns.order_pay_pattern(td.order_events(spark, d), P["timeout_wait"])
    return t


def first_purchase_path(spark, d):
    """#25 what each user did up to the first purchase: prefixes rebuilt from the segments of the rolling lists of all
    users, at the row numbers of the first purchases."""
    b = td.behavior(spark, d).select("user_id", "behavior", "ts", "event_id")
    segments = rolling.list_segments(b, "user_id", "behavior", ("ts", "event_id"), size=32)
    buys = segments.select("user_id", F.explode("rows").alias("r")).where("r.value = 'purchase'")
    wanted = buys.groupBy("user_id").agg(F.min("r.seq").alias("seq"))
    found = rolling.list_prefix(segments, wanted, "user_id", size=32)
    return found.select("user_id", "seq", F.array_join("items", ",").alias("path"))


def window_count_store(spark, d):
    """#7 page views per hour, kept in the counter store: the events come as 6 micro-batches (by id), each upserts the
    cumulative counts of the windows it changes, the fourth is replayed, hours that two batches wrote are merged, and
    the store is read back."""
    pv = td.behavior(spark, d, only=("pv",)).select("event_id", F.window("ts", P["count_size"]).getField("end").alias("window_end"))
    top = pv.agg(F.max("event_id").alias("m")).scalar()
    arrived = pv.withColumn("batch", F.floor(F.col("event_id") * 6 / (top + 1)).cast("int"))
    changed = arrived.groupBy("window_end", "batch").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("window_end").orderBy("batch")
    updates = changed.select("window_end", "batch", F.sum("n").over(w).alias("count")).persist()
    path = os.path.join(checkpoint_dir(spark), f"window-counts-{uuid.uuid4().hex}")
    counts = store.CountStore(spark, path, ("window_end",), most_runs=1)
    for k in (0, 1, 2, 3, 3, 4, 5):
        counts.upsert(updates.where(F.col("batch") == k).drop("batch"), k)
    updates.unpersist()
    return counts.read()


def key_by(spark, d):
    """#18 readings dealt by sensor: how many rows each has, and in how many partitions they lie."""
    dealt = basic.key_by(td.sensor(spark, d).select("id", "event_id"), "id").withColumn("part", F.spark_partition_id())
    return dealt.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("part").alias("partitions"))


def rich_map_lifecycle(spark, d):
    """#16 a map that opens a resource (here the number to add) once per task and closes it."""
    rows = td.events(spark, d).select("event_id", "user_id")
    return basic.map_with_lifecycle(rows, "event_id long, plus_one long",
                                    lambda pdf, r: pdf.assign(plus_one=pdf["user_id"] + r["add"])[["event_id", "plus_one"]],
                                    open_fn=lambda: {"add": 1}, close_fn=lambda r: r.clear())


JOBS: dict[str, Job] = {
    "hot_items_top3": hot_items_top3,
    "parse_behavior_csv": parse_behavior_csv,
    "parse_access_log": parse_access_log,
    "parse_key_seconds": parse_key_seconds,
    "filter_map": filter_map,
    "tokenise": tokenise,
    "rich_map": rich_map,
    "alarm_split": alarm_split,
    "union_all": union_all,
    "co_map": co_map,
    "word_count": word_count,
    "avg_count": avg_count,
    "min_max": min_max,
    "min_reduce": min_reduce,
    "count_event_time": count_event_time,
    "item_views": item_views,
    "item_views_pane": item_views,
    "url_views": url_views,
    "url_views_pane": url_views,
    "pv": pv,
    "uv_exact": uv_exact,
    "uv_bitmap": uv_bitmap,
    "uv_approx": uv_approx,
    "marketing_total": marketing_total,
    "marketing_by_channel": marketing_by_channel,
    "url_top5": url_top5,
    "hot_items_report": hot_items_report,
    "rolling_sum": rolling_sum,
    "rolling_list": rolling_list,
    "rolling_min": rolling_min,
    "jump_alert": jump_alert,
    "jump_alert_with_initial": jump_alert_with_initial,
    "late_windows": late_windows,
    "late_windows_side": late_windows_side,
    "late_rows": late_rows,
    "allowed_lateness": allowed_lateness,
    "early_firings": early_firings,
    "uv_per_row": uv_per_row,
    "forward_switch": forward_switch,
    "order_pay_match": order_pay_match,
    "sustained_rise": sustained_rise,
    "sustained_rise_rearm": sustained_rise_rearm,
    "login_fail_timer": login_fail_timer,
    "login_fail_timer_rearm": login_fail_timer_rearm,
    "order_timeout_timer": order_timeout_timer,
    "login_fail_pattern": login_fail_pattern,
    "order_pay_pattern": order_pay_pattern,
    "order_timeout_pattern": order_timeout_pattern,
    "early_firings_uneven": early_firings_uneven,
    "ascending_watermark": ascending_watermark,
    "periodic_watermark": periodic_watermark,
    "order_pay_match_one": order_pay_match_one,
    "behavior_rejects": behavior_rejects,
    "access_rejects": access_rejects,
    "index_documents": index_documents,
    "fan_out": fan_out,
    "first_purchase_path": first_purchase_path,
    "window_count_store": window_count_store,
    "key_by": key_by,
    "rich_map_lifecycle": rich_map_lifecycle,
}

"""Reference SQL (DuckDB dialect) for every job of :mod:`streamlens.plans.jobs`.

Written independently of the Spark plans: plain global windows, ``lead``/``lag``,
``EXISTS`` sub-queries and row expansion by ``range`` -- the textbook forms the
Spark jobs re-plan for scale. Tables ``events orders lineitem documents`` are
registered views over the same parquet files.
"""

from __future__ import annotations

from streamlens.operators.windows import seconds
from streamlens.plans.jobs import P

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _us(d: str) -> int:
    return int(seconds(d) * 1_000_000)


def _iv(d: str) -> str:
    return f"to_microseconds(CAST({_us(d)} AS BIGINT))"


def tend(ts: str, size: str) -> str:
    """End of the tumbling window holding ``ts``."""
    u = _us(size)
    return f"make_timestamp((epoch_us({ts}) // {u}) * {u} + {u})"


def wend(ts: str, size: str, slide: str, j: str = "j") -> str:
    """End of the ``j``-th sliding window holding ``ts`` (join with range(0, size/slide))."""
    s, l_ = _us(size), _us(slide)
    return f"make_timestamp((epoch_us({ts}) // {l_}) * {l_} + {s} - {j} * {l_})"


def nwin(size: str, slide: str) -> int:
    return int(round(seconds(size) / seconds(slide)))


BEHAVIOR = f"""(SELECT event_id, user_id, {K} AS item_id, CAST({K} % 10 AS INTEGER) AS category_id,
  CASE WHEN event_type = 'view' THEN 'pv' ELSE event_type END AS behavior, ts FROM events)"""
SENSOR = """(SELECT event_id, 'sensor_' || CAST(user_id % 10 + 1 AS VARCHAR) AS id, ts,
  value AS temperature FROM events)"""
LOGIN = """(SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
  '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS ip,
  CASE event_type WHEN 'error' THEN 'fail' WHEN 'signup' THEN 'success' ELSE event_type END AS event_type,
  ts FROM events)"""
MARKETING = """(SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
  CASE WHEN event_type = 'signup' THEN 'UNINSTALL' ELSE upper(event_type) END AS behavior,
  CASE WHEN user_id % 2 = 0 THEN 'AppStore' ELSE 'XiaomiStore' END AS channel, ts FROM events)"""
ACCESS = f"""(SELECT '/' || event_type || '/' || CAST({K} AS VARCHAR) AS url,
  date_trunc('second', ts) AS ts FROM events)"""
CREATES = "(SELECT CAST(o_orderkey AS VARCHAR) AS order_id, o_orderdate AS ts FROM orders)"
PAYS = """(SELECT CAST(l_orderkey AS VARCHAR) AS order_id,
  CASE WHEN l_orderkey % 2 = 0 THEN 'weixin' ELSE 'zhifubao' END AS channel,
  min(l_shipdate) AS ts FROM lineitem GROUP BY l_orderkey)"""
ARRIVALS = """(SELECT event_id, event_type AS key, ts,
  ts + to_seconds(CAST((event_id * 7919) % 7200 AS BIGINT)) AS arrival FROM events)"""
DOCS = "(SELECT doc_id, text, TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS ts FROM documents)"
WM = f"""(max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  - {_iv(P['late_bound'])})"""
HASH16 = ("list_reduce(list_transform(string_split(CAST(user_id AS VARCHAR), ''), lambda c: ascii(c)), "
          "lambda a, c: (a * 61 + c) % 65536, CAST(0 AS BIGINT))")
ONE_MS = "INTERVAL 1 MILLISECOND"


def _sliding_counts(src: str, key: str, size: str, slide: str, where: str = "TRUE",
                    out: str = "count") -> str:
    return f"""SELECT {key + ', ' if key else ''}{wend('ts', size, slide)} AS window_end, count(*) AS {out}
FROM {src} s CROSS JOIN range(0, {nwin(size, slide)}) r(j) WHERE {where}
GROUP BY ALL"""


def _top(counts: str, key: str, n: int) -> str:
    return f"""SELECT {key}, window_end, count, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY window_end ORDER BY count DESC, {key} ASC) AS rank
  FROM ({counts})) WHERE rank <= {n}"""


def build() -> dict[str, str]:
    hs, hl = P["hot_size"], P["hot_slide"]
    item_views = _sliding_counts(BEHAVIOR, "item_id", hs, hl)
    url_views = _sliding_counts(ACCESS, "url", P["url_size"], P["url_slide"])
    sensor_tumble = lambda size, aggs: f"""SELECT id, {tend('ts', size)} AS window_end, {aggs}
FROM {SENSOR} GROUP BY ALL"""
    late_base = f"""(SELECT *, {WM} AS wm, {tend('ts', P['late_size'])} AS window_end FROM {ARRIVALS})"""
    lat = _iv(P["lateness"])
    q: dict[str, str] = {}
    q["hot_items_top3"] = _top(item_views, "item_id", P["hot_n"])
    q["parse_behavior_csv"] = f"""SELECT user_id, item_id, category_id, behavior, date_trunc('second', ts) AS ts
FROM {BEHAVIOR}"""
    q["parse_access_log"] = f"""SELECT '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR) AS ip,
  CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS ts,
  CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END AS method,
  '/' || event_type || '/' || CAST({K} AS VARCHAR) AS url FROM events"""
    q["parse_key_seconds"] = "SELECT event_type AS key, date_trunc('second', ts) AS ts FROM events"
    q["filter_map"] = f"SELECT event_id, id, ts, temperature FROM {SENSOR} WHERE temperature > {P['threshold']}"
    q["tokenise"] = """SELECT doc_id, word, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_split_to_array(text, '\\W+')) AS word FROM documents) WHERE word <> ''
GROUP BY ALL"""
    q["rich_map"] = "SELECT event_id, user_id + 1 AS plus_one FROM events"
    q["alarm_split"] = f"""SELECT event_id, 'templuter less than 60 alarm :' || id AS alarm FROM {SENSOR}
WHERE temperature < {P['threshold']}"""
    q["union_all"] = """SELECT 'events' AS source, event_id AS id FROM events
UNION ALL SELECT 'orders', o_orderkey FROM orders
UNION ALL SELECT 'lineitem', l_orderkey FROM lineitem"""
    q["co_map"] = """SELECT CAST(user_id AS VARCHAR) AS key, event_type || '：from map1' AS value FROM events
UNION ALL SELECT CAST(o_custkey AS VARCHAR), o_orderstatus || '：from map2' FROM orders"""
    q["word_count"] = f"""SELECT word, {tend('ts', P['wc_size'])} AS window_end, count(*) AS count FROM (
  SELECT unnest(regexp_split_to_array(text, '\\W+')) AS word, ts FROM {DOCS}) WHERE word <> '' GROUP BY ALL"""
    q["avg_count"] = sensor_tumble(P["sensor_size"], "round(avg(temperature), 6) AS avg_temp, count(*) AS n")
    q["min_max"] = sensor_tumble(P["sensor_size"], "min(temperature) AS min_temp, max(temperature) AS max_temp")
    q["min_reduce"] = sensor_tumble(P["min_reduce_size"], "min(temperature) AS min_temp")
    q["count_event_time"] = f"""SELECT event_type AS key, {tend("date_trunc('second', ts)", P['count_size'])} AS window_end,
  count(*) AS count FROM events GROUP BY ALL"""
    q["item_views"] = item_views
    q["item_views_pane"] = item_views
    q["url_views"] = url_views
    q["url_views_pane"] = url_views
    q["pv"] = _sliding_counts(BEHAVIOR, "", hs, hl, "behavior = 'pv'", out="pv")
    q["uv_exact"] = f"""SELECT {wend('ts', hs, hl)} AS window_end, count(DISTINCT user_id) AS uv
FROM {BEHAVIOR} s CROSS JOIN range(0, {nwin(hs, hl)}) r(j) WHERE behavior = 'pv' GROUP BY ALL"""
    q["uv_bitmap"] = f"""SELECT {wend('ts', hs, hl)} AS window_end, count(DISTINCT {HASH16}) AS uv
FROM {BEHAVIOR} s CROSS JOIN range(0, {nwin(hs, hl)}) r(j) WHERE behavior = 'pv' GROUP BY ALL"""
    q["uv_approx"] = q["uv_exact"]
    q["marketing_total"] = _sliding_counts(MARKETING, "", P["mkt_size"], P["mkt_slide"],
                                           "behavior <> 'UNINSTALL'")
    q["marketing_by_channel"] = _sliding_counts(MARKETING, "channel, behavior", P["mkt_size"],
                                                P["mkt_slide"], "behavior <> 'UNINSTALL'")
    q["url_top5"] = _top(url_views, "url", P["url_n"])
    q["hot_items_report"] = f"""SELECT window_end,
  '=============================时间： ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || '.0' || chr(10)
  || string_agg('No' || CAST(rank AS VARCHAR) || ':商品ID = ' || CAST(item_id AS VARCHAR) || '浏览量='
                || CAST(count AS VARCHAR) || chr(10), '' ORDER BY rank)
  || '==============================' AS report
FROM ({q['hot_items_top3']}) GROUP BY window_end"""
    w_id = "PARTITION BY id ORDER BY ts, event_id"
    q["rolling_sum"] = f"""SELECT event_id, id, ts,
  round(sum(temperature) OVER ({w_id} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 6) AS sum FROM {SENSOR}"""
    q["rolling_list"] = f"""SELECT event_id, user_id, array_to_string(list(behavior) OVER (
  PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), ',') AS items
FROM {BEHAVIOR}"""
    q["rolling_min"] = f"""SELECT event_id, id, ts,
  min(temperature) OVER ({w_id} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS min_temp FROM {SENSOR}"""
    q["jump_alert"] = f"""SELECT event_id, id, ts, temperature, last FROM (
  SELECT *, lag(temperature) OVER ({w_id}) AS last FROM {SENSOR})
WHERE abs(temperature - last) > {P['jump']}"""
    q["jump_alert_with_initial"] = f"""SELECT event_id, id, ts, temperature, last FROM (
  SELECT *, lag(temperature, 1, 0.0) OVER ({w_id}) AS last FROM {SENSOR})
WHERE abs(temperature - last) > {P['jump']}"""
    late_flag = f"coalesce(window_end - {ONE_MS} <= wm, false)"
    q["late_windows"] = f"""SELECT key, window_end, count(*) AS count FROM {late_base} WHERE NOT {late_flag}
GROUP BY ALL"""
    q["late_windows_side"] = f"SELECT event_id, key, ts, window_end FROM {late_base} WHERE {late_flag}"
    q["late_rows"] = f"SELECT event_id, key, ts, wm, coalesce(ts < wm, false) AS is_late FROM {late_base}"
    q["allowed_lateness"] = f"""WITH s AS (
  SELECT *, CASE WHEN wm IS NULL OR wm < window_end - {ONE_MS} THEN 0
                 WHEN wm < window_end - {ONE_MS} + {lat} THEN 1 ELSE 2 END AS st FROM {late_base}),
ot AS (SELECT key, window_end, count(*) AS n0 FROM s WHERE st = 0 GROUP BY ALL),
lt AS (SELECT key, window_end,
         row_number() OVER (PARTITION BY key, window_end ORDER BY arrival, event_id) AS r FROM s WHERE st = 1)
SELECT key, window_end, CAST(0 AS BIGINT) AS firing, n0 AS count, false AS is_update FROM ot
UNION ALL
SELECT lt.key, lt.window_end, CAST(CASE WHEN ot.n0 IS NULL THEN r - 1 ELSE r END AS BIGINT) AS firing,
  CAST(coalesce(ot.n0, 0) + r AS BIGINT) AS count, (ot.n0 IS NOT NULL OR r > 1) AS is_update
FROM lt LEFT JOIN ot ON lt.key = ot.key AND lt.window_end = ot.window_end"""
    for name, tick in (("early_firings", P["tick"]), ("early_firings_uneven", P["tick_uneven"])):
        q[name] = f"""WITH d AS (SELECT event_type AS key, {tend('ts', P['late_size'])} AS window_end,
    least({tend('ts', tick)}, {tend('ts', P['late_size'])}) AS pane FROM events),
f AS (SELECT key, window_end, min(pane) AS first FROM d GROUP BY ALL),
t AS (SELECT DISTINCT key, window_end, unnest(list_append(generate_series(first, window_end, {_iv(tick)}), window_end)) AS fire_time FROM f)
SELECT t.key, t.window_end, t.fire_time, t.fire_time = t.window_end AS is_final,
  (SELECT count(*) FROM d WHERE d.key = t.key AND d.window_end = t.window_end AND d.pane <= t.fire_time) AS count
FROM t"""
    for name, bound in (("ascending_watermark", "1 millisecond"), ("periodic_watermark", "1 second")):
        q[name] = f"""SELECT event_id, key, ts, max(ts) OVER (ORDER BY arrival, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - {_iv(bound)} AS wm FROM {ARRIVALS}"""
    q["uv_per_row"] = f"""WITH x AS (
  SELECT event_id, ts, {HASH16} AS h, {wend('ts', hs, hl)} AS window_end
  FROM {BEHAVIOR} s CROSS JOIN range(0, {nwin(hs, hl)}) r(j) WHERE behavior = 'pv'),
y AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY window_end, h ORDER BY ts, event_id) = 1
                     THEN 1 ELSE 0 END AS nw FROM x)
SELECT window_end, event_id, CAST(sum(nw) OVER (PARTITION BY window_end ORDER BY ts, event_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS distinct_so_far FROM y"""
    q["forward_switch"] = f"""WITH sw AS (SELECT 'sensor_' || CAST(user_id % 10 + 1 AS VARCHAR) AS id, ts
  FROM events WHERE event_type = 'signup')
SELECT event_id, id, ts, temperature FROM {SENSOR} r
WHERE EXISTS (SELECT 1 FROM sw WHERE sw.id = r.id AND sw.ts <= r.ts
              AND r.ts < sw.ts + {_iv(P['switch_duration'])})"""
    mw = _us(P["match_wait"])
    near = f"abs(epoch_us(p.ts) - epoch_us(o.ts)) <= {mw}"
    q["order_pay_match"] = f"""WITH o AS {CREATES}, p AS {PAYS}
SELECT o.order_id, o.ts AS order_ts, p.ts AS pay_ts, p.channel, 'matched' AS kind
FROM o JOIN p ON o.order_id = p.order_id AND {near}
UNION ALL
SELECT o.order_id, o.ts, CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR), 'order_only' FROM o
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.order_id = o.order_id AND {near})
UNION ALL
SELECT p.order_id, CAST(NULL AS TIMESTAMP), p.ts, p.channel, 'pay_only' FROM p
WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.order_id = p.order_id AND {near})"""
    hold = _iv(P["rise_hold"])
    q["sustained_rise"] = f"""WITH a AS (SELECT *, lag(temperature) OVER ({w_id}) AS prev FROM {SENSOR}),
b AS (SELECT *, coalesce(temperature > prev, false) AS rise,
             CAST(coalesce(temperature < prev, false) AS BIGINT) AS fall FROM a),
c AS (SELECT *, sum(fall) OVER ({w_id} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM b),
r AS (SELECT id, run, min(CASE WHEN rise THEN ts END) AS first_rise, min(ts) AS start FROM c GROUP BY id, run),
j AS (SELECT r.*, n.start AS next_fall FROM r LEFT JOIN r n ON n.id = r.id AND n.run = r.run + 1)
SELECT id, first_rise AS rise_ts, first_rise + {hold} AS alert_ts FROM j
WHERE first_rise IS NOT NULL AND (next_fall IS NULL OR next_fall > first_rise + {hold})"""
    sp = _iv(P["fail_span"])
    q["login_fail_timer"] = f"""WITH l AS (SELECT * FROM {LOGIN} WHERE event_type IN ('fail', 'success')),
t AS (SELECT user_id, min(ts) AS span_start FROM l WHERE event_type = 'fail' GROUP BY user_id),
a AS (SELECT t.user_id, t.span_start,
        CAST(sum(CASE WHEN l.event_type = 'fail' THEN 1 ELSE 0 END) AS BIGINT) AS n_fails,
        sum(CASE WHEN l.event_type = 'success' THEN 1 ELSE 0 END) AS n_ok
      FROM t JOIN l ON l.user_id = t.user_id AND l.ts >= t.span_start AND l.ts <= t.span_start + {sp}
      GROUP BY t.user_id, t.span_start)
SELECT user_id, span_start, span_start + {sp} AS span_end, n_fails FROM a
WHERE n_fails >= {P['fail_min']} AND n_ok = 0"""
    tw = _us(P["timeout_wait"])
    q["order_timeout_timer"] = f"""WITH c AS (SELECT order_id, min(ts) AS ts FROM {CREATES} GROUP BY order_id),
p AS {PAYS}
SELECT order_id, 'create' AS op, ts FROM c
WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.order_id = c.order_id AND abs(epoch_us(p.ts) - epoch_us(c.ts)) <= {tw})"""
    pw = _us(P["pattern_within"])
    q["login_fail_pattern"] = f"""WITH x AS (
  SELECT user_id, ip, ts, event_type = 'fail' AS s0,
    lead(ip, 1) OVER w AS ip1, lead(ts, 1) OVER w AS ts1, lead(event_type, 1) OVER w = 'fail' AS s1,
    lead(ip, 2) OVER w AS ip2, lead(ts, 2) OVER w AS ts2, lead(event_type, 2) OVER w = 'fail' AS s2
  FROM {LOGIN} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, ip AS begin_ip, ts AS begin_ts, ip1 AS next_ip, ts1 AS next_ts, ip2 AS third_ip, ts2 AS third_ts
FROM x WHERE s0 AND s1 AND s2 AND epoch_us(ts1) - epoch_us(ts) < {pw} AND epoch_us(ts2) - epoch_us(ts) < {pw}"""
    ord_x = f"""WITH e AS (SELECT order_id, 'create' AS op, ts FROM {CREATES}
                UNION ALL SELECT order_id, 'pay' AS op, ts FROM {PAYS}),
x AS (SELECT order_id, op, ts, lead(op) OVER w AS op1, lead(ts) OVER w AS ts1
      FROM e WINDOW w AS (PARTITION BY order_id ORDER BY ts, op))"""
    q["order_pay_pattern"] = f"""{ord_x}
SELECT order_id, op AS create_op, ts AS create_ts, op1 AS pay_op, ts1 AS pay_ts FROM x
WHERE op = 'create' AND op1 = 'pay' AND epoch_us(ts1) - epoch_us(ts) < {tw}"""
    q["order_timeout_pattern"] = f"""{ord_x}
SELECT order_id, op, ts FROM x
WHERE op = 'create' AND (ts1 IS NULL OR epoch_us(ts1) - epoch_us(ts) >= {tw})"""
    q["order_pay_match_one"] = f"""WITH RECURSIVE u AS (
  SELECT order_id, ts, 0 AS side, CAST(NULL AS VARCHAR) AS channel FROM {CREATES}
  UNION ALL SELECT CAST(l_orderkey AS VARCHAR), l_shipdate, 1, CAST(l_linenumber AS VARCHAR) FROM lineitem),
e AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY ts, side, channel) AS rn FROM u),
st AS (
  SELECT order_id, CAST(0 AS BIGINT) AS rn, CAST([] AS STRUCT(t TIMESTAMP, c VARCHAR)[]) AS os, CAST([] AS STRUCT(t TIMESTAMP, c VARCHAR)[]) AS ps,
    CAST([] AS STRUCT(o TIMESTAMP, p TIMESTAMP, c VARCHAR, k VARCHAR)[]) AS outs FROM (SELECT DISTINCT order_id FROM u)
  UNION ALL
  SELECT order_id, rn,
    CASE WHEN side = 1 THEN fo[2:] WHEN len(fp) > 0 THEN fo ELSE list_append(fo, {{'t': ts, 'c': CAST(NULL AS VARCHAR)}}) END,
    CASE WHEN side = 0 THEN fp[2:] WHEN len(fo) > 0 THEN fp ELSE list_append(fp, {{'t': ts, 'c': channel}}) END,
    list_concat(list_concat(
      list_transform(list_filter(os, lambda x: x.t < ts - {_iv(P['match_wait'])}), lambda x: {{'o': x.t, 'p': CAST(NULL AS TIMESTAMP), 'c': CAST(NULL AS VARCHAR), 'k': 'order_only'}}),
      list_transform(list_filter(ps, lambda x: x.t < ts - {_iv(P['match_wait'])}), lambda x: {{'o': CAST(NULL AS TIMESTAMP), 'p': x.t, 'c': x.c, 'k': 'pay_only'}})),
      CASE WHEN side = 0 AND len(fp) > 0 THEN [{{'o': ts, 'p': fp[1].t, 'c': fp[1].c, 'k': 'matched'}}]
           WHEN side = 1 AND len(fo) > 0 THEN [{{'o': fo[1].t, 'p': ts, 'c': channel, 'k': 'matched'}}]
           ELSE CAST([] AS STRUCT(o TIMESTAMP, p TIMESTAMP, c VARCHAR, k VARCHAR)[]) END)
  FROM (SELECT e.*, st.os, st.ps, list_filter(st.os, lambda x: x.t >= e.ts - {_iv(P['match_wait'])}) AS fo,
          list_filter(st.ps, lambda x: x.t >= e.ts - {_iv(P['match_wait'])}) AS fp
        FROM st JOIN e ON e.order_id = st.order_id AND e.rn = st.rn + 1)),
fin AS (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY rn DESC) = 1),
a AS (SELECT order_id, unnest(outs) AS r FROM st
  UNION ALL SELECT order_id, unnest(list_transform(os, lambda x: {{'o': x.t, 'p': CAST(NULL AS TIMESTAMP), 'c': CAST(NULL AS VARCHAR), 'k': 'order_only'}})) FROM fin
  UNION ALL SELECT order_id, unnest(list_transform(ps, lambda x: {{'o': CAST(NULL AS TIMESTAMP), 'p': x.t, 'c': x.c, 'k': 'pay_only'}})) FROM fin)
SELECT order_id, r.o AS order_ts, r.p AS pay_ts, r.c AS channel, r.k AS kind FROM a"""
    q["login_fail_timer_rearm"] = f"""WITH RECURSIVE ev AS (SELECT user_id, ts, event_type,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type = 'success') AS rn
  FROM {LOGIN} WHERE event_type IN ('fail', 'success')),
st AS (
  SELECT user_id, rn, CASE WHEN event_type = 'fail' THEN ts END AS t0, CASE WHEN event_type = 'fail' THEN 1 ELSE 0 END AS n,
    CAST(NULL AS TIMESTAMP) AS c0, 0 AS cn FROM ev WHERE rn = 1
  UNION ALL
  SELECT user_id, rn, CASE WHEN event_type = 'fail' THEN coalesce(k0, ts) END, CASE WHEN event_type = 'fail' THEN kn + 1 ELSE 0 END,
    CASE WHEN over_ THEN t0 END, CASE WHEN over_ THEN n ELSE 0 END
  FROM (SELECT e.*, st.t0, st.n, coalesce(e.ts > st.t0 + {sp}, false) AS over_,
          CASE WHEN e.ts > st.t0 + {sp} THEN NULL ELSE st.t0 END AS k0, CASE WHEN e.ts > st.t0 + {sp} THEN 0 ELSE st.n END AS kn
        FROM st JOIN ev e ON e.user_id = st.user_id AND e.rn = st.rn + 1)),
a AS (SELECT user_id, c0 AS s, cn AS n FROM st WHERE c0 IS NOT NULL
  UNION ALL SELECT user_id, t0, n FROM (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) = 1) WHERE t0 IS NOT NULL)
SELECT user_id, s AS span_start, s + {sp} AS span_end, CAST(n AS BIGINT) AS n_fails FROM a WHERE n >= {P['fail_min']}"""
    q["sustained_rise_rearm"] = f"""WITH RECURSIVE a AS (SELECT *, lag(temperature) OVER ({w_id}) AS prev FROM {SENSOR}),
b AS (SELECT *, coalesce(temperature > prev, false) AS rise, CAST(coalesce(temperature < prev, false) AS BIGINT) AS fall FROM a),
c AS (SELECT *, sum(fall) OVER ({w_id} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM b),
r AS (SELECT id, run, min(ts) AS start FROM c GROUP BY id, run),
f AS (SELECT r.id, r.run, n.start AS next_fall FROM r LEFT JOIN r n ON n.id = r.id AND n.run = r.run + 1),
e AS (SELECT id, run, ts, row_number() OVER (PARTITION BY id, run ORDER BY ts, event_id) AS rn FROM c WHERE rise),
st AS (
  SELECT id, run, rn, ts + {hold} AS deadline, CAST(NULL AS TIMESTAMP) AS fired FROM e WHERE rn = 1
  UNION ALL
  SELECT e.id, e.run, e.rn, CASE WHEN e.ts > st.deadline THEN e.ts + {hold} ELSE st.deadline END,
    CASE WHEN e.ts > st.deadline THEN st.deadline END
  FROM st JOIN e ON e.id = st.id AND e.run = st.run AND e.rn = st.rn + 1),
z AS (SELECT * FROM st QUALIFY row_number() OVER (PARTITION BY id, run ORDER BY rn DESC) = 1),
o AS (SELECT id, fired FROM st WHERE fired IS NOT NULL
  UNION ALL SELECT z.id, z.deadline FROM z JOIN f ON f.id = z.id AND f.run = z.run WHERE f.next_fall IS NULL OR f.next_fall > z.deadline)
SELECT id, fired - {hold} AS rise_ts, fired AS alert_ts FROM o"""
    csv = f"""(SELECT concat_ws(',', user_id, item_id, category_id, behavior, CAST(floor(epoch(ts)) AS BIGINT)) AS value FROM {BEHAVIOR})"""
    log = f"""(SELECT concat_ws(' ', '10.0.' || CAST(user_id % 256 AS VARCHAR) || '.' || CAST(event_id % 256 AS VARCHAR), '-',
  CAST(user_id AS VARCHAR), strftime(ts, '%d/%m/%Y:%H:%M:%S'), '+0000', CASE WHEN event_type = 'purchase' THEN 'POST' ELSE 'GET' END,
  '/' || event_type || '/' || CAST({K} AS VARCHAR)) AS value FROM events)"""
    q["behavior_rejects"] = f"SELECT substr(value, 1, length(value) // 2) AS line FROM {csv}"
    q["access_rejects"] = f"SELECT substr(value, 1, length(value) // 2) AS line FROM {log}"
    q["index_documents"] = f"""SELECT sha256(value) AS _id, '{{"myUserbe":"' || value || '"}}' AS doc FROM {csv}"""
    q["fan_out"] = f"""SELECT event_id, CASE WHEN temperature > {P['threshold']} THEN 'hot' ELSE 'cold' END AS output FROM {SENSOR} WHERE temperature IS NOT NULL
UNION ALL SELECT event_id, 'all' FROM {SENSOR}"""
    q["first_purchase_path"] = f"""WITH b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq FROM {BEHAVIOR}),
f AS (SELECT user_id, min(seq) AS seq FROM b WHERE behavior = 'purchase' GROUP BY user_id)
SELECT f.user_id, f.seq, string_agg(behavior, ',' ORDER BY b.seq) AS path FROM f JOIN b ON b.user_id = f.user_id AND b.seq <= f.seq GROUP BY f.user_id, f.seq"""
    q["window_count_store"] = f"SELECT {tend('ts', P['count_size'])} AS window_end, count(*) AS count FROM {BEHAVIOR} WHERE behavior = 'pv' GROUP BY ALL"
    q["key_by"] = f"SELECT id, count(*) AS n, CAST(1 AS BIGINT) AS partitions FROM {SENSOR} GROUP BY id"
    q["rich_map_lifecycle"] = "SELECT event_id, user_id + 1 AS plus_one FROM events"
    return q


ORACLE = build()

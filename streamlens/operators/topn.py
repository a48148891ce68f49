"""Top-N per window and the ranked text report (#41-#44).

``row_number() <= N`` over ``partitionBy(window_end)`` is planned by Spark as a
*partial* WindowGroupLimit before the shuffle and a final one after it, so each
map task forwards at most N rows per window: a window with millions of keys never
lands whole in one task. Ties are broken by key ascending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlens.functions.scalar import timestamp_text

# Report layout of the hot-items job.
ITEM_REPORT_HEAD = "=============================时间： "
ITEM_REPORT_LINE = "No{rank}:商品ID = {key}浏览量={count}\n"
ITEM_REPORT_FOOT = "=============================="
# Report layout of the hot-URL job.
URL_REPORT_HEAD = "================================时间："
URL_REPORT_LINE = "No{rank}:URL = {key}\n流量 = {count}\n"
URL_REPORT_FOOT = "================================================\n\n"


def top_n(counts: DataFrame, key: str, n: int = 3, by: str = "window_end",
          count: str = "count", rank: str = "rank") -> DataFrame:
    """Rows ranked 1..n per ``by`` by ``count`` desc, then ``key`` asc.

    Up to 1,000 ranks Spark cuts each map task's rows to n per window before the shuffle; for more, a first
    rank per (window, hash of the key) does, so that one task gets at most 256 n rows of a window."""
    order = F.col(count).desc(), F.col(key).asc()
    if n > 1000:
        part = Window.partitionBy(by, F.pmod(F.xxhash64(key), F.lit(256))).orderBy(*order)
        counts = counts.withColumn("_part", F.row_number().over(part)).filter(F.col("_part") <= n).drop("_part")
    w = Window.partitionBy(by).orderBy(*order)
    return counts.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


_STYLES = {"item": (ITEM_REPORT_HEAD, ITEM_REPORT_LINE, ITEM_REPORT_FOOT),
           "url": (URL_REPORT_HEAD, URL_REPORT_LINE, URL_REPORT_FOOT)}


def report_line(rank: Column, key: Column, count: Column, style: str) -> Column:
    fmt = _STYLES[style][1].replace("{rank}", "%d").replace("{key}", "%s").replace("{count}", "%d")
    return F.format_string(fmt, rank, key.cast("string"), count)


def report_text(end: Column, lines: Column, style: str) -> Column:
    """The text of a window from its lines (an array, in order)."""
    head, _, foot = _STYLES[style]
    return F.concat(F.lit(head), timestamp_text(end), F.lit("\n"), F.array_join(lines, ""), F.lit(foot))


def ranked_report(top: DataFrame, key: str, by: str = "window_end", count: str = "count",
                  rank: str = "rank", style: str = "item", out: str = "report") -> DataFrame:
    """#44 one text per window: header with the window end, one line per rank.

    Input is already cut to N rows per window, so the per-window collect is bounded
    by N."""
    lines = top.select(by, rank, report_line(F.col(rank), F.col(key), F.col(count), style).alias("_line"))
    grouped = lines.groupBy(by).agg(F.array_sort(F.collect_list(F.struct(rank, "_line"))).alias("_ls"))
    return grouped.select(by, report_text(F.col(by), F.transform("_ls", lambda s: s.getField("_line")), style).alias(out))

"""Line parsers (#9-#11).

Each parser returns ``(rows, rejects)``: well-formed lines become typed rows, lines
with a missing field or text in a number field go to ``rejects`` (the original
line kept) instead of failing the job. Parsing is JVM-side (``from_csv``,
``split``, ``try_to_timestamp``), one pass, no shuffle.

The parsed struct is produced by a one-element ``inline(array(...))`` generator:
predicate pushdown does not cross a Generate, so the validity filter reads the
parsed fields instead of re-inlining the parser once per null check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.schemas import BEHAVIOR_CSV_DDL, KEY_SECONDS_DDL

# Access-log layout (space separated; ip, user and time at 0, 2, 3,
# method and url at 5 and 6) and its time pattern.
ACCESS_LOG_FIELDS = {"ip": 0, "user_id": 2, "time": 3, "method": 5, "url": 6}
ACCESS_LOG_TIME = "dd/MM/yyyy:HH:mm:ss"


def _parsed(lines: DataFrame, col: str, fields: Column) -> DataFrame:
    """``_line`` plus the fields of the struct ``fields`` (evaluated once per line)."""
    return lines.select(F.inline(F.array(F.struct(F.col(col).alias("_line"), fields.alias("_r")))))


def _split_valid(parsed: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    ok = F.lit(True)
    for f in fields:
        ok = ok & F.col(f).isNotNull()
    rows = parsed.filter(ok).select(*fields)
    rejects = parsed.filter(~ok).select(F.col("_line").alias("line"))
    return rows, rejects


def parse_behavior_csv(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``userId,itemId,categoryId,behavior,epochSeconds`` -> behavior rows."""
    p = _parsed(lines, col, F.from_csv(F.col(col), BEHAVIOR_CSV_DDL, {"mode": "PERMISSIVE"}))
    # a sixth field or a short line is malformed too
    n = F.size(F.split(F.col("_line"), ","))
    p = p.select("_line",
                 F.when(n == 5, F.col("_r.user_id")).alias("user_id"),
                 F.col("_r.item_id").alias("item_id"),
                 F.col("_r.category_id").alias("category_id"),
                 F.col("_r.behavior").alias("behavior"),
                 F.timestamp_seconds(F.col("_r.ts_s")).alias("ts"))
    return _split_valid(p, ["user_id", "item_id", "category_id", "behavior", "ts"])


def parse_access_log(lines: DataFrame, col: str = "value",
                     time_format: str = ACCESS_LOG_TIME) -> tuple[DataFrame, DataFrame]:
    """Space-separated access-log line -> (ip, user_id, ts, method, url)."""
    p = _parsed(lines, col, F.split(F.col(col), " "))
    f = ACCESS_LOG_FIELDS
    p = p.select(
        "_line",
        F.get(F.col("_r"), f["ip"]).alias("ip"),
        F.get(F.col("_r"), f["user_id"]).alias("user_id"),
        F.try_to_timestamp(F.get(F.col("_r"), f["time"]), F.lit(time_format)).alias("ts"),
        F.get(F.col("_r"), f["method"]).alias("method"),
        F.get(F.col("_r"), f["url"]).alias("url"),
    )
    return _split_valid(p, ["ip", "user_id", "ts", "method", "url"])


def parse_key_seconds(lines: DataFrame, col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``key,seconds`` -> (key, ts)."""
    p = _parsed(lines, col, F.from_csv(F.col(col), KEY_SECONDS_DDL, {"mode": "PERMISSIVE"}))
    n = F.size(F.split(F.col("_line"), ","))
    p = p.select("_line",
                 F.when(n == 2, F.col("_r.key")).alias("key"),
                 F.timestamp_seconds(F.col("_r.ts_s")).alias("ts"))
    return _split_valid(p, ["key", "ts"])

"""Stream-stream joins with watermarks (#23, #57).

Spark keeps both sides in state and evicts them once the watermarks pass the time
bound of the join condition; outer rows are emitted at eviction. The equality key
plus the time range let the state be dropped, so it stays bounded by
``rate * (wait + watermark delay)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.operators.windows import interval


def match_with_timeout(orders: DataFrame, pays: DataFrame, wait: str, delay: str = "0 seconds",
                       key: str = "order_id", ts: str = "ts") -> DataFrame:
    """#23 full outer join on the key with ``|pay - order| <= wait``; rows tagged
    ``matched`` / ``order_only`` / ``pay_only`` (append mode)."""
    o = (orders.select(F.col(key).alias("order_id"), F.col(ts).cast("timestamp").alias("order_ts"))
         .withWatermark("order_ts", delay))
    p = (pays.select(F.col(key).alias("pay_id"), F.col(ts).cast("timestamp").alias("pay_ts"), "channel")
         .withWatermark("pay_ts", delay))
    w = interval(wait)
    cond = ((o["order_id"] == p["pay_id"]) & (p["pay_ts"] >= o["order_ts"] - w)
            & (p["pay_ts"] <= o["order_ts"] + w))
    j = o.join(p, cond, "full_outer")
    kind = (F.when(F.col("order_ts").isNotNull() & F.col("pay_ts").isNotNull(), "matched")
            .when(F.col("order_ts").isNotNull(), "order_only").otherwise("pay_only"))
    return j.select(F.coalesce("order_id", "pay_id").alias("order_id"), "order_ts", "pay_ts", "channel",
                    kind.alias("kind"))


def order_timeout(creates: DataFrame, pays: DataFrame, wait: str, delay: str = "0 seconds",
                  key: str = "order_id", ts: str = "ts") -> DataFrame:
    """#57 creates with no pay within ``wait`` (left outer join, emitted when the
    watermark passes ``create + wait``)."""
    c = (creates.select(F.col(key).alias("order_id"), F.col(ts).cast("timestamp").alias("ts"))
         .withWatermark("ts", delay))
    p = (pays.select(F.col(key).alias("pay_id"), F.col(ts).cast("timestamp").alias("pay_ts"))
         .withWatermark("pay_ts", delay))
    w = interval(wait)
    cond = ((c["order_id"] == p["pay_id"]) & (p["pay_ts"] >= c["ts"] - w) & (p["pay_ts"] <= c["ts"] + w))
    j = c.join(p, cond, "left_outer")
    return j.filter(F.col("pay_ts").isNull()).select("order_id", F.lit("create").alias("op"), "ts")

"""Event views over the shared test tables.

The generated tables are TPC-H-like plus an ``events`` table. These views map them
onto the record types of the event jobs (behavior, sensor, login, access log,
marketing, order/pay, arrival order, words). Every view is a projection of a
whole table (or an aggregate of one), so its size grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The arrival permutation used to replay events out of order
# (delay = (event_id * 7919) mod 7200 seconds).
ARRIVAL_MULTIPLIER = 7919
ARRIVAL_SPREAD_S = 7200
# The time origin of the documents view (doc_id seconds after it).
DOC_EPOCH = "2024-01-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("bigint")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


# raw event type of each mapped behavior value (inverse of the view mappings)
_RAW_BEHAVIOR = {"pv": "view"}
_RAW_MARKETING = {"UNINSTALL": "signup"}


def behavior(spark: SparkSession, sf_dir: str, only: tuple[str, ...] | None = None) -> DataFrame:
    """UserBehavior: ``view`` plays ``pv``; item = props.k, category = k mod 10.

    ``only`` keeps just those behaviors, filtered on the raw ``event_type`` so the
    predicate reaches the parquet scan (a filter on the mapped column cannot)."""
    e = events(spark, sf_dir)
    if only:
        e = e.filter(F.col("event_type").isin([_RAW_BEHAVIOR.get(b, b) for b in only]))
    return e.select(
        "event_id", "user_id", _k().alias("item_id"),
        (_k() % 10).cast("int").alias("category_id"),
        F.when(F.col("event_type") == "view", "pv").otherwise(F.col("event_type")).alias("behavior"),
        "ts")


def behavior_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Behavior rows printed as the five-field CSV lines the text source reads."""
    b = behavior(spark, sf_dir)
    return b.select(F.concat_ws(",", "user_id", "item_id", "category_id", "behavior",
                                F.unix_seconds(F.col("ts").cast("timestamp"))).alias("value"))


def sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SensorReading: ten sensors (user_id mod 10 + 1), temperature = value."""
    return events(spark, sf_dir).select(
        "event_id",
        F.concat(F.lit("sensor_"), (F.col("user_id") % 10 + 1).cast("string")).alias("id"),
        "ts", F.col("value").alias("temperature"))


def login(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LoginEvent: ``error`` plays fail, ``signup`` plays success."""
    e = events(spark, sf_dir)
    return e.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.concat_ws(".", F.lit("10"), F.lit("0"), (F.col("user_id") % 256).cast("string"),
                    (F.col("event_id") % 256).cast("string")).alias("ip"),
        F.when(F.col("event_type") == "error", "fail")
         .when(F.col("event_type") == "signup", "success")
         .otherwise(F.col("event_type")).alias("event_type"),
        "ts")


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Access-log text lines: ``ip - user dd/MM/yyyy:HH:mm:ss +0000 METHOD /type/k``."""
    e = events(spark, sf_dir)
    ip = F.concat_ws(".", F.lit("10"), F.lit("0"), (F.col("user_id") % 256).cast("string"),
                     (F.col("event_id") % 256).cast("string"))
    method = F.when(F.col("event_type") == "purchase", "POST").otherwise("GET")
    url = F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), _k().cast("string"))
    return e.select(F.concat_ws(" ", ip, F.lit("-"), F.col("user_id").cast("string"),
                                F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"), F.lit("+0000"),
                                method, url).alias("value"))


def marketing(spark: SparkSession, sf_dir: str, exclude: tuple[str, ...] | None = None) -> DataFrame:
    """MarketingUserBehavior: ``signup`` plays UNINSTALL; channel by user parity.
    ``exclude`` drops behaviors on the raw column (pushed to the scan)."""
    e = events(spark, sf_dir)
    if exclude:
        e = e.filter(~F.col("event_type").isin([_RAW_MARKETING.get(b, b.lower()) for b in exclude]))
    return e.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        F.when(F.col("event_type") == "signup", "UNINSTALL")
         .otherwise(F.upper("event_type")).alias("behavior"),
        F.when(F.col("user_id") % 2 == 0, "AppStore").otherwise("XiaomiStore").alias("channel"),
        "ts")


def order_creates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """OrderEvent ``create`` rows: one per order at its order date."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("order_id"),
                    F.lit("create").alias("op"), F.col("o_orderdate").alias("ts"))


def pays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PayEvent: the first ship date of an order's lines (partial aggregation per order)."""
    li = table(spark, sf_dir, "lineitem")
    return (li.groupBy("l_orderkey").agg(F.min("l_shipdate").alias("ts"))
            .select(F.col("l_orderkey").cast("string").alias("order_id"),
                    F.when(F.col("l_orderkey") % 2 == 0, "weixin").otherwise("zhifubao").alias("channel"),
                    "ts"))


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One order stream holding both ``create`` and ``pay`` rows."""
    p = pays(spark, sf_dir).select("order_id", F.lit("pay").alias("op"), "ts")
    return order_creates(spark, sf_dir).unionByName(p)


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events replayed out of order: ``arrival = ts + (event_id * 7919 mod 7200) s``."""
    e = events(spark, sf_dir)
    delay = (F.col("event_id") * ARRIVAL_MULTIPLIER) % ARRIVAL_SPREAD_S
    return e.select("event_id", F.col("event_type").alias("key"), "ts",
                    (F.col("ts") + F.make_dt_interval(secs=delay)).alias("arrival"))


def documents_timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with an event time: ``doc_id`` seconds after 2024-01-01."""
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", "text",
                    (F.lit(DOC_EPOCH).cast("timestamp_ntz")
                     + F.make_dt_interval(secs=F.col("doc_id"))).alias("ts"))

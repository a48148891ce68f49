"""Record schemas of the event model (times are TIMESTAMP, read as UTC)."""

from pyspark.sql import types as T

SENSOR = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("temperature", T.DoubleType()),
])

BEHAVIOR = T.StructType([
    T.StructField("user_id", T.LongType()),
    T.StructField("item_id", T.LongType()),
    T.StructField("category_id", T.IntegerType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

# DDL strings used by from_csv when parsing text lines (the ts field is epoch seconds).
BEHAVIOR_CSV_DDL = "user_id BIGINT, item_id BIGINT, category_id INT, behavior STRING, ts_s BIGINT"
KEY_SECONDS_DDL = "key STRING, ts_s BIGINT"

ACCESS_LOG = T.StructType([
    T.StructField("ip", T.StringType()),
    T.StructField("user_id", T.StringType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("method", T.StringType()),
    T.StructField("url", T.StringType()),
])

LOGIN = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

ORDER = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("op", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

PAY = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

MARKETING = T.StructType([
    T.StructField("user_id", T.StringType()),
    T.StructField("behavior", T.StringType()),
    T.StructField("channel", T.StringType()),
    T.StructField("ts", T.TimestampType()),
])

KEYED_COUNT = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("window_end", T.TimestampType()),
    T.StructField("count", T.LongType()),
])

"""Line sources: text files (#2), sockets (#3) and Kafka (#4).

All return one string column ``value`` so every parser and job accepts any of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, stream: bool = False,
               max_files_per_trigger: int | None = None) -> DataFrame:
    """``readTextFile``: one row per line. Batch splits large files across tasks;
    the streaming form picks up new files, ``max_files_per_trigger`` bounds a micro-batch."""
    if not stream:
        return spark.read.text(path)
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(path)


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """``socketTextStream``: newline-separated lines from a TCP socket (not fault tolerant;
    for demos only, as in Spark's own docs)."""
    return (spark.readStream.format("socket")
            .option("host", host).option("port", str(port)).load())


def kafka_lines(spark: SparkSession, brokers: str, topic: str,
                starting_offsets: str = "latest", group_id: str | None = None,
                stream: bool = True) -> DataFrame:
    """Kafka consumer of string values. Needs the spark-sql-kafka connector on the
    classpath; partitions of the topic map to Spark tasks."""
    r = spark.readStream if stream else spark.read
    r = (r.format("kafka")
         .option("kafka.bootstrap.servers", brokers)
         .option("subscribe", topic)
         .option("startingOffsets", starting_offsets))
    if group_id:
        r = r.option("kafka.group.id", group_id)
    return r.load().select(F.col("value").cast("string").alias("value"))

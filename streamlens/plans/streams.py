"""Named streaming jobs: compositions of sources, parsers, aggregates and sinks.

#43: top-3 items from a line source (Kafka in production, any line source here)
to the console or to the document index.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from streamlens.session import stream_checkpoint
from streamlens.sources import kafka_lines, parse_behavior_csv
from streamlens.sources import sinks
from streamlens.streaming import aggregates as sa


def hot_items_report_stream(lines: DataFrame, n: int = 3, size: str = "60 minutes", slide: str = "5 minutes",
                            bound: str = "1 second") -> DataFrame:
    """Behavior CSV lines -> per sliding window, the ranked report of the top ``n`` items."""
    rows, _ = parse_behavior_csv(lines)
    counts = sa.window_counts(sa.with_event_time(rows, "ts", bound), "item_id", "ts", size, slide)
    return sa.top_n_report(counts, "item_id", n)


def kafka_hot_items_to_index(spark: SparkSession, brokers: str, topic: str, index_path: str,
                             name: str = "hot_items_index") -> StreamingQuery:
    """#4 -> #9 -> #34 -> #41 -> #44 -> #6: Kafka lines to index documents, one
    idempotent directory per micro-batch."""
    report = hot_items_report_stream(kafka_lines(spark, brokers, topic, "latest"))
    docs = sinks.index_documents(report, text="report", id_cols=("window_end",))
    return (docs.writeStream.outputMode("append")
            .option("checkpointLocation", stream_checkpoint(spark, name))
            .foreachBatch(lambda b, i: sinks.write_index_batch(b, i, index_path))
            .start())

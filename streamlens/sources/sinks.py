"""Sinks (#5, #6, #8): Kafka, a document index, console (#7: :mod:`streamlens.sources.store`).

Streaming sinks go through ``foreachBatch`` where the target has no streaming
writer; every such write is idempotent per ``batch_id`` so a replayed micro-batch
(after a lost executor or a restart from the checkpoint) leaves the same result.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

# Name of the field that wraps each line in an index document.
INDEX_FIELD = "myUserbe"


def kafka_sink(df: DataFrame, brokers: str, topic: str, value: str = "value",
               checkpoint: str | None = None) -> StreamingQuery | None:
    """#5 write ``value`` (cast to string) to a Kafka topic; batch or stream. Needs the
    spark-sql-kafka connector on the classpath."""
    out = df.select(F.col(value).cast("string").alias("value"))
    if not df.isStreaming:
        out.write.format("kafka").option("kafka.bootstrap.servers", brokers).option("topic", topic).save()
        return None
    return (out.writeStream.format("kafka").option("kafka.bootstrap.servers", brokers)
            .option("topic", topic).option("checkpointLocation", checkpoint).start())


def index_documents(df: DataFrame, text: str = "value", id_cols: tuple[str, ...] = ()) -> DataFrame:
    """#6 documents ``{"myUserbe": text}`` with a deterministic ``_id`` (sha-256 of the
    id columns, or of the text): writing the same rows twice gives the same docs."""
    ids = [F.col(c).cast("string") for c in id_cols] or [F.col(text)]
    return df.select(F.sha2(F.concat_ws("\u0001", *ids), 256).alias("_id"),
                     F.to_json(F.struct(F.col(text).alias(INDEX_FIELD))).alias("doc"))


def write_index_batch(batch: DataFrame, batch_id: int, path: str, fmt: str = "json") -> None:
    """``foreachBatch`` body for #6: one directory per batch id, overwritten on replay."""
    batch.write.mode("overwrite").format(fmt).save(os.path.join(path, f"batch_id={batch_id}"))


def console(df: DataFrame, output_mode: str = "append", checkpoint: str | None = None,
            truncate: bool = False) -> StreamingQuery | None:
    """#8 print: ``show`` for a batch, the console sink for a stream."""
    if not df.isStreaming:
        df.show(truncate=truncate)
        return None
    w = df.writeStream.format("console").outputMode(output_mode).option("truncate", str(truncate).lower())
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.start()


def fan_out_batches(*handlers: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """#17 on a stream: one ``foreachBatch`` that persists the micro-batch once and
    hands it to every output (each handler ``(batch, batch_id)`` must be idempotent
    per batch id, e.g. overwrite a ``batch_id=`` folder)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for h in handlers:
                h(batch, batch_id)
        finally:
            batch.unpersist()

    return handle

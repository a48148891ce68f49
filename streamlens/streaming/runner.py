"""Run a streaming plan over all available input and read the result back.

Used by tests and small jobs: ``trigger(availableNow=True)`` processes everything
that is there (several micro-batches when the source limits a batch) and stops.
The checkpoint lives under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from streamlens.session import stream_checkpoint


def run_available(df: DataFrame, output_mode: str = "append", name: str | None = None,
                  timeout_s: int = 300) -> DataFrame:
    spark: SparkSession = df.sparkSession
    name = name or f"sl_{uuid.uuid4().hex[:10]}"
    q = (df.writeStream.format("memory").queryName(name).outputMode(output_mode)
         .option("checkpointLocation", stream_checkpoint(spark, name))
         .trigger(availableNow=True).start())
    finished = q.awaitTermination(timeout_s)
    if not finished:
        q.stop()
        raise TimeoutError(f"stream {name} did not finish in {timeout_s}s")
    if q.exception():
        raise q.exception()
    return spark.table(name)


def file_stream(spark: SparkSession, path: str, schema, max_files_per_trigger: int = 1) -> DataFrame:
    """Parquet files as a stream, ``max_files_per_trigger`` files per micro-batch."""
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", str(max_files_per_trigger))
            .parquet(path))


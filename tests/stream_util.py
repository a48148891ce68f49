"""Streams whose rows are out of order across micro-batches, run with a restart from the checkpoint."""

import os
import time
import uuid
from datetime import datetime

from pyspark.sql import functions as F

from streamlens.streaming.runner import file_stream

FLUSH = datetime(2100, 1, 1)


def parts_out_of_order(df, ts, bound_s, n):
    """``n`` parts of ``df``; a row arrives up to ``bound_s`` seconds after its time, so parts overlap in time but no row
    is behind the watermark of a stream with that bound."""
    late = F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(int(bound_s * 1000))) * 1000
    us = F.unix_micros(F.col(ts).cast("timestamp")) + late
    d = df.withColumn(ts, F.col(ts).cast("timestamp")).withColumn("_a", us).cache()
    lo, hi = d.agg(F.min("_a"), F.max("_a")).first()
    part = F.least(F.floor((F.col("_a") - lo) * n / F.lit(hi - lo + 1)), F.lit(n - 1))
    return [d.where(part == k).drop("_a") for k in range(n)]


def run_in_parts(spark, tmp_path, parts, build, restart_after=None, flush=None, foreach=None, mode="append"):
    """Write each part as one file, run ``build(stream)`` over them, one file per micro-batch, stopping after
    ``restart_after`` parts and going on from the checkpoint; the rows of the file sink (or nothing with ``foreach``)."""
    run = str(tmp_path / uuid.uuid4().hex[:8])
    src, out, ck = (os.path.join(run, x) for x in ("src", "out", "ck"))
    schema = parts[0].schema
    if flush is not None:
        parts = [*parts, spark.createDataFrame([flush], schema)]

    def go():
        w = build(file_stream(spark, src, schema)).writeStream.option("checkpointLocation", ck).trigger(availableNow=True)
        w = w.outputMode(mode).foreachBatch(foreach) if foreach else w.format("parquet").option("path", out).outputMode("append")
        q = w.start()
        assert q.awaitTermination(240)
        assert q.exception() is None

    for k, p in enumerate(parts):
        p.coalesce(1).write.mode("append").parquet(src)
        time.sleep(0.05)
        if restart_after is not None and k + 1 == restart_after:
            go()
    go()
    return None if foreach else spark.read.parquet(out)

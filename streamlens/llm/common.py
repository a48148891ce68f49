"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
import math
import os
import re
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def shared_dir(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a scratch folder only where it is unset
    in a local session (tests). A cluster without the setting is an error."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="streamlens-shared-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder for one run's intermediate table."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner remove the shuffle files of finished queries now: it acts when the driver's JVM
    has collected the plans that made them, which may not happen for hours."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: cuts the lineage and
    survives lost executors. The shuffle files of what came before are released."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    free_shuffles(spark)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame | None) -> None:
    """Delete tables of :func:`written` whose rows other tables hold by now. Reading one again is an error."""
    for t in tables:
        for path in {os.path.dirname(f) for f in t.inputFiles()} if t is not None else ():
            if not re.search("-[0-9a-f]{32}$", path):
                raise ValueError(f"not a table of written(): {path}")
            jvm, sc = t.sparkSession._jvm, t.sparkSession.sparkContext
            at = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path))
            at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def words(c: Column) -> Column:
    """Array of words (``[^\\x20\\x09-\\x0D]+``) of a text; empty for null or blank text."""
    blank = F.translate(F.coalesce(c, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.filter(F.split(blank, " +"), lambda w: w != "")


def held_out(doc_id: Column, mod: int, remainder: int) -> Column:
    """True where crc32(doc_id as text) mod ``mod`` is ``remainder`` (null ids count as the empty text)."""
    return (F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod) == remainder


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds at most ``most_bytes`` (or list items) per slice (one row at
    least); bounds the memory of a task whatever the batch size and text lengths."""
    for b in batches:
        n, start = b.num_rows, 0
        col = b.column(b.schema.get_field_index(column))
        size = pc.list_value_length if pa.types.is_list(col.type) else pc.binary_length
        sizes = size(col).fill_null(0).to_numpy(zero_copy_only=False)
        total = 0
        for i in range(n):
            total += int(sizes[i]) + 64
            if total > most_bytes:
                yield b.slice(start, i + 1 - start)
                start, total = i + 1, 0
        if start < n:
            yield b.slice(start)


def parts_for(total_bytes: int, per_part: int, least: int = 1) -> int:
    return max(least, math.ceil(total_bytes / per_part))

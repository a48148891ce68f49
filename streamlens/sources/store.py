"""#7 keyed counter store: a Parquet table of runs, kept up to date by micro-batches of changed rows.

Each micro-batch writes one *run*, its rows by hour of the window's end and sorted by key; an hour's rows are the latest
row of each key over the hour's runs. A *manifest* (one small file per version, put in place by a rename) names the
live runs of each hour and the last batch applied, so

- a micro-batch replayed after a crash is either applied already, and skipped, or its half-written run is overwritten;
- a reader sees one version: all of a batch or nothing of it, also while a merge runs;
- a read of some hours opens the runs of these hours only.

Hours with more than ``most_runs`` runs are merged, as part of the batch that makes them so, into one run of the latest
rows; the merged files come into effect with the next manifest. :meth:`CountStore.vacuum` removes what no manifest
names any more. One writer at a time (the stream's ``foreachBatch``), any number of readers. The path may be on any
file system Spark reads; renames must be atomic there. On the driver: file names only, one entry per run and hour.
"""

from __future__ import annotations

import json
import os
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_HOUR, _BATCH, _RUN = "_hour", "_batch", "_run"
_FORMAT = "yyyyMMddHH"


class CountStore:
    def __init__(self, spark: SparkSession, path: str, keys: tuple[str, ...] = ("window_end",), time: str = "window_end", most_runs: int = 8):
        if time not in keys:
            raise ValueError("the time must be one of the keys: a key's rows stay in one hour")
        self.spark, self.path, self.keys, self.time, self.most_runs = spark, path, tuple(keys), time, most_runs
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    # --- manifests ------------------------------------------------------------------------
    def _names(self, *parts: str) -> list[str]:
        at = self._path(os.path.join(self.path, *parts))
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def manifest(self) -> dict:
        """The current version: ``version``, ``applied`` (last batch id), ``schema``, ``runs`` ([run, hour] pairs)."""
        versions = sorted(n for n in self._names("manifest") if n.startswith("v"))
        if not versions:
            return {"version": 0, "applied": -1, "schema": None, "runs": []}
        stream = self._fs.open(self._path(os.path.join(self.path, "manifest", versions[-1])))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, m: dict) -> dict:
        m = {**m, "version": m["version"] + 1}
        made = self._path(os.path.join(self.path, "manifest", f"tmp-{uuid.uuid4().hex}"))
        final = self._path(os.path.join(self.path, "manifest", f"v{m['version']:020d}.json"))
        if self._fs.exists(final):
            raise RuntimeError(f"{final}: another writer has made this version")
        stream = self._fs.create(made, False)
        stream.write(bytearray(json.dumps(m).encode()))
        stream.close()
        if not self._fs.rename(made, final):
            raise RuntimeError(f"{final}: could not be put in place")
        return m

    # --- runs -----------------------------------------------------------------------------------
    def _write(self, rows: DataFrame, run: str) -> list[list[str]]:
        """Write rows that have an hour and a batch number; the run's hours."""
        at = os.path.join(self.path, "runs", f"{_RUN}={run}")
        # rebalanced by hour, so an hour is few files, and a large hour several tasks
        rows.hint("rebalance", _HOUR).sortWithinPartitions(_HOUR, *self.keys).write.mode("overwrite").partitionBy(_HOUR).parquet(at)
        return [[run, n.split("=", 1)[1]] for n in self._names("runs", f"{_RUN}={run}") if n.startswith(f"{_HOUR}=")]

    def _rows(self, m: dict, runs: list[list[str]]) -> DataFrame:
        """The latest row of each key in these runs, with hour and batch number."""
        base = os.path.join(self.path, "runs")
        schema = T.StructType.fromJson(m["schema"])
        full = T.StructType([*schema.fields, T.StructField(_BATCH, T.LongType()), T.StructField(_RUN, T.StringType()), T.StructField(_HOUR, T.StringType())])
        if not runs:
            return self.spark.createDataFrame([], full).drop(_RUN)
        rows = self.spark.read.schema(full).option("basePath", base).parquet(*[os.path.join(base, f"{_RUN}={r}", f"{_HOUR}={h}") for r, h in runs])
        values = [f.name for f in schema.fields if f.name not in self.keys]
        latest = rows.groupBy(_HOUR, *self.keys).agg(F.max(_BATCH).alias(_BATCH), F.max_by(F.struct(*values), _BATCH).alias("_v"))
        return latest.select(*[F.col("_v").getField(f.name).alias(f.name) if f.name in values else F.col(f.name) for f in schema.fields], _BATCH, _HOUR)

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        """``foreachBatch`` body: the batch's rows replace those of their keys; other keys stay. One row per key and
        batch (cumulative counts, as the update mode gives them). A batch id that was applied is skipped."""
        m = self.manifest()
        if batch_id <= m["applied"]:
            return
        if m["schema"] and [f["name"] for f in m["schema"]["fields"]] != batch.columns:
            raise ValueError(f"the store has the columns {[f['name'] for f in m['schema']['fields']]}")
        rows = batch.withColumn(_BATCH, F.lit(batch_id).cast("long")).withColumn(_HOUR, F.coalesce(F.date_format(self.time, _FORMAT), F.lit("none")))
        runs = self._write(rows, f"b{batch_id}")
        m = self._commit({**m, "applied": batch_id, "schema": json.loads(batch.schema.json()), "runs": m["runs"] + runs})
        counts: dict[str, int] = {}
        for _, h in m["runs"]:
            counts[h] = counts.get(h, 0) + 1
        due = {h for h, n in counts.items() if n > self.most_runs}
        if due:
            self.merge(due)

    def merge(self, hours: set[str] | None = None) -> None:
        """Merge the runs of these hours (all, if not given) into one run of the latest rows."""
        m = self.manifest()
        old = [r for r in m["runs"] if hours is None or r[1] in hours]
        if not old:
            return
        made = self._write(self._rows(m, old), f"m{m['version']}")
        self._commit({**m, "runs": [r for r in m["runs"] if r not in old] + made})

    def read(self, start: datetime | None = None, end: datetime | None = None) -> DataFrame:
        """The current rows; with ``start`` / ``end`` those of the hours that touch the span, opening only their runs."""
        m = self.manifest()
        if m["schema"] is None:
            raise ValueError(f"{self.path}: nothing was written yet")
        low, high = (None if t is None else t.strftime("%Y%m%d%H") for t in (start, end))
        runs = [r for r in m["runs"] if (low is None or r[1] >= low) and (high is None or r[1] <= high)]
        return self._rows(m, runs).drop(_BATCH, _HOUR)

    def vacuum(self) -> int:
        """Remove runs and manifests that the current version does not name (once no older reader is left); how many."""
        m = self.manifest()
        live = {f"{_RUN}={r}" for r, _ in m["runs"]}
        gone = [("runs", n) for n in self._names("runs") if n not in live]
        gone += [("manifest", n) for n in self._names("manifest") if n != f"v{m['version']:020d}.json"]
        for parts in gone:
            self._fs.delete(self._path(os.path.join(self.path, *parts)), True)
        return len(gone)

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stream_util import run_in_parts
from streamlens.sources import sinks, store
from streamlens.streaming import aggregates as sa


def test_index_documents_deterministic(spark, tmp_path):
    df = spark.createDataFrame([("a,1,2",), ("b,3,4",)], "value string")
    docs = sinks.index_documents(df)
    first = {r._id: r.doc for r in docs.collect()}
    assert {json.loads(v)[sinks.INDEX_FIELD] for v in first.values()} == {"a,1,2", "b,3,4"}
    # writing the same batch twice leaves one copy (overwrite per batch id)
    p = str(tmp_path / "idx")
    sinks.write_index_batch(docs, 7, p)
    sinks.write_index_batch(docs, 7, p)
    assert spark.read.json(os.path.join(p, "batch_id=7")).count() == 2


def at(hour, minute=0):
    return datetime(2024, 1, 1, hour, minute)


def counts(spark, *rows):
    return spark.createDataFrame(list(rows), "window_end timestamp, key string, n long")


def rows(df):
    return sorted(((r.window_end, r.key, r.n) for r in df.collect()), key=repr)


def test_store_keeps_keys_that_did_not_change_and_skips_replays(spark, tmp_path):
    s = store.CountStore(spark, str(tmp_path / "counts"), ("window_end", "key"))
    s.upsert(counts(spark, (at(1), "a", 1), (at(1), "b", 1), (None, "z", 9)), 0)
    s.upsert(counts(spark, (at(1), "a", 2), (at(2), None, 5)), 1)
    s.upsert(counts(spark, (at(1), "a", 100)), 1)  # a replay of an applied batch
    want = [(at(1), "a", 2), (at(1), "b", 1), (at(2), None, 5), (None, "z", 9)]
    assert rows(s.read()) == sorted(want, key=repr)
    s.merge()
    assert rows(s.read()) == sorted(want, key=repr) and len(s.manifest()["runs"]) == 3
    s.upsert(counts(spark, (at(1), "b", 5)), 2)
    assert rows(s.read(at(1), at(1, 59))) == [(at(1), "a", 2), (at(1), "b", 5)]
    with pytest.raises(ValueError):
        s.upsert(spark.createDataFrame([(at(1), 1)], "window_end timestamp, n long"), 3)


def test_store_reads_the_runs_of_its_hours_only(spark, tmp_path):
    s = store.CountStore(spark, str(tmp_path / "counts"), ("window_end", "key"))
    for k in range(4):
        s.upsert(counts(spark, (at(k, 30), "a", k), (at(k + 1, 30), "a", k)), k)
    files = s.read(at(2), at(2, 59)).inputFiles()
    assert len(files) == 2 and all("_hour=2024010102" in f for f in files)
    assert rows(s.read(at(2), at(2, 59))) == [(at(2, 30), "a", 2)]


def test_store_merges_in_the_background_and_is_cleaned(spark, tmp_path):
    path = str(tmp_path / "counts")
    s = store.CountStore(spark, path, ("window_end", "key"), most_runs=2)
    for k in range(6):
        s.upsert(counts(spark, (at(1), "a", k), (at(1), f"k{k}", k), (at(3 + k), "x", k)), k)
    runs = s.manifest()["runs"]
    assert sum(h == "2024010101" for _, h in runs) <= 2
    want = rows(s.read())
    assert [r for r in want if r[0] == at(1)] == sorted([(at(1), "a", 5)] + [(at(1), f"k{k}", k) for k in range(6)], key=repr)
    assert s.vacuum() > 0 and rows(s.read()) == want
    assert len(os.listdir(os.path.join(path, "manifest"))) <= 2  # the file and its checksum
    assert rows(store.CountStore(spark, path, ("window_end", "key")).read()) == want


def test_store_survives_a_crash_before_the_manifest(spark, tmp_path, monkeypatch):
    s = store.CountStore(spark, str(tmp_path / "counts"), ("window_end", "key"))
    s.upsert(counts(spark, (at(1), "a", 1)), 0)
    commit = s._commit
    monkeypatch.setattr(s, "_commit", lambda m: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        s.upsert(counts(spark, (at(1), "a", 2), (at(1), "b", 2)), 1)
    assert rows(s.read()) == [(at(1), "a", 1)]  # half a batch is never seen
    monkeypatch.setattr(s, "_commit", commit)
    s.upsert(counts(spark, (at(1), "a", 2)), 1)  # the replay may even bring other rows
    assert rows(s.read()) == [(at(1), "a", 2)]


def test_store_under_a_stream_with_restart(spark, tmp_path):
    """Update-mode counts of a stream that is stopped and started again."""
    path = str(tmp_path / "counts")
    data = [("ab"[i % 2], at(i % 5, i % 50)) for i in range(60)]
    parts = [spark.createDataFrame(data[i:i + 20], "key string, ts timestamp") for i in (0, 20, 40)]

    def write(batch, batch_id):
        store.CountStore(batch.sparkSession, path, ("window_end", "key"), most_runs=2).upsert(batch, batch_id)

    def build(s):
        c = sa.window_counts(sa.with_event_time(s, "ts", "1 day"), "key", "ts", "1 hour", out="n")
        return c.select(F.col("window.end").alias("window_end"), "key", "n")

    run_in_parts(spark, tmp_path, parts, build, restart_after=2, foreach=write, mode="update")
    want = {}
    for k, t in data:
        e = t.replace(minute=0) + timedelta(hours=1)
        want[e, k] = want.get((e, k), 0) + 1
    assert rows(store.CountStore(spark, path, ("window_end", "key")).read()) == sorted(((e, k, n) for (e, k), n in want.items()), key=repr)


def test_fan_out_batches_feeds_every_output(spark, tmp_path):
    from streamlens.session import stream_checkpoint
    from streamlens.streaming.runner import file_stream
    src = str(tmp_path / "src")
    spark.createDataFrame([(1, 70.0), (2, 10.0)], "id long, t double").write.parquet(src)
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    h = sinks.fan_out_batches(
        lambda d, i: d.filter("t > 60").write.mode("overwrite").parquet(f"{a}/batch_id={i}"),
        lambda d, i: d.select("id").write.mode("overwrite").parquet(f"{b}/batch_id={i}"))
    q = (file_stream(spark, src, "id long, t double").writeStream.foreachBatch(h)
         .option("checkpointLocation", stream_checkpoint(spark, "fanout_test")).trigger(availableNow=True).start())
    assert q.awaitTermination(120)
    assert [r.id for r in spark.read.parquet(a).collect()] == [1]
    assert sorted(r.id for r in spark.read.parquet(b).collect()) == [1, 2]

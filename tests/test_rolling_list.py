"""Rolling lists kept as segments: any prefix equals the rolling list's row; linear space."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import SF001
from streamlens.operators import rolling
from streamlens.sources import testdata as td


def test_every_prefix_is_rebuilt(spark):
    b = td.behavior(spark, SF001).select("user_id", "behavior", "ts", "event_id")
    b = b.withColumn("behavior", F.when(F.col("event_id") % 5 != 0, F.col("behavior"))).withColumn("user_id", F.when(F.col("user_id") % 11 != 0, F.col("user_id") % 7))
    seg = rolling.list_segments(b, "user_id", "behavior", ("ts", "event_id"), size=4)
    wanted = seg.select("user_id", F.explode("rows.seq").alias("seq"))
    got = sorted(((r.user_id, list(r["items"])) for r in rolling.list_prefix(seg, wanted, "user_id", size=4).collect()), key=repr)
    want = sorted(((r.user_id, list(r["items"])) for r in rolling.rolling_list(b, "user_id", "behavior", ("ts", "event_id")).collect()), key=repr)
    assert got == want and any(u is None for u, _ in got)
    assert seg.select(F.max(F.size("rows"))).first()[0] == 4 and seg.select(F.sum(F.size("rows"))).first()[0] == b.count()


def test_arrays_and_a_place_behind_the_end(spark):
    t = datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", t + timedelta(seconds=i), [i, -i] if i % 2 else None) for i in range(10)], "k string, ts timestamp, v array<int>")
    seg = rolling.list_segments(df, "k", "v", ("ts",), size=3)
    wanted = spark.createDataFrame([("a", 2), ("a", 99), ("b", 1)], "k string, seq long")
    got = {(r.k, r.seq): list(r["items"]) for r in rolling.list_prefix(seg, wanted, "k", size=3).collect()}
    assert got == {("a", 2): [1, -1], ("a", 99): [x for i in range(10) if i % 2 for x in (i, -i)]}

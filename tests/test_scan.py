import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from streamlens.operators.scan import cut, following, running, sequence_number


def _data(spark, n=3000, hot=0.4, seed=7):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < hot else f"k{rnd.randint(0, 40)}"
        rows.append((k, rnd.randint(0, 500), i, float(rnd.randint(-50, 50))))
    return spark.createDataFrame(rows, "k string, t int, id int, v double")


def _rows(df, cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_running_matches_window(spark):
    df = _data(spark)
    order = ["t", "id"]
    for agg, fn in [("sum", F.sum), ("min", F.min), ("max", F.max), ("count", F.count)]:
        for inclusive in (True, False):
            w = Window.partitionBy("k").orderBy(*order).rowsBetween(
                Window.unboundedPreceding, 0 if inclusive else -1)
            exp = df.withColumn("r", fn("v").over(w))
            if agg == "count":
                exp = exp.withColumn("r", F.coalesce("r", F.lit(0)))
            got = running(df, keys=["k"], order=order, value="v", agg=agg, out="r",
                          inclusive=inclusive, num_parts=7)
            assert _rows(got, ["id", "r"]) == _rows(exp, ["id", "r"]), (agg, inclusive)


def test_running_global_and_last(spark):
    df = _data(spark)
    w = Window.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, -1)
    exp = df.withColumn("r", F.max("v").over(w))
    got = running(df, order=["t", "id"], value="v", agg="max", out="r", inclusive=False, num_parts=5)
    assert _rows(got, ["id", "r"]) == _rows(exp, ["id", "r"])
    lag = df.withColumn("r", F.lag("v").over(Window.partitionBy("k").orderBy("t", "id")))
    got = running(df, keys=["k"], order=["t", "id"], value="v", agg="last", out="r",
                  inclusive=False, num_parts=6)
    assert _rows(got, ["id", "r"]) == _rows(lag, ["id", "r"])


def test_sequence_and_neighbours(spark):
    df = _data(spark, n=800)
    s = sequence_number(df, keys=["k"], order=["t", "id"], num_parts=5)
    exp = df.withColumn("seq", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")))
    assert _rows(s, ["id", "seq"]) == _rows(exp, ["id", "seq"])
    w = Window.partitionBy("k").orderBy("t", "id")
    for parts in (1, 5, 300):
        nb = following(df, keys=["k"], order=["t", "id"], cols=["id", "v"], ahead=3, num_parts=parts)
        exp2 = df.select("id", *[F.lead(c, j).over(w).alias(f"{c}_n{j}") for j in (1, 2, 3) for c in ("id", "v")])
        assert sorted(map(str, nb.select(exp2.columns).collect())) == sorted(map(str, exp2.collect()))


def test_hot_key_is_split_evenly(spark):
    df = _data(spark, n=6000, hot=0.4)
    sizes = [r["count"] for r in cut(df, ["t"], 12).groupBy("k", "_b").count().collect()]
    hot = [r["count"] for r in cut(df, ["t"], 12).where("k = 'hot'").groupBy("_b").count().collect()]
    assert len(hot) == 12 and max(hot) <= 2 * 0.4 * 6000 / 12
    assert max(sizes) == max(hot)


def test_buckets_are_in_order(spark):
    df = _data(spark, n=500).withColumn("t", F.when(F.col("id") % 9 > 0, F.col("t")))
    for n in (2, 7, 50):
        rows = cut(df, ["t"], n).select("t", "_b").collect()
        rows.sort(key=lambda r: (r.t is not None, r.t or 0))
        assert all(a._b <= b._b for a, b in zip(rows, rows[1:])) and max(r._b for r in rows) < n


def test_null_key_is_carried_over_all_buckets(spark):
    df = spark.range(200).select(F.lit(None).cast("string").alias("k"), F.col("id").alias("t"), F.lit(1).alias("v"))
    got = running(df, keys=["k"], order=["t"], value="v", agg="sum", out="r", num_parts=8)
    assert got.agg(F.max("r")).first()[0] == 200


def test_tied_order_gives_each_row_once(spark):
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 4)], "k string, t int, v int")
    got = sorted(r.r for r in running(df, keys=["k"], order=["t"], value="v", agg="sum", out="r", num_parts=3).collect())
    assert len(got) == 3 and got[-1] == 7 and got[1] == 3
    same = spark.range(1000).select(F.lit("a").alias("k"), F.lit(5).alias("t"), F.lit(1).alias("v"))
    assert running(same, keys=["k"], order=["t"], value="v", agg="sum", out="r", num_parts=8).agg(F.sum("r")).first()[0] == 500500


def test_building_runs_no_job(spark):
    df = _data(spark, n=100)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    running(df, keys=["k"], order=["t", "id"], value="v", agg="last", out="r")
    following(df, keys=["k"], order=["t", "id"], cols=["v"], ahead=2)
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_payload_comes_through(spark):
    df = _data(spark, n=1500).withColumn("payload", F.concat(F.lit("p"), F.col("id").cast("string")))
    w = Window.partitionBy("k").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.withColumn("r", F.sum("v").over(w))
    got = running(df, keys=["k"], order=["t", "id"], value="v", agg="sum", out="r", num_parts=5)
    assert got.columns == df.columns + ["r"]
    assert _rows(got, ["id", "payload", "r"]) == _rows(exp, ["id", "payload", "r"])

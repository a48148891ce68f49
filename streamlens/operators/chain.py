"""Re-arming timers as chains of rows (#55, #56), without a loop over a key's rows.

Cancelling rows part a key's rows into runs; the first opening row of a run opens a span, and one whose span runs to its
end points to the first opening row of the run behind that end. The pointers come from running minima in descending order
(:mod:`streamlens.operators.scan`), so a hot key is spread over tasks. The rows that really open a span are those a
chain reaches from the first of its run: pointer doubling, each round joins the pointers with themselves and doubles the
distance covered, so a chain of n spans takes log2(n) rounds of joins on (key, row number), whose hash spreads the rows
of one key evenly. Rounds are cut by ``checkpoint()`` in the shared folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.operators.scan import running, sequence_number
from streamlens.session import checkpoint_dir

_LAST = (1 << 62) - 1


def reached(heads: DataFrame, nodes: DataFrame) -> DataFrame:
    """(_k, seq) of the nodes that the chains from ``heads`` (_k, seq) visit. ``nodes``: (_k, seq, nxt), ``nxt`` the
    ``seq`` of a later node of the key, or null. No node lies on two chains."""
    checkpoint_dir(nodes.sparkSession)  # names the shared folder to checkpoint()
    found = heads
    jump = nodes.where(F.col("nxt").isNotNull()).select("_k", "seq", "nxt").checkpoint()
    while not jump.isEmpty():
        a, b = found.alias("a"), jump.alias("b")
        step = a.join(b, F.col("a._k").eqNullSafe(F.col("b._k")) & (F.col("a.seq") == F.col("b.seq"))).select("a._k", F.col("b.nxt").alias("seq"))
        found = found.unionAll(step).checkpoint()
        a, b = jump.alias("a"), jump.alias("b")
        jump = a.join(b, F.col("a._k").eqNullSafe(F.col("b._k")) & (F.col("a.nxt") == F.col("b.seq"))).select(
            "a._k", "a.seq", "b.nxt").checkpoint()
    return found


def spans(df: DataFrame, key: str, ts: str, order: Sequence[str], opens: Column, cancels: Column, span_us: int) -> DataFrame:
    """(``key``, start_us) of the spans that run to their end. In ``order``, an opening row starts a span unless one is
    open; a cancelling row up to start + ``span_us``, itself included, ends it; else it ends there. Rows with a null
    time count for nothing; a null key is a key."""
    checkpoint_dir(df.sparkSession)
    d = df.where(F.col(ts).isNotNull()).withColumn("_k", F.col(key)).withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    d = d.withColumn("_open", F.coalesce(opens, F.lit(False))).withColumn("_stop", F.coalesce(cancels, F.lit(False))).where("_open or _stop")
    d = sequence_number(d, keys=["_k"], order=order, out="seq").select("_k", "_us", "seq", "_open", "_stop").checkpoint()
    # the next cancelling row of each row
    stop = F.when(F.col("_stop"), F.struct("seq", F.col("_us").alias("us")))
    d = running(d.withColumn("_back", -F.col("seq")), keys=["_k"], order=["_back"], value=stop, agg="min", inclusive=False, out="_cancel")
    opened = d.where("_open").select("_k", "_us", "seq", F.col("_cancel.seq").alias("_run"), (F.col("_cancel.us") <= F.col("_us") + span_us).alias("_ended"))
    opened = opened.checkpoint()
    # behind a cancelling row no span is open, so the first opening row of each run starts one, and a chain stays in its run
    heads = opened.groupBy("_k", "_run").agg(F.min("seq").alias("seq")).select("_k", "seq")
    whole = opened.where("_ended IS NULL OR NOT _ended")
    # the first opening row behind a span's end: a running minimum from behind over rows and ends
    ends = whole.select("_k", (F.col("_us") + span_us).alias("_us"), F.lit(_LAST).alias("_place"), "seq", "_run", F.col("_us").alias("_start"))
    there = opened.select("_k", "_us", F.col("seq").alias("_place"), "seq", "_run", F.lit(None).cast("long").alias("_start"))
    both = ends.unionByName(there).withColumn("_b0", -F.col("_us")).withColumn("_b1", -F.col("_place"))
    found = running(both, keys=["_k"], order=["_b0", "_b1"], value=F.when(F.col("_start").isNull(), F.col("seq")), agg="min", out="nxt")
    nodes = found.where(F.col("_start").isNotNull()).select(
        "_k", "seq", "_start", F.when(F.col("_run").isNull() | (F.col("nxt") < F.col("_run")), F.col("nxt")).alias("nxt")).checkpoint()
    a, b = reached(heads, nodes).alias("a"), nodes.alias("b")
    done = a.join(b, F.col("a._k").eqNullSafe(F.col("b._k")) & (F.col("a.seq") == F.col("b.seq")))
    return done.select(F.col("b._k").alias(key), F.col("b._start").alias("start_us"))


def count_inside(starts: DataFrame, rows: DataFrame, key: str, ts: str, span_us: int, out: str) -> DataFrame:
    """``starts`` (``key``, start_us) with the number of ``rows`` in [start, start + span_us]; spans of a key do not
    overlap. Equi-join on (key, time bucket of one span's width): a span touches two buckets, so a hot key is spread
    over its buckets and no row meets more than two spans of each."""
    s = starts.withColumn("_b", F.explode(F.array(F.col("start_us") - F.pmod(F.col("start_us"), F.lit(span_us)),
                                                  F.col("start_us") - F.pmod(F.col("start_us"), F.lit(span_us)) + span_us))).alias("s")
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    r = rows.select(F.col(key).alias("_k"), us.alias("_us"), (us - F.pmod(us, F.lit(span_us))).alias("_b")).alias("r")
    hit = s.join(r, F.col(f"s.{key}").eqNullSafe(F.col("r._k")) & (F.col("s._b") == F.col("r._b"))
                 & (F.col("r._us") >= F.col("s.start_us")) & (F.col("r._us") <= F.col("s.start_us") + span_us))
    return hit.groupBy(F.col(f"s.{key}").alias(key), F.col("s.start_us").alias("start_us")).agg(F.count(F.lit(1)).alias(out))

"""Plan shapes the scale design relies on (checked on the physical plan text)."""

import re

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF001
from streamlens.operators import windows
from streamlens.operators.scan import running


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_top_n_limits_map_side(spark):
    p = _plan(E.queries()["hot_items_top3"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p


def test_filters_and_columns_reach_the_scan(spark):
    p = _plan(E.queries()["filter_map"](spark, SF001))
    assert "GreaterThan(value,60.0)" in p
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>", p)


def test_scan_never_moves_data_to_one_partition(spark):
    df = spark.range(0, 2000).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"),
                                     (F.col("id") * 1.0).alias("v"))
    p = _plan(running(df, keys=["k"], order=["t"], value="v", agg="sum", out="s", num_parts=6))
    # the only single-partition exchange allowed is that of the one row of cut points
    for m in re.finditer(r"Exchange SinglePartition", p):
        assert "percentile_approx" in p[m.end():m.end() + 600]
    assert "Join" not in p


def test_pane_form_expands_after_the_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") % 5).cast("string").alias("k"),
                                     F.timestamp_seconds(F.col("id") * 7).cast("timestamp_ntz").alias("ts"))
    p = _plan(windows.pane_counts(df, "ts", "10 minutes", "5 seconds", keys=("k",)))
    exchanges = [m.start() for m in re.finditer(r"Exchange hashpartitioning", p)]
    expand = p.find("Generate explode(sequence(_pe")
    # the 120-fold expansion sits above (after) the last exchange in the tree text
    assert expand != -1 and all(expand < e for e in exchanges)


def test_view_filters_reach_the_scan(spark):
    p = _plan(E.queries()["uv_exact"](spark, SF001))
    assert "EqualTo(event_type,view)" in p
    p = _plan(E.queries()["marketing_total"](spark, SF001))
    assert "EqualTo(event_type,signup)" in p or "Not(EqualTo(event_type,signup))" in p or "In(event_type" in p

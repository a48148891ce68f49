"""Projection, filter, flat-map, routing, union and co-map (#12-#21).

These are one-liners on the DataFrame API; the functions exist so each job of the
event model has a named, tested entry point.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions.scalar import WORD_SPLIT

# Alarm text of the side-output job; the threshold is a parameter
# and is printed into the text.
ALARM_TEXT = "templuter less than {threshold} alarm :"
# Suffixes of the two co-map functions (full-width colon).
CO_MAP_SUFFIX_1 = "：from map1"
CO_MAP_SUFFIX_2 = "：from map2"


def readings_above(sensor: DataFrame, threshold: float = 60.0,
                   cols: tuple[str, ...] = ("id", "ts", "temperature")) -> DataFrame:
    """#12-#14: ``filter(temperature > threshold)`` then ``map`` to a projection.
    Both reach the parquet scan (pushed filter, pruned columns)."""
    return sensor.filter(F.col("temperature") > threshold).select(*cols)


def tokenise(df: DataFrame, text: str = "text", out: str = "word",
             keep: tuple[str, ...] = ()) -> DataFrame:
    """#15 flatMap: one row per non-empty ``\\W+``-separated token. The empty token is
    dropped by a plain filter after the explode (stays in whole-stage codegen,
    unlike a higher-order ``filter`` on the array)."""
    toks = df.select(*keep, F.explode(F.split(F.col(text), WORD_SPLIT)).alias(out))
    return toks.filter(F.col(out) != "")


def map_with_lifecycle(df: DataFrame, schema: str,
                       fn: Callable[[pd.DataFrame, object], pd.DataFrame],
                       open_fn: Callable[[], object] = lambda: None,
                       close_fn: Callable[[object], None] = lambda _: None) -> DataFrame:
    """#16 rich map: ``open_fn`` once per task before the first batch, ``fn`` per
    Arrow batch with the opened resource, ``close_fn`` after the last batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_fn()
        try:
            for pdf in batches:
                yield fn(pdf, resource)
        finally:
            close_fn(resource)

    return df.mapInPandas(run, schema)


def plus_one(df: DataFrame, col: str, out: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The rich-map job: value + 1. The arithmetic needs no resource, so it is an expression (exact longs,
    nulls stay null); :func:`map_with_lifecycle` is for functions that open one."""
    return df.select(*keep, (F.col(col) + 1).alias(out))


def fan_out(df: DataFrame, *transforms: Callable[[DataFrame], DataFrame]) -> list[DataFrame]:
    """#17 one source, several outputs. Batch: each output is its own plan over the
    shared source (Spark reuses the scan within a plan; ``persist`` the source when
    the outputs are written by separate actions)."""
    return [t(df) for t in transforms]


def key_by(df: DataFrame, *keys: str, num_partitions: int | None = None) -> DataFrame:
    """#18 keyBy: hash-partition on the keys (only needed before custom per-partition
    code; groupBy/join insert this exchange themselves)."""
    return df.repartition(num_partitions, *keys) if num_partitions else df.repartition(*keys)


def alarm_split(sensor: DataFrame, threshold: float = 60.0,
                keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """#19 side output by predicate: main passes every row, ``alarms`` carries the
    text for readings below ``threshold`` (plus ``keep`` columns). One pass: the
    alarm is a column, each output is a filter of it."""
    text = F.concat(F.lit(ALARM_TEXT.format(threshold=_num(threshold))), F.col("id"))
    tagged = sensor.withColumn("alarm", F.when(F.col("temperature") < threshold, text))
    return tagged.drop("alarm"), tagged.filter(F.col("alarm").isNotNull()).select(*keep, "alarm")


def _num(x: float) -> str:
    return str(int(x)) if float(x).is_integer() else str(x)


def union_all(*dfs: DataFrame) -> DataFrame:
    """#20 n-ary bag union (UNION ALL, by column name)."""
    return reduce(DataFrame.unionByName, dfs)


def co_map(left: DataFrame, right: DataFrame, left_fn: Callable[[DataFrame], Column],
           right_fn: Callable[[DataFrame], Column], key: tuple[str, str] | None = None,
           out: str = "value") -> DataFrame:
    """#21 connect + CoMap: each side mapped by its own function to one type, then a
    bag union. Keying does not change a stateless co-map, so no exchange is added."""
    lcols = [F.col(key[0]).cast("string").alias("key")] if key else []
    rcols = [F.col(key[1]).cast("string").alias("key")] if key else []
    return (left.select(*lcols, left_fn(left).alias(out))
            .unionByName(right.select(*rcols, right_fn(right).alias(out))))


def suffix_map1(col: str) -> Callable[[DataFrame], Column]:
    return lambda d: F.concat(F.col(col).cast("string"), F.lit(CO_MAP_SUFFIX_1))


def suffix_map2(col: str) -> Callable[[DataFrame], Column]:
    return lambda d: F.concat(F.col(col).cast("string"), F.lit(CO_MAP_SUFFIX_2))

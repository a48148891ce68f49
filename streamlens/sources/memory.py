"""#1 In-memory source: a literal collection becomes a DataFrame.

Only for literal, driver-sized inputs (fixtures, control rows); data at scale is
read with :mod:`streamlens.sources.lines` or ``spark.read``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def from_rows(spark: SparkSession, rows: Iterable[Sequence], schema: StructType | str) -> DataFrame:
    """``fromElements`` / ``fromCollection``: rows in the given order, typed by ``schema``."""
    return spark.createDataFrame(list(rows), schema)

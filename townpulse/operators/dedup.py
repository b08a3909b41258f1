"""Keep one row per key.

The rank filter is applied inside each map task before the shuffle (Spark's window
group limit), so of a hot key only one row per task travels on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _first_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` per key (nulls sort first)."""
    return _first_by(df, keys, [F.col(c).desc_nulls_last() for c in order])


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row with the least ``order`` per key (nulls sort first)."""
    return _first_by(df, keys, [F.col(c).asc_nulls_first() for c in order])

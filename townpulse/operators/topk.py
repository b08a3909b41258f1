"""Counts, shares and top lists; null keys are left out and ties go to the smaller key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: list[str] | str, name: str = "n") -> DataFrame:
    keys = [keys] if isinstance(keys, str) else keys
    return df.na.drop(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def top_values(df: DataFrame, key: str, n: int, name: str = "n") -> DataFrame:
    return value_counts(df, key, name).orderBy(F.desc(name), key).limit(n)


def n_largest(df: DataFrame, n: int, col: str, tie: str) -> DataFrame:
    return df.orderBy(F.desc(col), tie).limit(n)


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    return F.round(part / whole * F.lit(100.0), digits)


def row_total(df: DataFrame) -> Column:
    """Number of rows as a scalar subquery."""
    return df.agg(F.count(F.lit(1)).cast("double").alias("total")).scalar()


def top_share_of_all(df: DataFrame, key: str, n: int) -> DataFrame:
    """Top ``n`` values with their percentage of all rows (null keys count in the total)."""
    return top_values(df, key, n).withColumn("pct", percent(F.col("n"), row_total(df)))


def share_of_shown(counts: DataFrame, digits: int = 2) -> DataFrame:
    """Percentage of the rows shown; ``counts`` must be a report of bounded size."""
    total = counts.agg(F.sum("n").cast("double").alias("total")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total, digits))


def top_per_group(counts: DataFrame, group: list[str], order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows per group; Spark cuts each group to ``k`` rows before the shuffle."""
    w = Window.partitionBy(*group).orderBy(*order)
    return counts.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k).drop("_rank")

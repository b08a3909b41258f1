"""Joins that stay balanced when one key holds much of the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 16


def salted_lookup(
    rows: DataFrame, lookup: DataFrame, keys: list[str], salt_by: list[str], how: str = "left", salts: int = SALTS
) -> DataFrame:
    """Join ``rows`` to a table with one row per key.

    Rows of one key spread over ``salts`` partitions by a hash of ``salt_by``; the
    lookup is repeated per salt. The hash depends on the row alone, so a retried task
    sends each row to the same place. Adaptive execution still broadcasts a small lookup.
    """
    salt = F.pmod(F.xxhash64(*salt_by), F.lit(salts)).cast("int")
    left = rows.withColumn("_salt", salt)
    right = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def count_per_key(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Row counts of the keys without nulls."""
    return rows.na.drop(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def with_group_count(
    rows: DataFrame, keys: list[str], name: str, salt_by: list[str], default: int | None = None
) -> DataFrame:
    """Attach to every row the number of rows of its key; null keys get ``default``."""
    joined = salted_lookup(rows, count_per_key(rows, keys, name), keys, salt_by)
    if default is not None:
        joined = joined.withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    return joined.select(*rows.columns, name)


def in_top_keys(df: DataFrame, top: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in ``top``, a top-n list and so of bounded size and unique.

    An inner join, as the optimizer would push a semi join below earlier aggregations and
    so stop their results from being shared.
    """
    return df.join(F.broadcast(top.select(key)), key).select(*df.columns)


def actual_vs_predicted(actual: DataFrame, predicted: DataFrame, on: str = "date") -> DataFrame:
    return actual.join(predicted, on, "inner")


def flag_members(df: DataFrame, members: DataFrame, key: str, name: str, salt_by: list[str]) -> DataFrame:
    """1 where the row's key is among ``members``, else 0."""
    marked = members.select(key).distinct().withColumn(name, F.lit(1))
    joined = salted_lookup(df, marked, [key], salt_by)
    return joined.select(*df.columns, F.coalesce(F.col(name), F.lit(0)).alias(name))

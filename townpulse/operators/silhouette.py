"""Exact silhouette of a one-dimensional score split into two groups.

Distances along a line follow from running counts and sums of the sorted values, so
the work is one sort by ranges instead of all pairs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.operators.quantiles import running_totals
from townpulse.session import cut_lineage


def score_separation(df: DataFrame, score: str, flag: str) -> DataFrame:
    """One row (silhouette): 0 unless both groups (flag 0 and 1) have two rows or more."""
    in_a, in_b = F.col(flag) == 0, F.col(flag) == 1
    values = df.filter(F.col(score).isNotNull() & (in_a | in_b)).groupBy(F.col(score).cast("double").alias("v")).agg(
        F.count_if(in_a).alias("na"), F.count_if(in_b).alias("nb")
    )
    values = cut_lineage(values)
    sums = {"ca": F.col("na"), "cb": F.col("nb"), "sa": F.col("na") * F.col("v"), "sb": F.col("nb") * F.col("v")}
    upto = running_totals(values, "v", sums)
    total = values.agg(F.struct(*[F.sum(c).alias(k) for k, c in sums.items()]).alias("t")).scalar()
    rows = upto.withColumn("t", total)

    def distance(count: str, total_: str):
        c, s, v = F.col(count), F.col(total_), F.col("v")
        return v * c - s + (F.col(f"t.{total_}") - s) - v * (F.col(f"t.{count}") - c)

    rows = rows.withColumns({"da": distance("ca", "sa"), "db": distance("cb", "sb")})

    def width(own: str, own_n: str, other: str, other_n: str):
        a = F.col(own) / F.nullif(F.col(f"t.{own_n}") - 1, F.lit(0))
        b = F.col(other) / F.nullif(F.col(f"t.{other_n}"), F.lit(0))
        top = F.greatest(a, b)
        return F.when(top > 0, (b - a) / top).otherwise(0.0)

    mean = F.sum(F.col("na") * width("da", "ca", "db", "cb") + F.col("nb") * width("db", "cb", "da", "ca")) / F.sum(F.col("na") + F.col("nb"))
    enough = (F.min("t.ca") >= 2) & (F.min("t.cb") >= 2)
    return rows.agg(F.when(enough, mean).otherwise(0.0).alias("silhouette"))

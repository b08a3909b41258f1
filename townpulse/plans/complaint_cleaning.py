"""From raw complaint records to the cleaned table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpulse.constants import NO_COMMENT, NO_ORGANIZATION, NO_TYPE
from townpulse.functions.categories import decode_star, decode_state, with_types
from townpulse.functions.geo import split_coords
from townpulse.functions.times import elapsed_days, with_time_parts
from townpulse.operators.cleaning import (
    drop_columns,
    drop_null_rows,
    fill_missing,
    in_bangkok,
    keep_reopen_range,
    keep_solve_days,
    parse_or_drop,
)
from townpulse.operators.dedup import keep_last
from townpulse.operators.sampling import sample_rows
from townpulse.session import stage


def prepare_complaints(raw: DataFrame, order: list[str]) -> DataFrame:
    """Everything up to solve_days; ``order`` decides which record of a ticket is last."""
    df = keep_last(raw, ["ticket_id"], order)
    df = drop_null_rows(in_bangkok(df), ["district", "subdistrict"])
    df = drop_columns(df, ["photo", "photo_after", *order], ignore_missing=True)
    df = fill_missing(df, ["comment", "organization", "type"], [NO_COMMENT, NO_ORGANIZATION, NO_TYPE])
    lon, lat = split_coords(F.col("coords"))
    df = df.withColumns({"lon": lon, "lat": lat})
    df = parse_or_drop(parse_or_drop(df, "timestamp"), "last_activity")
    return df.withColumn("solve_days", elapsed_days(F.col("timestamp"), F.col("last_activity")))


def clean_complaints(raw: DataFrame, order: list[str]) -> DataFrame:
    """Full cleaning: preparation, outlier limits, types and time parts.

    State and star stay single columns instead of one-hot columns. The prepared rows are
    staged, as the fence of solve_days needs all of them before the first can pass.
    """
    df = keep_reopen_range(keep_solve_days(stage(prepare_complaints(raw, order), "complaints")))
    return with_time_parts(with_types(df)).withColumnRenamed("star", "star_rating")


def load_complaints(df: DataFrame, sample: int | None = None, key: str = "ticket_id") -> DataFrame:
    """Cleaned records (with one-hot state and star) as the reports use them."""
    if sample is not None:
        df = sample_rows(df, sample, key)
    df = with_types(df).withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    df = df.withColumn("state", decode_state(df)).withColumn("star_rating", decode_star(df))
    return drop_null_rows(with_time_parts(df), ["lat", "lon", "timestamp"])


def describe_counts(df: DataFrame, col: str, bound: float | Column) -> DataFrame:
    """Mean, quartiles, count of values, and how many exceed ``bound``.

    For columns with few distinct values, see ``upper_fence``.
    """
    q = F.percentile(col, F.array(F.lit(0.25), F.lit(0.75)))
    return df.agg(
        F.avg(col).alias("mean"), q[0].alias("q1"), q[1].alias("q3"),
        F.count(col).alias("n_values"), F.count_if(F.col(col) > bound).alias("n_over"),
    )

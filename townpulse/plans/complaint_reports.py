"""Descriptive tables over cleaned complaints."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.constants import COMPLETED_STATE, WEEKDAY_NAMES_TH
from townpulse.functions.geo import grid_cell
from townpulse.functions.times import month_label
from townpulse.operators.cleaning import between_dates, equals_or_all, keep_up_to_percentile
from townpulse.operators.joins import in_top_keys
from townpulse.operators.topk import (
    n_largest,
    percent,
    row_total,
    share_of_shown,
    top_per_group,
    top_share_of_all,
    top_values,
    value_counts,
)

DEFAULT_START = date(2024, 10, 1)


def filter_complaints(
    df: DataFrame, start: date | None = DEFAULT_START, end: date | None = None, district: str = "All", kind: str = "All"
) -> DataFrame:
    """The report filters: days (both included), district, type."""
    return equals_or_all(equals_or_all(between_dates(df, start, end), "district", district), "primary_type", kind)


def date_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.to_date(F.min("timestamp")).alias("min_date"), F.to_date(F.max("timestamp")).alias("max_date"))


def top_districts(df: DataFrame, n: int = 20) -> DataFrame:
    return top_share_of_all(df, "district", n)


def top_types(df: DataFrame, n: int = 20) -> DataFrame:
    return top_share_of_all(df, "primary_type", n)


def type_shares(df: DataFrame, n: int = 10) -> DataFrame:
    """Top types with their share of the shown ones."""
    return share_of_shown(top_values(df, "primary_type", n))


def _pair_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("district", "primary_type").agg(F.count(F.lit(1)).alias("n"))


def _top_of(pairs: DataFrame, key: str, n: int) -> DataFrame:
    """Top keys by complaints, from the pair counts, so that complaints are counted once."""
    totals = pairs.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum("n").alias("_n"))
    return totals.orderBy(F.desc("_n"), key).limit(n)


def types_by_district(df: DataFrame, kind: str = "All", districts: int = 15, types: int = 10) -> DataFrame:
    """Counts in the top districts, for the types most frequent within those districts."""
    pairs = _pair_counts(equals_or_all(df, "primary_type", kind))
    inside = in_top_keys(pairs, _top_of(pairs, "district", districts), "district")
    return in_top_keys(inside, _top_of(inside, "primary_type", types), "primary_type")


def districts_by_type(df: DataFrame, district: str = "All", types: int = 10, per_type: int = 10) -> DataFrame:
    """For the top types, the districts with most complaints of each."""
    pairs = _pair_counts(equals_or_all(df, "district", district))
    shown = in_top_keys(pairs, _top_of(pairs, "primary_type", types), "primary_type").filter(F.col("district").isNotNull())
    return top_per_group(shown, ["primary_type"], [F.desc("n"), F.col("district")], per_type)


def month_counts(df: DataFrame) -> DataFrame:
    return df.filter(F.col("district").isNotNull()).groupBy(
        "district", month_label(F.col("timestamp")).alias("month")
    ).agg(F.count(F.lit(1)).alias("n"))


def month_heatmap(df: DataFrame, districts: int = 20, months: int = 12) -> DataFrame:
    """Long form (district, month, n), zero-filled: top districts of the last month, last months."""
    counts = month_counts(df)
    shown = counts.select("month").distinct().orderBy(F.desc("month")).limit(months)
    newest = counts.agg(F.max("month").alias("m")).scalar()
    totals = counts.groupBy("district").agg(F.sum(F.when(F.col("month") == newest, F.col("n")).otherwise(0)).alias("last"))
    top = n_largest(totals, districts, "last", "district").select("district")
    # a report grid: at most districts x months cells
    cells = top.withColumn("month", F.explode(shown.agg(F.collect_list("month").alias("m")).scalar()))
    return cells.join(counts, ["district", "month"], "left").withColumn("n", F.coalesce("n", F.lit(0)))


def month_pivot(df: DataFrame, months: list[str]) -> DataFrame:
    """Wide form for given months: one column per month, zero where there is no complaint."""
    counts = month_counts(df)
    return counts.groupBy("district").pivot("month", months).agg(F.sum("n")).na.fill(0)


def resolution_times(df: DataFrame, n: int = 15) -> DataFrame:
    """Box statistics of solve_days in the top districts, after the 99th percentile cut.

    Day counts per (district, days) are reduced first; quantiles then run on those.
    """
    shown = in_top_keys(df, top_values(df, "district", n), "district")
    kept = keep_up_to_percentile(shown, "solve_days", 0.99)
    days = kept.groupBy("district", "solve_days").agg(F.count(F.lit(1)).alias("k"))
    q = [F.percentile("solve_days", F.lit(p), F.col("k")) for p in (0.25, 0.5, 0.75)]
    boxes = days.groupBy("district").agg(
        F.sum("k").alias("n"), F.min("solve_days").alias("lowest"), q[0].alias("q1"), q[1].alias("median"),
        q[2].alias("q3"), F.max("solve_days").alias("highest"),
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("solve_days").between(F.col("q1") - reach, F.col("q3") + reach)
    whiskers = days.join(F.broadcast(boxes), "district").filter(inside).groupBy("district").agg(
        F.min("solve_days").alias("whisker_low"), F.max("solve_days").alias("whisker_high")
    )
    return boxes.join(F.broadcast(whiskers), "district")


def daily_by_district(df: DataFrame, districts: list[str] | None = None, top: int = 5) -> DataFrame:
    """Counts per day for the chosen districts, by default the top ones."""
    dated = df.withColumn("date", F.to_date("timestamp"))
    if districts:
        dated = dated.filter(F.col("district").isin(districts))
    else:
        dated = in_top_keys(dated, top_values(df, "district", top), "district")
    return value_counts(dated, ["date", "district"])


def hourly(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    return value_counts(df.select(F.hour(ts).alias("hour")), "hour")


def by_weekday(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Seven rows, Monday first; a day without complaints shows 0."""
    tests = [F.count_if(F.weekday(ts) == i).alias(str(i)) for i in range(7)]
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES_TH])
    days = df.agg(*tests).select(F.posexplode(F.array(*[F.col(str(i)) for i in range(7)])).alias("day_of_week", "n"))
    return days.withColumn("day_name", F.get(names, F.col("day_of_week")))


def state_shares(df: DataFrame) -> DataFrame:
    return share_of_shown(value_counts(df, "state"))


def timeline(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Counts per day and, where the column exists, province."""
    dated = df.withColumn("date", F.to_date(ts))
    return value_counts(dated, ["date", "province"] if "province" in df.columns else ["date"])


def key_figures(df: DataFrame, everything: DataFrame, completed: str = COMPLETED_STATE) -> DataFrame:
    """Rows, difference to the unfiltered table, mean days, completion, distinct places and types."""
    rows = F.count(F.lit(1))
    return df.agg(
        rows.alias("n_rows"),
        F.avg("solve_days").alias("mean_solve_days"),
        (F.avg(F.coalesce(F.col("state") == completed, F.lit(False)).cast("double")) * 100).alias("completion_pct"),
        F.countDistinct("district").alias("n_districts"),
        F.countDistinct("primary_type").alias("n_types"),
    ).withColumn("delta_rows", F.col("n_rows") - row_total(everything).cast("bigint"))


def district_figures(df: DataFrame) -> DataFrame:
    """Located complaints and mean days per district, most complaints first."""
    return df.filter(F.col("district").isNotNull()).groupBy("district").agg(
        F.count("lat").alias("n"), F.round(F.avg("solve_days"), 2).alias("mean_solve_days")
    ).orderBy(F.desc("n"), "district")


def solve_day_summary(df: DataFrame) -> DataFrame:
    return df.agg(
        F.avg("solve_days").alias("mean"), F.percentile("solve_days", F.lit(0.5)).alias("median"),
        F.max("solve_days").alias("highest"), F.greatest(F.lit(0), F.min("solve_days")).alias("lowest"),
    )


def choices(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values for a filter list."""
    return df.select(col).filter(F.col(col).isNotNull()).distinct().orderBy(col)


def density(df: DataFrame, metres: float = 100.0) -> DataFrame:
    """Complaints per grid cell with the cell's mean position and its share of the fullest cell."""
    row, col = grid_cell(F.col("lat"), F.col("lon"), metres)
    cells = df.filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).groupBy(
        row.alias("cell_row"), col.alias("cell_col")
    ).agg(F.count(F.lit(1)).alias("n"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    most = cells.agg(F.max("n").cast("double").alias("m")).scalar()
    return cells.withColumn("weight", F.col("n") / most)


def map_points(df: DataFrame, n: int, key: str = "ticket_id") -> DataFrame:
    """The first ``n`` complaints by id, with the text shown for each."""
    label = F.concat_ws(
        " | ", "district", "primary_type", F.date_format("timestamp", "yyyy-MM-dd"), "state",
        F.col("solve_days").cast("string"),
    )
    return df.orderBy(key).limit(n).select(key, "lat", "lon", label.alias("label"))


def type_percent_in(df: DataFrame, district: str) -> DataFrame:
    """Types of one district with their share of its complaints."""
    chosen = equals_or_all(df, "district", district)
    return value_counts(chosen, "primary_type").withColumn("pct", percent(F.col("n"), row_total(chosen)))

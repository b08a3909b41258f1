"""Daily series: counting, gap filling, rolling features, windows for training.

Windows run per series. A series has one row per day, so its size is bounded by the
calendar and not by the number of complaints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townpulse.constants import FORECAST_HORIZON, LOOKBACK_DAYS, SERIES_FEATURES
from townpulse.functions.times import is_weekend, weekday_number


def daily_counts(df: DataFrame, ts: str = "timestamp", by: list[str] = (), weight: str = "complaint_count") -> DataFrame:
    """Rows per day, or the sum of ``weight`` where that column exists."""
    value = F.sum(weight) if weight in df.columns else F.count(F.lit(1))
    dated = df.select(*by, F.to_date(ts).alias("date"), *([weight] if weight in df.columns else []))
    return dated.filter(F.col("date").isNotNull()).groupBy(*by, "date").agg(value.alias("complaint_count"))


def calendar(daily: DataFrame, by: list[str] = ()) -> DataFrame:
    """One row per day from the first to the last date (per series)."""
    ends = daily.groupBy(*by).agg(F.min("date").alias("a"), F.max("date").alias("b"))
    ends = ends.filter(F.col("a").isNotNull())
    return ends.select(*by, F.explode(F.sequence("a", "b")).alias("date"))


def fill_gaps(daily: DataFrame, by: list[str] = (), value: str = "complaint_count") -> DataFrame:
    return calendar(daily, by).join(daily, [*by, "date"], "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(0))
    )


def _by_date(by: list[str]):
    return Window.partitionBy(*by).orderBy("date")


def trailing_mean(col: str, days: int, by: list[str] = ()) -> Column:
    return F.avg(col).over(_by_date(by).rowsBetween(1 - days, 0))


def trailing_std(col: str, days: int, by: list[str] = ()) -> Column:
    """Sample deviation, 0 for the first row."""
    return F.coalesce(F.stddev_samp(col).over(_by_date(by).rowsBetween(1 - days, 0)), F.lit(0.0))


def previous_mean(col: str, days: int = 7, by: list[str] = ()) -> Column:
    """Mean of up to ``days`` days before this one."""
    return F.avg(col).over(_by_date(by).rowsBetween(-days, -1))


def centred(col: str, window: int, by: list[str] = ()) -> tuple[Column, Column]:
    """Mean and sample deviation of a full window around the day, else null."""
    w = _by_date(by).rowsBetween(-(window // 2), (window - 1) // 2)
    full = F.count(col).over(w) == window
    return F.when(full, F.avg(col).over(w)), F.when(full, F.stddev_samp(col).over(w))


def with_features(daily: DataFrame, by: list[str] = ()) -> DataFrame:
    """Calendar and rolling features of a gap-filled daily series."""
    day = weekday_number(F.col("date"))
    y = "complaint_count"
    return daily.select(
        *by, "date", y,
        day.alias("dayofweek"),
        F.month("date").alias("month"),
        is_weekend(day).alias("is_weekend"),
        trailing_mean(y, 7, by).alias("roll_mean_7"),
        trailing_std(y, 7, by).alias("roll_std_7"),
        trailing_mean(y, 30, by).alias("roll_mean_30"),
    )


def prepare_series(df: DataFrame, ts: str = "timestamp", by: list[str] = ()) -> DataFrame:
    return with_features(fill_gaps(daily_counts(df, ts, by), by), by)


def look_back(features: DataFrame, lookback: int = LOOKBACK_DAYS, by: list[str] = ()) -> DataFrame:
    """Add ``x``, the features of the last ``lookback`` days row by row; drop shorter histories."""
    w = _by_date(by).rowsBetween(1 - lookback, 0)
    day = F.array(*[F.col(c).cast("double") for c in SERIES_FEATURES])
    return features.withColumn("_days", F.collect_list(day).over(w)).filter(
        F.size("_days") == lookback
    ).withColumn("x", F.flatten("_days")).drop("_days")


def sequences(
    features: DataFrame, lookback: int = LOOKBACK_DAYS, horizon: int = FORECAST_HORIZON, by: list[str] = ()
) -> DataFrame:
    """One row per origin day with its window ``x`` and the next ``horizon`` values ``y``."""
    ahead = F.array(*[F.lead("complaint_count", h).over(_by_date(by)).cast("double") for h in range(1, horizon + 1)])
    targets = features.withColumn("y", ahead)
    windows = look_back(targets, lookback, by).filter(F.get("y", F.lit(horizon - 1)).isNotNull())
    return windows.select(*by, F.col("date").alias("origin"), "x", "y")


def ordered_split(seqs: DataFrame, train: float = 0.8, val: float = 0.1, by: list[str] = ()) -> DataFrame:
    """Add ``split``: the first share is ``train``, the next ``val``, the rest ``test``."""
    w = Window.partitionBy(*by)
    i = F.row_number().over(w.orderBy("origin")) - 1
    n = F.count(F.lit(1)).over(w)
    n_train, n_val = F.floor(n * train), F.floor(n * val)
    return seqs.withColumn(
        "split", F.when(i < n_train, "train").when(i < n_train + n_val, "val").otherwise("test")
    )


def last_days(daily: DataFrame, days: int, by: list[str] = (), drop_last: bool = False) -> DataFrame:
    """The last ``days`` rows of each series, without the very last (unfinished) day if asked."""
    newest = Window.partitionBy(*by).orderBy(F.desc("date"))
    ranked = daily.withColumn("_age", F.row_number().over(newest)).filter(F.col("_age") <= days)
    if drop_last:
        size = F.count(F.lit(1)).over(Window.partitionBy(*by))
        ranked = ranked.withColumn("_n", size).filter((F.col("_age") > 1) | (F.col("_n") == 1)).drop("_n")
    return ranked.drop("_age")


def baselines(seqs: DataFrame, horizon: int = FORECAST_HORIZON, by: list[str] = ()) -> DataFrame:
    """Naive and 7-day-mean predictions of every origin and horizon, in long form."""
    n_features = len(SERIES_FEATURES)
    lookback = F.size("x") / n_features
    history = F.transform(
        F.sequence(F.lit(0), (lookback - 1).cast("int")), lambda i: F.get(F.col("x"), i * n_features)
    )
    recent = F.slice("history", F.greatest(F.size("history") - 6, F.lit(1)), F.lit(7))
    total = F.aggregate(recent, F.lit(0.0), lambda acc, v: acc + v)
    flat = seqs.withColumn("history", history).select(
        *by, "origin", "y", F.element_at("history", -1).alias("naive"), (total / F.size(recent)).alias("ma7")
    )
    long = flat.select(*by, "origin", "naive", "ma7", F.posexplode("y").alias("_h", "actual"))
    return long.select(
        *by, "origin", (F.col("_h") + 1).alias("horizon"), "actual",
        F.explode(F.create_map(F.lit("naive"), F.col("naive"), F.lit("ma7"), F.col("ma7"))).alias("model", "predicted"),
    )

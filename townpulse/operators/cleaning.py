"""Row filters, fills and column edits used by the cleaning jobs."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpulse.constants import BANGKOK_PATTERN, EMPTY_FILL
from townpulse.functions.times import parse_timestamp
from townpulse.operators.quantiles import column_quantiles
from townpulse.schemas import numeric_columns, require_columns


def all_known(cols: list[str]) -> Column:
    """True where no column is null or the word ``unknown``."""
    tests = [
        F.col(c).isNotNull() & (F.lower(F.trim(F.col(c).cast("string"))) != "unknown") for c in cols
    ]
    return reduce(Column.__and__, tests)


def drop_unknown(df: DataFrame, cols: list[str]) -> DataFrame:
    return require_columns(df, cols).filter(all_known(cols))


def in_bangkok(df: DataFrame, col: str = "province") -> DataFrame:
    """Rows whose province names Bangkok in Thai or English; null counts as no."""
    return df.filter(F.coalesce(F.col(col).rlike(BANGKOK_PATTERN), F.lit(False)))


def drop_null_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return require_columns(df, cols).na.drop(subset=cols)


def drop_columns(df: DataFrame, cols: list[str], ignore_missing: bool = False) -> DataFrame:
    if not ignore_missing:
        missing = [c for c in cols if c not in df.columns]
        if missing:
            raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def fill_missing(df: DataFrame, cols: list[str], fills: list) -> DataFrame:
    """Fill each column's nulls with its paired value; absent columns are skipped."""
    if len(cols) != len(fills):
        raise ValueError("cols and fills must have the same length")
    values = {c: EMPTY_FILL if f is None or f == {} else f for c, f in zip(cols, fills) if c in df.columns}
    return df.na.fill(values) if values else df


def parse_or_drop(df: DataFrame, col: str, pattern: str | None = None) -> DataFrame:
    """Parse a text column as timestamp and drop the rows that do not parse."""
    parsed = parse_timestamp(F.col(col), *([pattern] if pattern else []))
    return df.withColumn(col, parsed).filter(F.col(col).isNotNull())


def between_dates(df: DataFrame, start: date | None, end: date | None, ts: str = "timestamp") -> DataFrame:
    """Rows from ``start`` to ``end``, both days included, as a range the scan can use."""
    if start is not None:
        df = df.filter(F.col(ts) >= F.lit(start).cast("timestamp"))
    if end is not None:
        df = df.filter(F.col(ts) < F.date_add(F.lit(end), 1).cast("timestamp"))
    return df


def equals_or_all(df: DataFrame, col: str, value: str = "All") -> DataFrame:
    return df if value == "All" else df.filter(F.col(col) == value)


def iqr_bounds(df: DataFrame, cols: list[str], factor: float) -> dict[str, tuple[float, float]]:
    """Lower and upper fence per column that has values."""
    quartiles = column_quantiles(df, cols, [0.25, 0.75]) if cols else {}
    return {c: (a - factor * (b - a), b + factor * (b - a)) for c, (a, b) in quartiles.items() if a is not None}


def _numeric_among(df: DataFrame, cols: list[str] | None) -> list[str]:
    numeric = numeric_columns(df)
    if cols is None:
        return numeric
    require_columns(df, cols)
    return [c for c in cols if c in numeric]


def cap_outliers(df: DataFrame, cols: list[str] | None = None, factor: float = 1.5) -> DataFrame:
    """Clip every (numeric) column to its IQR fences; nulls stay null."""
    capped = {}
    for c, (low, high) in iqr_bounds(df, _numeric_among(df, cols), factor).items():
        x = F.col(c).cast("double")
        capped[c] = F.when(x.isNotNull(), F.least(F.greatest(x, F.lit(low)), F.lit(high)))
    return df.withColumns(capped) if capped else df


def remove_outliers(df: DataFrame, cols: list[str] | None = None, factor: float = 1.5) -> DataFrame:
    """Keep rows inside the IQR fences, column after column.

    The fences of a column come from the rows that survived the columns before it.
    """
    for c in _numeric_among(df, cols):
        bounds = iqr_bounds(df, [c], factor).get(c)
        df = df.filter(F.lit(False)) if bounds is None else df.filter(F.col(c).between(*bounds))
    return df


def upper_fence(df: DataFrame, col: str, factor: float = 2.0) -> Column:
    """``Q3 + factor * IQR`` as a scalar subquery.

    For columns with few distinct values (days, counts): the aggregate keeps one
    counter per value, and partial counts merge before the exchange.
    """
    q = F.percentile(col, F.array(F.lit(0.25), F.lit(0.75)))
    return df.agg((q[1] + factor * (q[1] - q[0])).alias("upper")).scalar()


def keep_solve_days(df: DataFrame, col: str = "solve_days", factor: float = 2.0) -> DataFrame:
    """Keep ``0 <= col <= Q3 + factor * IQR``."""
    return df.filter((F.col(col) >= 0) & (F.col(col) <= upper_fence(df, col, factor)))


def keep_reopen_range(df: DataFrame, col: str = "count_reopen", low: int = 0, high: int = 2) -> DataFrame:
    return df.filter(F.col(col).between(low, high))


def nonzero_profile(df: DataFrame, col: str) -> DataFrame:
    """Count and mean of the values other than zero."""
    nonzero = F.when(F.col(col) != 0, F.col(col))
    return df.agg(F.count(nonzero).alias("n_nonzero"), F.avg(nonzero).alias("mean_nonzero"))


def keep_up_to_percentile(df: DataFrame, col: str, p: float = 0.99) -> DataFrame:
    """Rows at or below the exact percentile of a column with few distinct values."""
    cut = df.agg(F.percentile(col, F.lit(p)).alias("cut")).scalar()
    return df.filter(F.col(col) <= cut)


def cohort(day: Column, as_of: date, lag_days: int = 5) -> Column:
    """``history`` before the weather cut-off, ``recent`` up to ``as_of``, null for the future."""
    cutoff = F.date_sub(F.lit(as_of), lag_days)
    return F.when(day < cutoff, "history").when(day <= F.lit(as_of), "recent")


def split_cohorts(df: DataFrame, as_of: date, col: str = "outage_date", lag_days: int = 5) -> DataFrame:
    """History and recent rows with their cohort; future rows are dropped."""
    return df.withColumn("cohort", cohort(F.col(col), as_of, lag_days)).filter(F.col("cohort").isNotNull())


def align_features(df: DataFrame, features: list[str], keep: list[str] = ()) -> DataFrame:
    """``keep`` and exactly ``features`` in order, absent ones as 0."""
    return df.select(
        *keep, *[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in features]
    )


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)

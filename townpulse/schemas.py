"""Declared schemas, as DDL text; nothing is inferred at read."""

from pyspark.sql import DataFrame
from pyspark.sql import types as T

COMPLAINTS_RAW = (
    "ticket_id STRING, type STRING, organization STRING, comment STRING, photo STRING, "
    "photo_after STRING, coords STRING, address STRING, subdistrict STRING, district STRING, "
    "province STRING, timestamp STRING, last_activity STRING, state STRING, star DOUBLE, "
    "count_reopen INT"
)

OUTAGES_RAW = (
    "date DATE, day_of_week STRING, start STRING, end STRING, name STRING, location STRING, "
    "district STRING, province STRING, temp DOUBLE, rain DOUBLE, wind_gust DOUBLE"
)

OUTAGES_CLEAN = (
    "date DATE, day_of_week STRING, start STRING, end STRING, name STRING, district STRING, "
    "province STRING, temp DOUBLE, rain DOUBLE, wind_gust DOUBLE, time_range STRING, "
    "duration_minutes DOUBLE"
)

OUTAGE_NOTICES = (
    "source STRING, announcement_url STRING, day_of_week STRING, outage_date DATE, "
    "outage_data STRING"
)

WEATHER_HOURLY = (
    "district STRING, ts TIMESTAMP, temp DOUBLE, rain DOUBLE, wind_gust DOUBLE"
)


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Raise ValueError naming every column of ``cols`` that ``df`` lacks."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the numeric columns, in schema order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def numeric_only(df: DataFrame) -> DataFrame:
    return df.select(*numeric_columns(df))

"""Column expressions over times, dates and timestamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS[XXX][X]"


def clock_minutes(col: Column) -> Column:
    """Minutes since midnight of strict ``HH:mm`` text; null where it is no such time."""
    return F.when(
        col.rlike("^([01][0-9]|2[0-3]):[0-5][0-9]$"),
        F.substring(col, 1, 2).cast("int") * 60 + F.substring(col, 4, 2).cast("int"),
    )


def time_range(start: Column, end: Column) -> Column:
    """``HH:mm - HH:mm`` of two clock texts, null where either is bad."""
    return F.when(
        clock_minutes(start).isNotNull() & clock_minutes(end).isNotNull(), F.concat(start, F.lit(" - "), end)
    )


def minutes_between(start: Column, end: Column) -> Column:
    return (clock_minutes(end) - clock_minutes(start)).cast("double")


def minute_of_day(text: Column) -> Column:
    """``H:MM`` as minutes since midnight."""
    parts = F.split(text, ":")
    return (F.get(parts, F.lit(0)).try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int"))


def wrapped_duration(start_min: Column, end_min: Column) -> Column:
    """Minutes from start to end, taking an earlier end to be on the next day."""
    span = end_min - start_min
    return F.when(span < 0, span + 1440).otherwise(span)


def at_time(date: Column, text: Column) -> Column:
    """Date and clock text as one timestamp, null when either is bad."""
    return F.try_to_timestamp(
        F.concat_ws(" ", F.date_format(date, "yyyy-MM-dd"), F.coalesce(text, F.lit(""))),
        F.lit("yyyy-MM-dd H:mm"),
    )


def parse_timestamp(col: Column, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Timestamp text with any offset form and three or six fraction digits; null if bad."""
    return F.try_to_timestamp(col, F.lit(pattern))


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded towards the past."""
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / F.lit(DAY_MICROS)).cast("bigint")


def weekday_number(col: Column) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(col)


def is_weekend(weekday: Column) -> Column:
    return weekday.isin(5, 6).cast("int")


def weekday_name(date: Column) -> Column:
    return F.date_format(date, "EEEE")


def iso_date(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def with_time_parts(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add year, month, day_of_week (Monday = 0) and hour."""
    return df.withColumns({
        "year": F.year(ts),
        "month": F.month(ts),
        "day_of_week": weekday_number(F.col(ts)),
        "hour": F.hour(ts),
    })


def date_from_words(month: Column, day: Column, year: Column) -> Column:
    """Month word, day and year as a date; null for an unknown month or an illegal date."""
    from townpulse.constants import MONTH_PREFIXES

    number = F.array_position(
        F.array(*[F.lit(m) for m in MONTH_PREFIXES]), F.lower(F.substring(month, 1, 3))
    )
    from townpulse.functions.text import ascii_digits

    text = F.format_string("%04d-%02d-%02d", ascii_digits(year).try_cast("int"), number, ascii_digits(day).try_cast("int"))
    return F.when(number > 0, text.try_cast("date"))

"""From extracted outage events to the cleaned outage table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.constants import OUTAGE_COLUMNS, OUTAGE_REQUIRED
from townpulse.functions.times import clock_minutes, minutes_between, time_range
from townpulse.operators.cleaning import drop_unknown


def with_valid_times(df: DataFrame) -> DataFrame:
    """Add time_range and duration_minutes; drop bad clocks and ends before starts."""
    start, end = F.col("start"), F.col("end")
    valid = clock_minutes(end) >= clock_minutes(start)
    return df.filter(valid).withColumns({
        "time_range": time_range(start, end), "duration_minutes": minutes_between(start, end),
    })


def clean_outages(df: DataFrame, province: str = "bangkok", keep: list[str] = ()) -> DataFrame:
    """Known values, valid times, one province (compared in lower case, not trimmed)."""
    known = with_valid_times(drop_unknown(df, OUTAGE_REQUIRED))
    return known.filter(F.lower("province") == province).select(*keep, *OUTAGE_COLUMNS)


def load_outages(df: DataFrame) -> DataFrame:
    """Outages with ``date`` as a date, null where it does not parse."""
    return df.withColumn("date", F.col("date").try_cast("date"))

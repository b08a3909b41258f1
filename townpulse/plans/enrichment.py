"""Districts, coordinates and weather for outage events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.functions.geo import district_coords, district_from_location
from townpulse.operators.joins import salted_lookup

LOCAL_ZONE = "Asia/Bangkok"


def with_district(events: DataFrame, location: str = "location", extracted: str = "district") -> DataFrame:
    """Add weather_district and its coordinates."""
    located = events.withColumn("weather_district", district_from_location(F.col(location), F.col(extracted)))
    point = district_coords(F.col("weather_district"))
    return located.withColumn("_p", point).withColumns({"lat": F.col("_p.lat"), "lon": F.col("_p.lon")}).drop("_p")


def weather_daily(hourly: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Hottest reading, rain total and strongest gust per district and local day."""
    day = F.to_date(F.from_utc_timestamp("ts", zone))
    return hourly.groupBy("district", day.alias("date")).agg(
        F.max("temp").alias("temp"), F.sum("rain").alias("rain"), F.max("wind_gust").alias("wind_gust")
    )


def add_weather(events: DataFrame, daily: DataFrame, as_of: date, key: str, district: str = "district", lag_days: int = 5) -> DataFrame:
    """Left join on (district, date); events within ``lag_days`` of ``as_of`` get no weather."""
    measures = ["temp", "rain", "wind_gust"]
    lookup = daily.select(F.col("district").alias(district), "date", *measures)
    lookup = lookup.filter(F.col("date") < F.date_sub(F.lit(as_of), lag_days))
    rest = events.drop(*measures)
    return salted_lookup(rest, lookup, [district, "date"], [key]).select(*rest.columns, *measures)

"""Districts, coordinates and weather of outage events."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.bindings import OUTAGES, WEATHER, outages, table, weather_hourly
from catalog.registry import query
from townpulse.constants import AREA_TO_DISTRICT, DISTRICT_COORDS
from townpulse.functions import geo
from townpulse.functions.places import PlaceIndex
from townpulse.plans import enrichment, notices

_AREAS = "areas(prio, place, known) AS (VALUES " + ", ".join(
    f"({i}, '{p}', '{d}')" for i, (p, d) in enumerate(AREA_TO_DISTRICT.items())
) + ")"
_COORDS = "centres(prio, name, lat, lon) AS (VALUES " + ", ".join(
    f"({i}, '{n}', {lat}::DOUBLE, {lon}::DOUBLE)" for i, (n, (lat, lon)) in enumerate(DISTRICT_COORDS.items())
) + ")"
_BY_NAME = """CASE WHEN named_district IN ('', 'Unknown') THEN 'default'
  ELSE coalesce((SELECT known FROM areas WHERE place = named_district), (SELECT name FROM centres WHERE name = named_district), 'default') END"""


@query("j4_district_from_location", f"""WITH {OUTAGES}, {_AREAS}, {_COORDS}
SELECT event_id, coalesce((SELECT min_by(known, prio) FROM areas WHERE contains(lower(location), lower(place))), {_BY_NAME}) AS district FROM outages""")
def j4(spark, sf):
    district = geo.district_from_location(F.col("location"), F.col("named_district"))
    return outages(spark, sf).select("event_id", district.alias("district"))


@query("j5_district_from_name", f"WITH {OUTAGES}, {_AREAS}, {_COORDS} SELECT event_id, {_BY_NAME} AS district FROM outages")
def j5(spark, sf):
    return outages(spark, sf).select("event_id", geo.district_from_name(F.col("named_district")).alias("district"))


@query("j6_district_coords", f"""WITH {OUTAGES}, {_COORDS}, hit AS (
  SELECT DISTINCT named_district, CASE WHEN named_district = '' THEN 'default' ELSE coalesce((SELECT name FROM centres WHERE name = named_district),
    (SELECT min_by(name, prio) FROM centres WHERE contains(named_district, name) OR contains(name, named_district)), 'default') END AS name FROM outages)
SELECT event_id, lat, lon FROM outages JOIN hit USING (named_district) JOIN centres ON centres.name = hit.name""")
def j6(spark, sf):
    point = geo.district_coords(F.col("named_district"))
    return outages(spark, sf).select("event_id", point["lat"].alias("lat"), point["lon"].alias("lon"))


@query("a27_weather_daily", f"WITH {WEATHER} SELECT * FROM weather_daily")
def a27(spark, sf):
    return enrichment.weather_daily(weather_hourly(spark, sf))


@query("j7_add_weather", f"""WITH {OUTAGES}, {WEATHER}
SELECT event_id, o.district, o.date, w.temp, w.rain, w.wind_gust FROM outages o
LEFT JOIN weather_daily w ON w.district = o.district AND w.date = o.date AND o.date < DATE '2024-01-20'""")
def j7(spark, sf):
    daily = enrichment.weather_daily(weather_hourly(spark, sf))
    events = outages(spark, sf).select("event_id", "district", "date", "temp", "rain", "wind_gust")
    return enrichment.add_weather(events, daily, date(2024, 1, 25), "event_id")


# Ten thousand names of lots, the lowest number first, and what stands for each.
_LOTS = {f"Lot {i}": f"quarter {i % 25}" for i in range(10_000)}


def _lot_texts(spark, sf):
    e, u = F.col("event_id"), F.col("user_id")
    return table(spark, sf, "events").select("event_id", F.concat(F.lit("between LOT "), (e * 7 % 20_000).cast("string"), F.lit(" and lot "), (u % 12_000).cast("string")).alias("location"))


@query("j4_many_places", """
WITH t AS (SELECT event_id, 'between lot ' || (event_id * 7 % 20000) || ' and lot ' || (user_id % 12000) AS location FROM events),
lots AS (SELECT i, 'lot ' || i AS name FROM (SELECT unnest(range(10000)) AS i)),
hit AS (SELECT event_id, min(i) AS i FROM t JOIN lots ON contains(location, name) GROUP BY 1)
SELECT event_id, 'quarter ' || (i % 25) AS district FROM t LEFT JOIN hit USING (event_id)""")
def j4_many(spark, sf):
    """One scan of a text against ten thousand names."""
    return _lot_texts(spark, sf).select("event_id", PlaceIndex(spark, _LOTS).first_in(F.col("location")).alias("district"))


_NAMED = {"Soi 5, Sukhumvit Road": ["Sukhumvit"], "LAT PHRAO 71": ["Lat Phrao"], "opposite Siam Square": ["Siam"], "ถนนพระราม 9": ["พระราม 9"], "Moo 4": [], "Silom Soi 2 and Sathon": ["Silom", "Sathon"]}
_NAMED_SQL = ", ".join(f"('{text}', {i}, '{place}', '{AREA_TO_DISTRICT[place]}')" for text, places in _NAMED.items() for i, place in enumerate(places))


@query("x21_place_events", f"""WITH {OUTAGES}, named(location, place_no, place, district) AS (VALUES {_NAMED_SQL})
SELECT event_id, CAST(n.place_no AS INT) AS place_no, n.place, n.district FROM outages LEFT JOIN named n USING (location)""")
def x21_places(spark, sf):
    """Every place that an event's location names, a row each."""
    index = PlaceIndex(spark, AREA_TO_DISTRICT)
    return notices.place_events(outages(spark, sf), index).select("event_id", "place_no", "place", "district")

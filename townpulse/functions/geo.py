"""Districts and coordinates as column expressions over small fixed tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from townpulse.constants import AREA_TO_DISTRICT, DISTRICT_COORDS
from townpulse.functions.text import strip

METRES_PER_DEGREE = 111_320.0


def split_coords(col: Column) -> tuple[Column, Column]:
    """``lon,lat`` text as two doubles (lon, lat)."""
    parts = F.split(col, ",")
    return tuple(strip(F.get(parts, F.lit(i))).try_cast("double") for i in (0, 1))


def _literal_map(table: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])


def district_from_name(extracted: Column) -> Column:
    """Extracted district name -> known district, else ``default``."""
    known = [d for d in DISTRICT_COORDS]
    mapped = F.try_element_at(_literal_map(AREA_TO_DISTRICT), extracted)
    usable = extracted.isNotNull() & (extracted != "") & (extracted != "Unknown")
    return F.when(
        usable, F.coalesce(mapped, F.when(extracted.isin(known), extracted), F.lit("default"))
    ).otherwise(F.lit("default"))


def district_from_location(location: Column, extracted: Column) -> Column:
    """District of the first known place named in the location, else of the extracted name."""
    lowered = F.lower(F.coalesce(location, F.lit("")))
    by_place = F.coalesce(*[
        F.when(F.contains(lowered, F.lit(place.lower())), F.lit(district))
        for place, district in AREA_TO_DISTRICT.items()
    ])
    return F.coalesce(by_place, district_from_name(extracted))


def district_coords(district: Column) -> Column:
    """Struct (lat, lon): exact name, else first partial match either way, else the default."""

    def point(name: str) -> Column:
        lat, lon = DISTRICT_COORDS[name]
        return F.struct(F.lit(lat).alias("lat"), F.lit(lon).alias("lon"))

    given = district.isNotNull() & (district != "")
    exact = [F.when(district == name, point(name)) for name in DISTRICT_COORDS]
    partial = [
        F.when(F.contains(district, F.lit(name)) | F.contains(F.lit(name), district), point(name))
        for name in DISTRICT_COORDS
    ]
    return F.when(given, F.coalesce(*exact, *partial, point("default"))).otherwise(point("default"))


def grid_cell(lat: Column, lon: Column, metres: float = 100.0, at_lat: float = 13.7563) -> tuple[Column, Column]:
    """Row and column of a square grid of ``metres``, measured at latitude ``at_lat``."""
    from math import cos, radians

    d_lat = metres / METRES_PER_DEGREE
    d_lon = metres / (METRES_PER_DEGREE * cos(radians(at_lat)))
    return (
        F.floor(lat / F.lit(d_lat)).cast("bigint"),
        F.floor(lon / F.lit(d_lon)).cast("bigint"),
    )

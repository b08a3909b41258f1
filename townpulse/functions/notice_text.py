"""Column expressions that take outage notices apart."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from townpulse.functions.text import DIGIT, SPACE, ascii_digits, clean_notice, strip
from townpulse.functions.times import date_from_words

# --- fixed values: notations of notices ---
# Weekday, month word, day, year, e.g. "Saturday, Sep 6, 2025" in any case
DAY_HEADER = (
    rf"(?i)(Monday|Tuesday|Wednesday|Thursday|Friday|Saturday|Sunday),?{SPACE}+([A-Za-z]+)"
    rf"{SPACE}+({DIGIT}{{1,2}}),?{SPACE}+({DIGIT}{{4}})"
)
# Two clock times, e.g. "08:30 AM - 04:00 PM" or "9.00 to 15. 30" (cleaning puts a space after dots)
TIME_RANGE = r"(?i)(\d{1,2})[:.]\s*(\d{2})\s*(AM|PM)?\s*(?:-|–|to|until)\s*(\d{1,2})[:.]\s*(\d{2})\s*(AM|PM)?"
DISTRICT_NAME = r"([A-Z][A-Za-z]+(?: [A-Z][a-z]+)?) District"
PROVINCES = ["Nonthaburi", "Samut Prakan", "Pathum Thani"]
# --- end of fixed values ---


def sections(text: Column, pattern: str) -> Column:
    """Array of (head, body): every match and the text up to the next match."""
    bodies = F.split(text, pattern)
    heads = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(heads, lambda head, i: F.struct(head.alias("head"), F.get(bodies, i + 1).alias("body")))


def _fields(head: Column, pattern: str, groups: list[int]) -> Column:
    """Capture groups of a whole match as an array, from one regex pass."""
    return F.split(F.regexp_replace(head, pattern, "|".join(f"${g}" for g in groups)), r"\|")


def day_sections(text: Column) -> Column:
    """Array of (outage_date, outage_data): the cleaned text under each day header."""
    split_up = F.transform(
        sections(text, DAY_HEADER),
        lambda s: F.struct(_fields(s["head"], DAY_HEADER, [2, 3, 4]).alias("words"), strip(s["body"]).alias("body")),
    )
    cleaned = F.transform(
        split_up,
        lambda s: F.struct(
            date_from_words(*[F.get(s["words"], F.lit(i)) for i in range(3)]).alias("outage_date"),
            clean_notice(s["body"]).alias("outage_data"),
        ),
    )
    return F.filter(cleaned, lambda s: F.length(s["outage_data"]) > 0)


def clock_24h(hour: Column, minute: Column, half: Column) -> Column:
    """``HH:mm``; null when it is no time of day."""
    h = hour.try_cast("int")
    pm = F.upper(half) == "PM"
    h = F.when(half == "", h).when(pm & (h < 12), h + 12).when(~pm & (h == 12), 0).otherwise(h)
    return F.when((h <= 23) & (minute.try_cast("int") <= 59), F.format_string("%02d:%s", h, minute))


def range_times(parts: Column) -> tuple[Column, Column]:
    """Start and end; a missing AM/PM on the start follows the end."""
    g = [F.get(parts, F.lit(i)) for i in range(6)]
    start_half = F.when((g[2] == "") & (g[5] != "") & (g[0].try_cast("int") < 12), g[5]).otherwise(g[2])
    return clock_24h(g[0], g[1], start_half), clock_24h(g[3], g[4], g[5])


def timed_events(text: Column) -> Column:
    """Array of (start, end, location): every time range and the place that follows it."""
    split_up = F.transform(
        sections(ascii_digits(text), TIME_RANGE),
        lambda s: F.struct(
            _fields(s["head"], TIME_RANGE, [1, 2, 3, 4, 5, 6]).alias("parts"), location_detail(s["body"]).alias("location")
        ),
    )

    def event(s: Column) -> Column:
        start, end = range_times(s["parts"])
        return F.struct(start.alias("start"), end.alias("end"), s["location"].alias("location"))

    return F.transform(split_up, event)


def location_detail(body: Column) -> Column:
    """The text after a time range on one line, without leading punctuation."""
    one_line = F.regexp_replace(body, rf"{SPACE}+", " ")
    return strip(F.regexp_replace(one_line, r"^[ ,.:;)–-]+", ""))


def district_in(location: Column) -> Column:
    name = F.regexp_extract(location, DISTRICT_NAME, 1)
    return F.when(name != "", name).otherwise("Unknown")


def province_in(location: Column) -> Column:
    return F.coalesce(*[F.when(F.contains(location, F.lit(p)), F.lit(p)) for p in PROVINCES], F.lit("Bangkok"))

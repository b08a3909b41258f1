"""From stored notice pages to outage events.

The parsed arrays are exploded with the outer form and empty ones dropped afterwards:
for a plain explode the optimizer adds a filter that would parse every text again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.constants import NEWS_PATH, NOTICE_SITE, NOTICE_SOURCE
from townpulse.functions.html import page_parts
from townpulse.functions.notice_text import day_sections, district_in, province_in, timed_events
from townpulse.functions.places import PlaceIndex
from townpulse.functions.text import NEXT_PAGE, absolute_links, html_text, is_blank
from townpulse.functions.times import iso_date, weekday_name
from townpulse.operators.dedup import keep_first

LISTING_ITEM = "div.col-sm-6.col-md-4.col-lg-4.mb-4"


def listing_links(
    pages: DataFrame, item: str = LISTING_ITEM, site: str = NOTICE_SITE, path: str = NEWS_PATH
) -> DataFrame:
    """One row per link of a listing page, in page order, with the has-next flag; a page is scanned once."""
    parts = pages.select("page_id", page_parts(F.col("html"), items=item, exists=NEXT_PAGE).alias("p"))
    return parts.select(
        "page_id", F.coalesce("p.found", F.lit(False)).alias("has_next"),
        F.posexplode_outer(absolute_links(F.col("p.links"), site, path)).alias("position", "link"),
    ).filter(F.col("position").isNotNull())


def page_texts(pages: DataFrame, selector: str = "div.content-description") -> DataFrame:
    """Notice text of each page; pages without the element are left out."""
    return pages.withColumn("content", html_text(F.col("html"), selector)).filter(F.col("content").isNotNull())


def notice_days(notices: DataFrame, url: str = "announcement_url", text: str = "content", keep: list[str] = ()) -> DataFrame:
    """One row per day section of each notice, cleaned; empty sections are dropped."""
    part = notices.filter(~is_blank(F.col(text))).select(
        *keep, F.col(url).alias("announcement_url"), F.posexplode_outer(day_sections(F.col(text))).alias("section", "s"),
    ).filter(F.col("section").isNotNull())
    day = F.col("s.outage_date")
    return part.select(
        *keep, "section", F.lit(NOTICE_SOURCE).alias("source"), "announcement_url",
        F.coalesce(weekday_name(day), F.lit("")).alias("day_of_week"), day.alias("outage_date"), "s.outage_data",
    )


def dedup_notice_days(days: DataFrame, order: list[str]) -> DataFrame:
    """First record per (date, url) in ``order``, with the date as text."""
    first = keep_first(days, ["outage_date", "announcement_url"], order)
    return first.withColumn("outage_date", iso_date(F.col("outage_date")))


def extract_events(days: DataFrame, keep: list[str] = ()) -> DataFrame:
    """One row per time range named in a day's text, with the place that follows it."""
    found = days.filter(~is_blank(F.col("outage_data"))).select(
        *keep, F.col("outage_date").alias("date"), "day_of_week",
        F.posexplode_outer(timed_events(F.col("outage_data"))).alias("event", "e"),
    ).filter(F.col("event").isNotNull())
    return found.select(
        *keep, "event", "date", "day_of_week", "e.start", "e.end", "e.location",
        district_in(F.col("e.location")).alias("district"), province_in(F.col("e.location")).alias("province"),
    )


def place_events(events: DataFrame, index: PlaceIndex, location: str = "location") -> DataFrame:
    """One row per place that the index finds in an event's location: place_no, place and its district.

    An event without a known place keeps its row, with nulls.
    """
    columns = [F.col(c) for c in events.columns if c not in ("place_no", "place", "district")]
    return events.select(*columns, F.posexplode_outer(index.all_in(F.col(location))).alias("place_no", "p")).select(
        *columns, "place_no", F.col("p.place").alias("place"), F.col("p.value").alias("district")
    )


def page_summary(days: DataFrame) -> DataFrame:
    """Records over all pages and their mean per page."""
    return days.groupBy("page").agg(F.count(F.lit(1)).alias("n")).agg(
        F.count(F.lit(1)).alias("n_pages"), F.sum("n").alias("n_records"), F.avg("n").alias("mean_per_page")
    )

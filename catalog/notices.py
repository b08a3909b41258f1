"""Notice pages: links, text, day sections, events."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import SPREAD, table
from catalog.registry import query
from townpulse.constants import STOP_PHRASES
from townpulse.functions.text import NOTICE_REWRITES, SPACE, SPACE_CLASS, clean_notice, has_next_page, html_text, is_blank
from townpulse.plans import notices as plan
from townpulse.sources.readers import spread

_ITEM = "li"


def _sql_clean(text: str) -> str:
    """The notice cleaning as nested SQL calls."""
    for phrase in STOP_PHRASES:
        text = f"(SELECT CASE WHEN strpos(t, '{phrase}') > 1 THEN substr(t, 1, strpos(t, '{phrase}') - 1) ELSE t END FROM (SELECT {text} AS t))"
    for pattern, replacement in NOTICE_REWRITES:
        pattern = pattern.replace("\\n", "' || chr(10) || '").replace("''", "''")
        replacement = replacement.replace("$", "\\").replace("\n", "' || chr(10) || '")
        text = f"regexp_replace({text}, '{pattern}', '{replacement}', 'g')"
    edge = f"'^{SPACE}+|{SPACE}+$'"
    return (f"array_to_string(list_filter(list_transform(string_split({text}, chr(10)), "
            f"lambda x: regexp_replace(x, {edge}, '', 'g')), lambda x: length(x) > 2), chr(10))")


@query("x17_clean_documents", f"SELECT doc_id, {_sql_clean('text')} AS cleaned FROM documents")
def x17(spark, sf):
    return spread(table(spark, sf, "documents"), SPREAD).select("doc_id", clean_notice(F.col("text")).alias("cleaned"))


@query("x18_l9_links", """
WITH items AS (SELECT page_id, regexp_extract_all(html, '(?s)<li>(.*?)</li>', 1) AS items FROM pages),
links AS (SELECT page_id, unnest(list_transform(items, lambda x: regexp_extract(x, '<a\\s[^>]*href="([^"]*)"', 1))) AS link,
          generate_subscripts(items, 1) AS i FROM items),
kept AS (SELECT page_id, link, min(i) AS i FROM links WHERE contains(link, '/th') GROUP BY 1, 2)
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INT) AS position, 'https://city.example' || link AS link, FALSE AS has_next FROM kept""")
def x18(spark, sf):
    return plan.listing_links(table(spark, sf, "pages"), _ITEM, "https://city.example", "/th")


@query("x19_html_text", """
WITH a AS (SELECT page_id, regexp_extract(html, '(?s)<article[^>]*>(.*?)(</article>|$)', 1) AS body FROM pages),
t AS (SELECT page_id, list_transform(regexp_split_to_array(body, '<[^>]*>'), lambda x: trim(regexp_replace(replace(replace(replace(x, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;?', '&', 'g'), ' ' || chr(10) || chr(9) || chr(13))) AS parts FROM a)
SELECT page_id, array_to_string(list_filter(parts, lambda x: length(x) > 0), chr(10)) AS content FROM t""")
def x19(spark, sf):
    return plan.page_texts(spread(table(spark, sf, "pages"), SPREAD), "article").select("page_id", "content")


@query("x20_has_next_page", "SELECT page_id, regexp_matches(html, '<nav><ul>') AS has_next FROM pages")
def x20(spark, sf):
    return table(spark, sf, "pages").select("page_id", has_next_page(F.col("html"), "nav ul").alias("has_next"))


@query("f19_skip_blank", f"SELECT doc_id FROM documents WHERE length(regexp_replace(text, '^{SPACE}+', '')) > 0")
def f19(spark, sf):
    return table(spark, sf, "documents").filter(~is_blank(F.col("text"))).select("doc_id")


def notice_pages(spark, sf):
    """Notice texts from events: a lead-in, the day of the event, the day after, a footer."""
    ts, e = F.col("ts"), F.col("event_id")
    header = F.when(e % 2 == 0, F.date_format(ts, "EEEE, MMM d, yyyy")).otherwise(F.upper(F.date_format(ts, "EEEE MMMM d yyyy")))
    following = F.date_format(F.date_add(ts, 1), "EEEE, MMMM d, yyyy")
    start = F.date_format(ts, "hh.mm")
    spaced = F.concat_ws(" ", F.substring(start, 1, 1), F.concat(F.substring(start, 2, 1), F.lit(".")), F.substring(start, 4, 1), F.substring(start, 5, 1))
    half = F.date_format(ts, "a")
    content = F.concat(
        F.lit("Notice of outage\n"), header, F.lit("\nFrom "), F.when(e % 3 == 0, spaced).otherwise(start), F.lit(" "), half,
        F.lit(" - 11.45 PM SoiSukhumvit "), (F.col("user_id") % 71).cast("string"), F.lit(" , Vadhana District\n7\n"),
        F.when(e % 5 != 0, F.concat(following, F.lit("\n09:00 - 15.30 Moo "), (e % 9).cast("string"), F.lit(" Nonthaburi\n"))).otherwise(F.lit("")),
        F.lit("In case of any inquiries, call us"),
    )
    return spread(table(spark, sf, "events"), SPREAD).select(
        "event_id", F.concat(F.lit("/news/"), e.cast("string")).alias("announcement_url"), content.alias("content")
    )


# The two sections of each notice, written from the same events.
_DAYS = """
days AS (
  SELECT event_id, '/news/' || event_id AS announcement_url, CAST(0 AS INT) AS section, CAST(ts AS DATE) AS outage_date,
         'From ' || strftime(ts, '%I:%M %p') || ' - 11:45 PM Soi Sukhumvit ' || (user_id % 71) || ', Vadhana District' AS outage_data,
         strftime(ts, '%H:%M') AS "start", '23:45' AS "end", 'Soi Sukhumvit ' || (user_id % 71) || ', Vadhana District' AS location,
         'Vadhana' AS district, 'Bangkok' AS province FROM events
  UNION ALL
  SELECT event_id, '/news/' || event_id, 1, CAST(ts AS DATE) + 1, '09:00 - 15.30 Moo ' || (event_id % 9) || ' Nonthaburi',
         '09:00', '15:30', 'Moo ' || (event_id % 9) || ' Nonthaburi', 'Unknown', 'Nonthaburi' FROM events WHERE event_id % 5 <> 0
)"""


@query("x15_notice_days", f"""WITH {_DAYS}
SELECT event_id, announcement_url, section, 'MEA' AS source, dayname(outage_date) AS day_of_week, outage_date,
       CASE section WHEN 1 THEN '09:00-15. 30 Moo ' || (event_id % 9) || ' Nonthaburi' ELSE outage_data END AS outage_data FROM days""")
def x15(spark, sf):
    return plan.notice_days(notice_pages(spark, sf), keep=["event_id"])


@query("l8_dedup_notice_days", f"""WITH {_DAYS}
SELECT strftime(outage_date, '%Y-%m-%d') AS outage_date, announcement_url, min(event_id) AS event_id
FROM (SELECT outage_date, '/news/' || (event_id % 50) AS announcement_url, event_id FROM days) GROUP BY 1, 2""")
def l8_days(spark, sf):
    days = plan.notice_days(notice_pages(spark, sf), keep=["event_id"])
    shared = days.withColumn("announcement_url", F.concat(F.lit("/news/"), (F.col("event_id") % 50).cast("string")))
    rows = shared.select("outage_date", "announcement_url", "event_id", F.struct("event_id", "section").alias("order"))
    return plan.dedup_notice_days(rows, ["order"]).drop("order")


@query("x21_extract_events", f"""WITH {_DAYS}
SELECT event_id, CAST(0 AS INT) AS event, outage_date AS date, dayname(outage_date) AS day_of_week, "start", "end", location, district, province FROM days""")
def x21(spark, sf):
    days = plan.notice_days(notice_pages(spark, sf), keep=["event_id"])
    return plan.extract_events(days, keep=["event_id"])

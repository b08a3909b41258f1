"""Sources, sinks and streams: whole tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import COMPLAINT_LOG, complaint_log, outages, table
from catalog.registry import query
from townpulse.plans.complaint_reports import top_districts
from townpulse.plans.notices import page_summary
from townpulse.schemas import COMPLAINTS_RAW, OUTAGES_RAW
from townpulse.session import fresh_path
from townpulse.sources import readers, writers
from townpulse.streaming import notices as streams

_ORDERS = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate DATE, o_orderpriority STRING"
_ALL_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders"


def _orders(spark, sf):
    return table(spark, sf, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))


@query("s1_s5_csv_round_trip", _ALL_ORDERS)
def s1_s5(spark, sf):
    path = fresh_path(spark, "orders-csv")
    writers.write_csv(_orders(spark, sf), path, bom=True)
    return readers.read_csv(spark, path, _ORDERS)


@query("s2_complaints_csv", f"""WITH {COMPLAINT_LOG}
SELECT ticket_id, type, organization, comment, coords, district, province, star, count_reopen FROM complaint_log""")
def s2(spark, sf):
    path = fresh_path(spark, "complaints-csv")
    writers.write_csv(complaint_log(spark, sf).drop("ord"), path)
    df = readers.read_csv(spark, path, COMPLAINTS_RAW)
    return df.select("ticket_id", "type", "organization", "comment", "coords", "district", "province", "star", "count_reopen")


@query("s3_u1_union_csv", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, NULL::VARCHAR AS o_orderstatus FROM orders WHERE o_custkey % 2 = 0
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, o_orderstatus FROM orders WHERE o_custkey % 2 = 1""")
def s3(spark, sf):
    orders, paths = _orders(spark, sf), [fresh_path(spark, "part-csv") for _ in range(2)]
    writers.write_csv(orders.filter("o_custkey % 2 = 0").select("o_orderkey", "o_orderpriority"), paths[0])
    writers.write_csv(orders.filter("o_custkey % 2 = 1").select("o_orderstatus", "o_orderkey"), paths[1])
    return readers.union_csv(spark, paths)


@query("s4_read_optional", "SELECT event_id, location FROM (WITH " + "outages AS (SELECT event_id, (['Soi 5, Sukhumvit Road', 'LAT PHRAO 71', 'opposite Siam Square', 'ถนนพระราม 9', 'Moo 4', 'Silom Soi 2 and Sathon'])[event_id % 6 + 1] AS location FROM events) SELECT * FROM outages)")
def s4(spark, sf):
    path = fresh_path(spark, "outages-csv")
    if readers.read_optional(spark, path, OUTAGES_RAW) is not None:
        raise RuntimeError("a missing source must give None")
    writers.write_csv(outages(spark, sf), path)
    ids = readers.read_optional(spark, path, "event_id BIGINT, date DATE, day_of_week STRING, start STRING, end STRING, name STRING, location STRING, district STRING, named_district STRING, province STRING, temp DOUBLE, rain DOUBLE, wind_gust DOUBLE")
    return ids.select("event_id", "location")


@query("s7_append_batches", "SELECT event_id, event_type, value FROM events")
def s7(spark, sf):
    """Three batches, one of them written twice with other rows first, and one that was never finished."""
    path = fresh_path(spark, "batches")
    events = table(spark, sf, "events").select("event_id", "event_type", "value")
    part = lambda i: events.filter(F.col("event_id") % 3 == i)
    writers.commit_batch(part(0), path, "0")
    writers.commit_batch(part(1).withColumn("value", -F.col("value")), path, "1")
    writers.commit_batch(part(1), path, "1")
    writers.commit_batch(part(2), path, "2")
    writers.write_table(part(2), f"{path}/rows/batch=3/attempt=torn")
    return readers.read_batches(spark, path, events.schema).drop("batch")


def _paged(spark, sf):
    return table(spark, sf, "events").select(
        F.to_date("ts").alias("outage_date"), F.concat(F.lit("/news/"), F.col("user_id").cast("string")).alias("announcement_url"),
        "event_id", (F.col("user_id") % 10 + 1).cast("int").alias("page"),
    )


@query("s8_u4_page_table", """
SELECT min(event_id) AS event_id, CAST(ts AS DATE) AS outage_date, '/news/' || user_id AS announcement_url, CAST(user_id % 10 + 1 AS INT) AS page
FROM events GROUP BY 2, 3, 4""")
def s8(spark, sf):
    from townpulse.operators.dedup import keep_first

    path = fresh_path(spark, "pages")
    days = _paged(spark, sf).withColumn("order", F.col("event_id"))
    writers.write_pages(keep_first(days, ["outage_date", "announcement_url"], ["order"]).drop("order"), path)
    return spark.read.parquet(path)


@query("s9_page_range", "SELECT event_id, CAST(user_id % 10 + 1 AS INT) AS page FROM events WHERE user_id % 10 + 1 BETWEEN 3 AND 6")
def s9(spark, sf):
    path = fresh_path(spark, "pages")
    writers.write_pages(_paged(spark, sf), path)
    return readers.page_range(spark.read.parquet(path), start=3, stop=8, max_pages=4).select("event_id", "page")


@query("a33_page_summary", """SELECT count(*) AS n_pages, CAST(sum(n) AS BIGINT) AS n_records, avg(n) AS mean_per_page
FROM (SELECT user_id % 10 AS page, count(*) AS n FROM events GROUP BY 1)""")
def a33(spark, sf):
    return page_summary(_paged(spark, sf))


@query("s10_aggregate_table", """
SELECT n_name AS district, count(*) AS n, round(count(*) / (SELECT count(*) FROM orders) * 100.0, 2) AS pct
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1 ORDER BY n DESC, district LIMIT 20""")
def s10(spark, sf):
    from catalog.bindings import complaints

    path = fresh_path(spark, "top-districts")
    writers.write_table(top_districts(complaints(spark, sf, activity=False)), path, compression="gzip")
    return spark.read.parquet(path)


@query("s11_profile", f"""WITH {COMPLAINT_LOG}
SELECT c AS "column", count(*) AS n_rows, count(*) - count(v) AS n_nulls FROM (
  SELECT unnest(['ticket_id', 'type', 'organization', 'comment', 'district', 'star', 'count_reopen']) AS c,
         unnest([ticket_id, type, organization, comment, district, CAST(star AS VARCHAR), CAST(count_reopen AS VARCHAR)]) AS v FROM complaint_log) GROUP BY 1""")
def s11(spark, sf):
    shown = complaint_log(spark, sf).select("ticket_id", "type", "organization", "comment", "district", "star", "count_reopen")
    return readers.profile(shown).drop("type")


@query("s12_audited_steps", f"""WITH {COMPLAINT_LOG}
SELECT 'raw' AS step, count(*) AS n_rows FROM complaint_log
UNION ALL SELECT 'bangkok', count(*) FROM complaint_log WHERE regexp_matches(province, 'กรุงเทพ|Bangkok', 'i')
UNION ALL SELECT 'located', count(*) FROM complaint_log WHERE regexp_matches(province, 'กรุงเทพ|Bangkok', 'i') AND district IS NOT NULL""")
def s12(spark, sf):
    from townpulse.operators.cleaning import drop_null_rows, in_bangkok

    raw, n_raw = readers.audited(complaint_log(spark, sf), "raw")
    bangkok, n_bangkok = readers.audited(in_bangkok(raw), "bangkok")
    located, n_located = readers.audited(drop_null_rows(bangkok, ["district"]), "located")
    writers.write_table(located.drop("ord"), fresh_path(spark, "located"))
    counts = [(step, seen.get["n_rows"]) for step, seen in (("raw", n_raw), ("bangkok", n_bangkok), ("located", n_located))]
    return spark.createDataFrame(counts, "step STRING, n_rows BIGINT")


@query("t1_stream_new_days", "SELECT DISTINCT CAST(ts AS DATE) AS outage_date, '/news/' || user_id AS announcement_url FROM events")
def t1(spark, sf):
    source, sink, checkpoint = (fresh_path(spark, n) for n in ("t1-in", "t1-out", "t1-checkpoint"))
    days = _paged(spark, sf).select("outage_date", "announcement_url", "page")
    schema = "outage_date DATE, announcement_url STRING, page BIGINT, arrived TIMESTAMP"
    for low, high, age in ((4, 7, 0), (1, 3, 40), (2, 10, 1)):  # the second comes 40 days late, the third repeats pages of both
        own = days.filter(F.col("page").between(low, high)).withColumn("page", F.col("page").cast("bigint"))
        writers.append_batch(own.withColumn("arrived", F.date_sub(F.current_timestamp(), age).cast("timestamp")), source)
        streams.take_in(streams.read_stream(spark, source, schema).drop("page", "arrived"), sink, checkpoint).awaitTermination()
    return spark.read.parquet(sink).select("outage_date", "announcement_url")


@query("t2_stream_daily_counts", """
SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS n FROM events
GROUP BY 1, 2""")
def t2(spark, sf):
    """Events of all days in three batches, none of them in order."""
    source, sink, checkpoint = (fresh_path(spark, n) for n in ("t2-in", "t2-out", "t2-checkpoint"))
    events = table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    for i in (2, 0, 1):
        writers.append_batch(events.filter(F.col("event_id") % 3 == i).drop("event_id"), source)
        streams.add_counts(streams.read_stream(spark, source, "ts TIMESTAMP, event_type STRING"), "event_type", sink, checkpoint).awaitTermination()
    return streams.added_counts(spark, sink, "event_type")

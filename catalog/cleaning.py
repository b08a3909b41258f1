"""Cleaning of complaints and outages (filters, fills, deduplication, scalar functions)."""

from __future__ import annotations

from datetime import date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from catalog.bindings import (
    COMPLAINT_LOG,
    COMPLAINTS,
    OUTAGES,
    complaint_log,
    complaints,
    outages,
    table,
)
from catalog.registry import query
from townpulse.constants import BANGKOK_PATTERN, NO_COMMENT, NO_ORGANIZATION, NO_TYPE, OUTAGE_REQUIRED
from townpulse.functions import categories, geo, times
from townpulse.operators import cleaning as ops
from townpulse.operators.dedup import keep_first, keep_last
from townpulse.plans import complaint_cleaning, outage_cleaning
from townpulse.plans.outage_clusters import with_minutes, with_times
from townpulse.schemas import numeric_only, require_columns

PREPARED = f"""
prepared AS (
  SELECT ticket_id, coalesce(type, '{NO_TYPE}') AS type, coalesce(organization, '{NO_ORGANIZATION}') AS organization,
         coalesce(comment, '{NO_COMMENT}') AS comment, coords, address, subdistrict, district, province, timestamp,
         last_activity, state, star, count_reopen,
         try_cast(split_part(coords, ',', 1) AS DOUBLE) AS lon,
         try_cast(nullif(split_part(coords, ',', 2), '') AS DOUBLE) AS lat,
         CAST(floor((epoch_us(last_activity) - epoch_us(timestamp)) / 86400000000) AS BIGINT) AS solve_days
  FROM complaint_log
  WHERE newest = 1 AND regexp_matches(province, 'กรุงเทพ|Bangkok', 'i') AND district IS NOT NULL
    AND subdistrict IS NOT NULL AND timestamp IS NOT NULL AND last_activity IS NOT NULL
)"""

CLEANED = PREPARED + """,
fence AS (
  SELECT quantile_cont(solve_days, 0.75) + 2.0::DOUBLE * (quantile_cont(solve_days, 0.75) - quantile_cont(solve_days, 0.25)) AS upper
  FROM prepared
),
cleaned AS (
  SELECT prepared.* FROM prepared, fence
  WHERE solve_days >= 0 AND solve_days <= upper AND count_reopen BETWEEN 0 AND 2
)"""


@query("complaint_cleaning", f"""WITH {COMPLAINT_LOG}, {CLEANED}
SELECT ticket_id, type, organization, comment, address, subdistrict, district, province, timestamp, last_activity,
       state, star AS star_rating, count_reopen, lon, lat, solve_days,
       CASE WHEN type IN ('{{}}', '{NO_TYPE}') THEN 'Unknown'
            ELSE trim(split_part(trim(type, '{{}}'), ',', 1)) END AS primary_type,
       CAST(year(timestamp) AS INT) AS year, CAST(month(timestamp) AS INT) AS month,
       CAST(isodow(timestamp) - 1 AS INT) AS day_of_week, CAST(hour(timestamp) AS INT) AS hour
FROM cleaned""")
def complaint_cleaning_query(spark, sf):
    return complaint_cleaning.clean_complaints(complaint_log(spark, sf), ["ord"]).drop("coords", "types_list")


@query("outage_cleaning", f"""WITH {OUTAGES}
SELECT event_id, date, day_of_week, "start", "end", name, district, province, temp, rain, wind_gust,
       "start" || ' - ' || "end" AS time_range,
       CAST(date_diff('minute', CAST("start" AS TIME), CAST("end" AS TIME)) AS DOUBLE) AS duration_minutes
FROM outages
WHERE "start" IS NOT NULL AND lower(trim(district)) <> 'unknown' AND lower(province) = 'bangkok'
  AND regexp_full_match("start", '[01][0-9]:[0-5][0-9]|2[0-3]:[0-5][0-9]')
  AND regexp_full_match("end", '[01][0-9]:[0-5][0-9]|2[0-3]:[0-5][0-9]') AND "end" >= "start" """)
def outage_cleaning_query(spark, sf):
    return outage_cleaning.clean_outages(outages(spark, sf), keep=["event_id"])


@query("f1_drop_unknown", f"""WITH {OUTAGES}
SELECT event_id, "start", district FROM outages WHERE "start" IS NOT NULL AND lower(trim(district)) <> 'unknown'""")
def f1(spark, sf):
    return ops.drop_unknown(outages(spark, sf), OUTAGE_REQUIRED).select("event_id", "start", "district")


@query("f2_valid_times", f"""WITH {OUTAGES}
SELECT event_id, "start" || ' - ' || "end" AS time_range,
       CAST(date_diff('minute', CAST("start" AS TIME), CAST("end" AS TIME)) AS DOUBLE) AS duration_minutes
FROM outages WHERE regexp_full_match("start", '[01][0-9]:[0-5][0-9]|2[0-3]:[0-5][0-9]')
  AND regexp_full_match("end", '[01][0-9]:[0-5][0-9]|2[0-3]:[0-5][0-9]') AND "end" >= "start" """)
def f2(spark, sf):
    return outage_cleaning.with_valid_times(outages(spark, sf)).select("event_id", "time_range", "duration_minutes")


@query("f3_province_equals", f"WITH {OUTAGES} SELECT event_id, province FROM outages WHERE lower(province) = 'bangkok'")
def f3(spark, sf):
    return outages(spark, sf).filter(F.lower("province") == "bangkok").select("event_id", "province")


@query("f4_province_matches", f"""WITH {COMPLAINT_LOG}
SELECT province, count(*) AS n FROM complaint_log
WHERE regexp_matches(province, 'กรุงเทพ|Bangkok', 'i') GROUP BY 1""")
def f4(spark, sf):
    return ops.in_bangkok(complaint_log(spark, sf)).groupBy("province").agg(F.count(F.lit(1)).alias("n"))


@query("f5_drop_null_rows", f"""WITH {COMPLAINT_LOG}
SELECT district, subdistrict, count(*) AS n FROM complaint_log
WHERE district IS NOT NULL AND subdistrict IS NOT NULL GROUP BY 1, 2""")
def f5(spark, sf):
    kept = ops.drop_null_rows(complaint_log(spark, sf), ["district", "subdistrict"])
    return kept.groupBy("district", "subdistrict").agg(F.count(F.lit(1)).alias("n"))


@query("f6_drop_columns", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def f6(spark, sf):
    return ops.drop_columns(table(spark, sf, "orders"), ["o_orderstatus", "o_totalprice", "o_orderpriority", "absent"], ignore_missing=True)


@query("f7_fill_missing", f"""WITH {COMPLAINT_LOG}
SELECT coalesce(comment, '{NO_COMMENT}') AS comment, coalesce(organization, '{NO_ORGANIZATION}') AS organization,
       coalesce(type, 'Not define') AS type, count(*) AS n FROM complaint_log GROUP BY 1, 2, 3""")
def f7(spark, sf):
    filled = ops.fill_missing(
        complaint_log(spark, sf), ["comment", "organization", "type", "absent"], [NO_COMMENT, NO_ORGANIZATION, None, "x"]
    )
    return filled.groupBy("comment", "organization", "type").agg(F.count(F.lit(1)).alias("n"))


@query("f8_parse_timestamp", f"""WITH {COMPLAINT_LOG}
SELECT timestamp, last_activity, count(*) AS n FROM complaint_log WHERE timestamp IS NOT NULL GROUP BY 1, 2""")
def f8(spark, sf):
    parsed = ops.parse_or_drop(ops.parse_or_drop(complaint_log(spark, sf), "timestamp"), "last_activity")
    return parsed.groupBy("timestamp", "last_activity").agg(F.count(F.lit(1)).alias("n"))


@query("f9_split_coords", f"""WITH {COMPLAINT_LOG}
SELECT coords, try_cast(split_part(coords, ',', 1) AS DOUBLE) AS lon,
       try_cast(nullif(split_part(coords, ',', 2), '') AS DOUBLE) AS lat, count(*) AS n FROM complaint_log GROUP BY ALL""")
def f9(spark, sf):
    lon, lat = geo.split_coords(F.col("coords"))
    df = complaint_log(spark, sf).select("coords", lon.alias("lon"), lat.alias("lat"))
    return df.groupBy("coords", "lon", "lat").agg(F.count(F.lit(1)).alias("n"))


@query("f10_elapsed_days", f"""WITH {COMPLAINT_LOG}
SELECT CAST(floor((epoch_us(last_activity) - epoch_us(timestamp)) / 86400000000) AS BIGINT) AS days, count(*) AS n
FROM complaint_log WHERE timestamp IS NOT NULL GROUP BY 1""")
def f10(spark, sf):
    log = complaint_log(spark, sf)
    days = times.elapsed_days(times.parse_timestamp(F.col("timestamp")), times.parse_timestamp(F.col("last_activity")))
    return log.select(days.alias("days")).filter("days IS NOT NULL").groupBy("days").agg(F.count(F.lit(1)).alias("n"))


@query("f11_cap_outliers", """WITH d AS (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)
SELECT event_id, round(CASE WHEN value < q1 - 1.5 * (q3 - q1) THEN q1 - 1.5 * (q3 - q1)
       WHEN value > q3 + 1.5 * (q3 - q1) THEN q3 + 1.5 * (q3 - q1) ELSE value END, 6) AS value FROM events, d""")
def f11_cap(spark, sf):
    capped = ops.cap_outliers(table(spark, sf, "events").select("event_id", "value"), ["value"])
    return capped.withColumn("value", F.round("value", 6))


@query("f11_remove_outliers", """
WITH a AS (SELECT quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem),
s AS (SELECT lineitem.* FROM lineitem, a WHERE l_extendedprice BETWEEN q1 - 0.2 * (q3 - q1) AND q3 + 0.2 * (q3 - q1)),
b AS (SELECT quantile_cont(l_quantity, 0.25) AS q1, quantile_cont(l_quantity, 0.75) AS q3 FROM s)
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice
FROM s, b WHERE l_quantity BETWEEN q1 - 0.2 * (q3 - q1) AND q3 + 0.2 * (q3 - q1)""")
def f11_remove(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    return ops.remove_outliers(rows, ["l_extendedprice", "l_quantity"], factor=0.2)


@query("f12_keep_solve_days", f"""WITH {COMPLAINTS},
f AS (SELECT quantile_cont(solve_days, 0.75) + 2 * (quantile_cont(solve_days, 0.75) - quantile_cont(solve_days, 0.25)) AS upper FROM complaints)
SELECT ticket_id, solve_days FROM complaints, f WHERE solve_days >= 0 AND solve_days <= upper""")
def f12(spark, sf):
    return ops.keep_solve_days(complaints(spark, sf)).select("ticket_id", "solve_days")


@query("f13_keep_reopen_range", f"""WITH {COMPLAINT_LOG}
SELECT count_reopen, count(*) AS n FROM complaint_log WHERE count_reopen BETWEEN 0 AND 2 GROUP BY 1""")
def f13(spark, sf):
    return ops.keep_reopen_range(complaint_log(spark, sf)).groupBy("count_reopen").agg(F.count(F.lit(1)).alias("n"))


@query("f13_nonzero_profile", f"""WITH {COMPLAINT_LOG}
SELECT count(*) FILTER (count_reopen <> 0) AS n_nonzero, avg(count_reopen) FILTER (count_reopen <> 0) AS mean_nonzero FROM complaint_log""")
def f13_profile(spark, sf):
    return ops.nonzero_profile(complaint_log(spark, sf), "count_reopen")


@query("f15_between_dates", f"""WITH {COMPLAINTS}
SELECT ticket_id, timestamp FROM complaints WHERE CAST(timestamp AS DATE) BETWEEN DATE '1996-02-01' AND DATE '1997-03-15'""")
def f15(spark, sf):
    df = complaints(spark, sf, activity=False)
    return ops.between_dates(df, date(1996, 2, 1), date(1997, 3, 15)).select("ticket_id", "timestamp")


@query("f16_equals_or_all", f"""WITH {COMPLAINTS}
SELECT ticket_id, district, primary_type FROM complaints WHERE district = 'NATION_7'""")
def f16(spark, sf):
    df = complaints(spark, sf, activity=False)
    return ops.equals_or_all(ops.equals_or_all(df, "district", "NATION_7"), "primary_type").select("ticket_id", "district", "primary_type")


@query("f18_cohorts", f"""WITH {OUTAGES}
SELECT event_id, date AS outage_date, CASE WHEN date < DATE '2024-01-20' THEN 'history' ELSE 'recent' END AS cohort
FROM outages WHERE date <= DATE '2024-01-25'""")
def f18(spark, sf):
    df = outages(spark, sf).select("event_id", F.col("date").alias("outage_date"))
    return ops.split_cohorts(df, date(2024, 1, 25))


@query("u2_cohort_union", f"""WITH {OUTAGES}
SELECT event_id, date AS outage_date FROM outages WHERE date < DATE '2024-01-20'
UNION ALL SELECT event_id, date FROM outages WHERE date BETWEEN DATE '2024-01-20' AND DATE '2024-01-25'""")
def u2(spark, sf):
    df = outages(spark, sf).select("event_id", F.col("date").alias("outage_date"))
    split = ops.split_cohorts(df, date(2024, 1, 25))
    history, recent = (split.filter(F.col("cohort") == c).drop("cohort") for c in ("history", "recent"))
    return history.unionByName(recent)


@query("f20_rename_columns", "SELECT o_orderkey AS ticket, o_orderdate AS opened FROM orders")
def f20(spark, sf):
    return ops.rename_columns(
        table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), {"o_orderkey": "ticket", "o_orderdate": "opened"}
    )


@query("f21_keep_up_to_percentile", f"""WITH {COMPLAINTS}
SELECT ticket_id, solve_days FROM complaints WHERE solve_days <= (SELECT quantile_cont(solve_days, 0.99) FROM complaints)""")
def f21(spark, sf):
    return ops.keep_up_to_percentile(complaints(spark, sf), "solve_days").select("ticket_id", "solve_days")


@query("f22_f23_numeric_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def f22_f23(spark, sf):
    return numeric_only(require_columns(table(spark, sf, "orders"), ["o_orderkey", "o_orderdate"]))


@query("f24_align_features", "SELECT o_orderkey, o_totalprice, CAST(0 AS INT) AS absent, o_custkey FROM orders")
def f24(spark, sf):
    return ops.align_features(table(spark, sf, "orders"), ["o_totalprice", "absent", "o_custkey"], keep=["o_orderkey"])


@query("f26_load_outages", f"WITH {OUTAGES} SELECT event_id, try_cast(nullif(CAST(date AS VARCHAR), '2024-01-03') AS DATE) AS date FROM outages")
def f26(spark, sf):
    texts = outages(spark, sf).select(
        "event_id", F.when(F.col("date") == F.lit("2024-01-03"), "bad").otherwise(F.col("date").cast("string")).alias("date")
    )
    return outage_cleaning.load_outages(texts)


@query("f27_load_complaints", f"""WITH {COMPLAINTS}
SELECT ticket_id, primary_type, CASE state WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'Pending' ELSE 'Unknown' END AS state,
       CASE WHEN ticket_id % 7 BETWEEN 1 AND 5 THEN CAST(ticket_id % 7 AS DOUBLE) END AS star_rating,
       CAST(year(timestamp) AS INT) AS year, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week
FROM complaints WHERE ticket_id % 11 <> 0""")
def f27(spark, sf):
    df = complaints(spark, sf, activity=False)
    hot = {f"star_{i}.0": (F.col("ticket_id") % 7 == i).cast("double") for i in range(1, 6)}
    hot["state_Completed    "] = (F.col("state") == "F").cast("double")
    hot["state_Pending"] = (F.col("state") == "P").cast("double")
    hot["lat"] = F.when(F.col("ticket_id") % 11 != 0, F.col("lat"))
    raw = df.withColumns(hot).select("ticket_id", "type", "timestamp", "lat", "lon", *[f"`{c}`" for c in hot if c != "lat"])
    loaded = complaint_cleaning.load_complaints(raw)
    return loaded.select("ticket_id", "primary_type", "state", "star_rating", "year", "day_of_week")


@query("l7_keep_last", f"""WITH {COMPLAINT_LOG}
SELECT ticket_id, last_activity, count_reopen, district FROM complaint_log WHERE newest = 1""")
def l7(spark, sf):
    last = keep_last(complaint_log(spark, sf), ["ticket_id"], ["ord"])
    return last.select("ticket_id", times.parse_timestamp(F.col("last_activity")).alias("last_activity"), "count_reopen", "district")


@query("l8_keep_first", """SELECT CAST(ts AS DATE) AS day, user_id, min(event_id) AS event_id FROM events GROUP BY 1, 2""")
def l8(spark, sf):
    events = table(spark, sf, "events").select(F.to_date("ts").alias("day"), "user_id", "event_id")
    return keep_first(events.withColumn("order", F.col("event_id")), ["day", "user_id"], ["order"]).drop("order")


@query("x1_x2_x3_time_range", f"""WITH {OUTAGES}
SELECT event_id, CASE WHEN s THEN "start" || ' - ' || "end" END AS time_range,
  CASE WHEN s THEN CAST(date_diff('minute', CAST("start" AS TIME), CAST("end" AS TIME)) AS DOUBLE) END AS duration_minutes
FROM (SELECT *, coalesce(regexp_full_match("start", '[01][0-9]:[0-5][0-9]|2[0-3]:[0-5][0-9]')
  AND regexp_full_match("end", '[01][0-9]:[0-5][0-9]|2[0-3]:[0-5][0-9]'), FALSE) AS s FROM outages)""")
def x1_x2_x3(spark, sf):
    start, end = F.col("start"), F.col("end")
    return outages(spark, sf).select(
        "event_id", times.time_range(start, end).alias("time_range"), times.minutes_between(start, end).alias("duration_minutes")
    )


@query("x4_x5_minutes", f"""WITH {OUTAGES}, m AS (
  SELECT event_id, try_cast(split_part("start", ':', 1) AS INT) * 60 + try_cast(nullif(split_part("start", ':', 2), '') AS INT) AS start_min,
         CAST(split_part("end", ':', 1) AS INT) * 60 + CAST(split_part("end", ':', 2) AS INT) AS end_min FROM outages)
SELECT *, CASE WHEN end_min < start_min THEN end_min - start_min + 1440 ELSE end_min - start_min END AS duration FROM m""")
def x4_x5(spark, sf):
    return with_minutes(outages(spark, sf)).select("event_id", "start_min", "end_min", "duration")


@query("x6_with_times", f"""WITH {OUTAGES}
SELECT event_id, CASE WHEN regexp_full_match("start", '([01]?[0-9]|2[0-3]):[0-5][0-9]') THEN try_cast(CAST(date AS VARCHAR) || ' ' || "start" || ':00' AS TIMESTAMP) END AS start_dt,
       try_cast(CAST(date AS VARCHAR) || ' ' || lpad("end", 5, '0') || ':00' AS TIMESTAMP) AS end_dt FROM outages""")
def x6(spark, sf):
    return with_times(outages(spark, sf)).select("event_id", "start_dt", "end_dt")


@query("x7_parse_types", f"""WITH {COMPLAINT_LOG}
SELECT type, CASE WHEN type IS NULL OR type IN ('{{}}', '{NO_TYPE}') THEN 'Unknown'
  ELSE array_to_string(list_transform(string_split(trim(type, '{{}}'), ','), lambda x: trim(x)), '|') END AS types,
  CASE WHEN type IS NULL OR type IN ('{{}}', '{NO_TYPE}') THEN 'Unknown' ELSE trim(split_part(trim(type, '{{}}'), ',', 1)) END AS primary_type,
  count(*) AS n FROM complaint_log GROUP BY ALL""")
def x7(spark, sf):
    df = categories.with_types(complaint_log(spark, sf))
    return df.groupBy("type", F.array_join("types_list", "|").alias("types"), "primary_type").agg(F.count(F.lit(1)).alias("n"))


@query("x8_x9_one_hot_round_trip", f"""WITH {COMPLAINT_LOG}
SELECT state, star, CAST(state = 'F' AS DOUBLE) AS is_f, coalesce(CAST(star = 3 AS DOUBLE), 0.0::DOUBLE) AS is_3,
       CAST(star IS NULL AS DOUBLE) AS is_nan, count(*) AS n FROM complaint_log GROUP BY ALL""")
def x8_x9(spark, sf):
    log = complaint_log(spark, sf).select("state", "star")
    values = categories.present_values(log, {"state": ["F", "O", "P"], "star": [1.0, 2.0, 3.0, 4.0, 5.0, None]})
    hot = categories.one_hot(log, values)
    decoded = hot.select(
        categories.decode_state(hot).alias("state"), categories.decode_star(hot.drop("star_nan")).alias("star"),
        F.col("state_F").alias("is_f"), F.col("`star_3.0`").alias("is_3"), F.col("star_nan").alias("is_nan"),
    )
    return decoded.groupBy("state", "star", "is_f", "is_3", "is_nan").agg(F.count(F.lit(1)).alias("n"))


@query("x9_sparse_vectors", f"""WITH {COMPLAINT_LOG},
kept AS (SELECT ticket_id, newest, organization, state FROM complaint_log),
labels AS (SELECT organization, row_number() OVER (ORDER BY organization) - 1 AS at, count(*) OVER () AS n FROM (SELECT DISTINCT organization FROM kept WHERE organization IS NOT NULL)),
states AS (SELECT state, row_number() OVER (ORDER BY state) - 1 AS at FROM (SELECT DISTINCT state FROM kept))
SELECT organization, CAST(coalesce(l.at, (SELECT max(n) FROM labels)) AS INT) AS organization_at, CAST(s.at AS INT) AS state_at, count(*) AS n
FROM kept LEFT JOIN labels l USING (organization) JOIN states s USING (state) GROUP BY ALL""")
def x9_vectors(spark, sf):
    """Where the 1 of each sparse vector stands; no value is named and none is collected."""
    log = complaint_log(spark, sf).select("organization", "state")
    hot, _ = categories.one_hot_vector(log, ["organization", "state"])
    at = lambda c: F.array_position(vector_to_array(f"{c}_vector"), F.lit(1.0)).cast("int") - 1
    return hot.groupBy("organization", at("organization").alias("organization_at"), at("state").alias("state_at")).agg(F.count(F.lit(1)).alias("n"))


@query("x10_x11_time_parts", """
SELECT event_id, CAST(year(ts) AS INT) AS year, CAST(month(ts) AS INT) AS month, CAST(isodow(ts) - 1 AS INT) AS day_of_week,
       CAST(hour(ts) AS INT) AS hour, CAST(isodow(ts) >= 6 AS INT) AS is_weekend FROM events""")
def x10_x11(spark, sf):
    df = times.with_time_parts(table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("timestamp")))
    return df.withColumn("is_weekend", times.is_weekend(F.col("day_of_week"))).drop("timestamp")


@query("x12_keyword_flags", """
SELECT doc_id, CAST(regexp_matches(text, 'the|est') AS INT) AS is_common, CAST(regexp_matches(text, 'น้ำท่วม') AS INT) AS is_flood FROM documents""")
def x12(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select(
        "doc_id", categories.keyword_flag(F.col("text"), "the|est").alias("is_common"),
        categories.type_flags(F.col("text"))["is_flood"].alias("is_flood"),
    )


@query("x14_x22_day_names", "SELECT event_id, dayname(ts) AS day_name, strftime(ts, '%Y-%m-%d') AS day FROM events")
def x14_x22(spark, sf):
    ts = F.col("ts")
    return table(spark, sf, "events").select("event_id", times.weekday_name(ts).alias("day_name"), times.iso_date(ts).alias("day"))


@query("x16_date_from_words", """
SELECT event_id, CASE WHEN event_id % 6 <> 0 THEN try_cast(printf('%04d-%02d-%02d', year(ts), month(ts), CASE WHEN event_id % 7 = 0 THEN 32 ELSE day(ts) END) AS DATE) END AS date FROM events""")
def x16(spark, sf):
    ts, e = F.col("ts"), F.col("event_id")
    month = F.when(e % 6 == 0, "Foo").when(e % 2 == 0, F.date_format(ts, "MMMM")).otherwise(F.date_format(ts, "MMM"))
    day = F.when(e % 7 == 0, "32").otherwise(F.dayofmonth(ts).cast("string"))
    return table(spark, sf, "events").select(
        "event_id", times.date_from_words(month, day, F.year(ts).cast("string")).alias("date")
    )


@query("x24_x25_clip_round", """
SELECT event_id, least(greatest(value / 100, 0), 1) AS clipped, round(value / 3, 2) AS rounded FROM events""")
def x24_x25(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").select(
        "event_id", F.least(F.greatest(v / 100, F.lit(0)), F.lit(1)).alias("clipped"), F.round(v / 3, 2).alias("rounded")
    )


@query("a32_describe_counts", f"""WITH {COMPLAINTS}
SELECT avg(solve_days) AS mean, quantile_cont(solve_days, 0.25) AS q1, quantile_cont(solve_days, 0.75) AS q3,
       count(solve_days) AS n_values, count(*) FILTER (solve_days > 900) AS n_over FROM complaints""")
def a32(spark, sf):
    return complaint_cleaning.describe_counts(complaints(spark, sf), "solve_days", 900)


@query("l3_sorted_heads", f"""WITH {COMPLAINTS}
(SELECT 'low' AS side, ticket_id, solve_days FROM complaints WHERE solve_days IS NOT NULL ORDER BY solve_days, ticket_id LIMIT 300)
UNION ALL (SELECT 'high', ticket_id, solve_days FROM complaints WHERE solve_days IS NOT NULL ORDER BY solve_days DESC, ticket_id LIMIT 20)""")
def l3(spark, sf):
    df = complaints(spark, sf).select("ticket_id", "solve_days").filter("solve_days IS NOT NULL")
    low = df.orderBy("solve_days", "ticket_id").limit(300).select(F.lit("low").alias("side"), "*")
    high = df.orderBy(F.desc("solve_days"), "ticket_id").limit(20).select(F.lit("high").alias("side"), "*")
    return low.unionByName(high)

"""Descriptive complaint reports and joins."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from catalog.bindings import COMPLAINTS, SPREAD, complaints, table
from catalog.registry import query
from townpulse.constants import WEEKDAY_NAMES_TH
from townpulse.operators import joins, sampling, topk
from townpulse.plans import complaint_reports as reports
from townpulse.sources.readers import spread

_TOP = "SELECT {k}, count(*) AS n FROM complaints WHERE {k} IS NOT NULL GROUP BY 1 ORDER BY n DESC, {k} LIMIT {n}"
_THAI = ", ".join(f"({i}, '{n}')" for i, n in enumerate(WEEKDAY_NAMES_TH))


@query("a1_top_districts", f"""WITH {COMPLAINTS}
SELECT district, count(*) AS n, round(count(*) / (SELECT count(*) FROM complaints) * 100.0, 2) AS pct
FROM complaints GROUP BY 1 ORDER BY n DESC, district LIMIT 20""")
def a1(spark, sf):
    return reports.top_districts(complaints(spark, sf, activity=False))


@query("a2_top_types", f"""WITH {COMPLAINTS}
SELECT primary_type, count(*) AS n, round(count(*) / (SELECT count(*) FROM complaints) * 100.0, 2) AS pct
FROM complaints GROUP BY 1 ORDER BY n DESC, primary_type LIMIT 20""")
def a2(spark, sf):
    return reports.top_types(complaints(spark, sf, activity=False))


@query("a3_types_by_district", f"""WITH {COMPLAINTS},
td AS ({_TOP.format(k='district', n=15)}),
inside AS (SELECT * FROM complaints WHERE district IN (SELECT district FROM td)),
tt AS (SELECT primary_type FROM inside GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10)
SELECT district, primary_type, count(*) AS n FROM inside WHERE primary_type IN (SELECT primary_type FROM tt) GROUP BY 1, 2""")
def a3(spark, sf):
    return reports.types_by_district(complaints(spark, sf, activity=False))


@query("a3_one_type_by_district", f"""WITH {COMPLAINTS}
SELECT district, primary_type, count(*) AS n FROM complaints WHERE primary_type = '1-URGENT'
GROUP BY 1, 2 ORDER BY n DESC, district LIMIT 15""")
def a3_one(spark, sf):
    return reports.types_by_district(complaints(spark, sf, activity=False), "1-URGENT")


@query("a4_districts_by_type", f"""WITH {COMPLAINTS},
c AS (SELECT primary_type, district, count(*) AS n FROM complaints
      WHERE primary_type IN (SELECT primary_type FROM ({_TOP.format(k='primary_type', n=10)})) GROUP BY 1, 2)
SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY primary_type ORDER BY n DESC, district) <= 10""")
def a4(spark, sf):
    return reports.districts_by_type(complaints(spark, sf, activity=False))


@query("a5_month_heatmap", f"""WITH {COMPLAINTS},
c AS (SELECT district, strftime(timestamp, '%Y-%m') AS month, count(*) AS n FROM complaints GROUP BY 1, 2),
m AS (SELECT DISTINCT month FROM c ORDER BY month DESC LIMIT 12),
d AS (SELECT district FROM c GROUP BY 1 ORDER BY coalesce(sum(n) FILTER (month = (SELECT max(month) FROM c)), 0) DESC, district LIMIT 20)
SELECT district, month, coalesce(n, 0) AS n FROM d CROSS JOIN m LEFT JOIN c USING (district, month)""")
def a5(spark, sf):
    return reports.month_heatmap(complaints(spark, sf, activity=False))


@query("a5_month_pivot", f"""WITH {COMPLAINTS}
SELECT district, count(*) FILTER (strftime(timestamp, '%Y-%m') = '1997-01') AS "1997-01",
       count(*) FILTER (strftime(timestamp, '%Y-%m') = '1997-02') AS "1997-02" FROM complaints GROUP BY 1""")
def a5_pivot(spark, sf):
    return reports.month_pivot(complaints(spark, sf, activity=False), ["1997-01", "1997-02"])


@query("a6_type_shares", f"""WITH {COMPLAINTS}, t AS ({_TOP.format(k='primary_type', n=3)})
SELECT primary_type, n, round(n / (SELECT sum(n) FROM t) * 100.0, 2) AS pct FROM t""")
def a6(spark, sf):
    return reports.type_shares(complaints(spark, sf, activity=False), 3)


@query("a7_resolution_times", f"""WITH {COMPLAINTS},
s AS (SELECT * FROM complaints WHERE district IN (SELECT district FROM ({_TOP.format(k='district', n=15)}))),
k AS (SELECT * FROM s WHERE solve_days <= (SELECT quantile_cont(solve_days, 0.99) FROM s)),
b AS (SELECT district, count(*) AS n, min(solve_days) AS lowest, quantile_cont(solve_days, 0.25) AS q1,
      quantile_cont(solve_days, 0.5) AS median, quantile_cont(solve_days, 0.75) AS q3, max(solve_days) AS highest FROM k GROUP BY 1)
SELECT b.*, min(solve_days) AS whisker_low, max(solve_days) AS whisker_high FROM b JOIN k USING (district)
WHERE solve_days BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY ALL""")
def a7(spark, sf):
    return reports.resolution_times(complaints(spark, sf))


@query("a8_daily_by_district", f"""WITH {COMPLAINTS}
SELECT CAST(timestamp AS DATE) AS date, district, count(*) AS n FROM complaints
WHERE district IN (SELECT district FROM ({_TOP.format(k='district', n=5)})) GROUP BY 1, 2""")
def a8(spark, sf):
    return reports.daily_by_district(complaints(spark, sf, activity=False))


@query("a8_daily_for_chosen", f"""WITH {COMPLAINTS}
SELECT CAST(timestamp AS DATE) AS date, district, count(*) AS n FROM complaints
WHERE district IN ('NATION_1', 'NATION_2') GROUP BY 1, 2""")
def a8_chosen(spark, sf):
    return reports.daily_by_district(complaints(spark, sf, activity=False), ["NATION_1", "NATION_2"])


@query("a9_hourly", "SELECT CAST(hour(ts) AS INT) AS hour, count(*) AS n FROM events GROUP BY 1")
def a9(spark, sf):
    return reports.hourly(table(spark, sf, "events"), "ts")


@query("a10_by_weekday", f"""WITH d(day_of_week, day_name) AS (VALUES {_THAI})
SELECT day_of_week, day_name, (SELECT count(*) FROM events WHERE isodow(ts) - 1 = day_of_week) AS n FROM d""")
def a10(spark, sf):
    return reports.by_weekday(table(spark, sf, "events"), "ts")


@query("a11_state_shares", f"""WITH {COMPLAINTS}
SELECT state, count(*) AS n, round(count(*) / (SELECT count(*) FROM complaints) * 100.0, 2) AS pct FROM complaints GROUP BY 1""")
def a11(spark, sf):
    return reports.state_shares(complaints(spark, sf, activity=False))


@query("a12_timeline", f"""WITH {COMPLAINTS}
SELECT CAST(timestamp AS DATE) AS date, province, count(*) AS n FROM complaints GROUP BY 1, 2""")
def a12(spark, sf):
    return reports.timeline(complaints(spark, sf, activity=False))


@query("a13_key_figures", f"""WITH {COMPLAINTS}
SELECT count(*) AS n_rows, round(avg(solve_days), 6) AS mean_solve_days, round(avg(CAST(state = 'F' AS INT)) * 100, 6) AS completion_pct,
       count(DISTINCT district) AS n_districts, count(DISTINCT primary_type) AS n_types,
       count(*) - (SELECT count(*) FROM complaints) AS delta_rows
FROM complaints WHERE CAST(timestamp AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1998-06-30' AND province = 'ASIA' """)
def a13(spark, sf):
    df = complaints(spark, sf)
    chosen = reports.filter_complaints(df, date(1996, 1, 1), date(1998, 6, 30)).filter(F.col("province") == "ASIA")
    figures = reports.key_figures(chosen, df, completed="F")
    return figures.withColumns({c: F.round(c, 6) for c in ("mean_solve_days", "completion_pct")})


@query("a14_district_figures", f"""WITH {COMPLAINTS}
SELECT district, count(lat) AS n, round(avg(solve_days), 2) AS mean_solve_days FROM complaints GROUP BY 1""")
def a14(spark, sf):
    return reports.district_figures(complaints(spark, sf))


@query("a15_solve_day_summary", f"""WITH {COMPLAINTS}
SELECT round(avg(solve_days), 6) AS mean, median(solve_days) AS median, max(solve_days) AS highest,
       greatest(0, min(solve_days)) AS lowest FROM complaints""")
def a15(spark, sf):
    return reports.solve_day_summary(complaints(spark, sf)).withColumn("mean", F.round("mean", 6))


@query("a16_choices", f"WITH {COMPLAINTS} SELECT DISTINCT primary_type FROM complaints")
def a16(spark, sf):
    return reports.choices(complaints(spark, sf, activity=False), "primary_type")


@query("f17_date_bounds", "SELECT CAST(min(o_orderdate) AS DATE) AS min_date, CAST(max(o_orderdate) AS DATE) AS max_date FROM orders")
def f17(spark, sf):
    return reports.date_bounds(complaints(spark, sf, activity=False))


@query("f17_default_filter", "SELECT event_id FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-10' AND event_type = 'error'")
def f17_filter(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("timestamp"), F.col("event_type").alias("primary_type")
    )
    return reports.filter_complaints(events, date(2024, 1, 10), kind="error").select("event_id")


@query("a30_a31_density", """
WITH p AS (SELECT 13.5::DOUBLE + (o_custkey % 997)::DOUBLE / 997::DOUBLE * 0.5::DOUBLE AS lat,
                  100.3::DOUBLE + (o_orderkey % 991)::DOUBLE / 991::DOUBLE * 0.5::DOUBLE AS lon FROM orders),
c AS (SELECT CAST(floor(lat / (2000.0::DOUBLE / 111320.0::DOUBLE)) AS BIGINT) AS cell_row,
             CAST(floor(lon / (2000.0::DOUBLE / (111320.0::DOUBLE * cos(radians(13.7563::DOUBLE))))) AS BIGINT) AS cell_col,
             count(*) AS n, avg(lat) AS lat, avg(lon) AS lon FROM p GROUP BY 1, 2)
SELECT cell_row, cell_col, n, round(lat, 6) AS lat, round(lon, 6) AS lon, n / (SELECT max(n) FROM c) AS weight FROM c""")
def a30(spark, sf):
    cells = reports.density(complaints(spark, sf, activity=False), metres=2000.0)
    return cells.withColumns({c: F.round(c, 6) for c in ("lat", "lon")})


@query("l6_x23_map_points", f"""WITH {COMPLAINTS}
SELECT ticket_id, lat, lon, concat_ws(' | ', district, primary_type, strftime(timestamp, '%Y-%m-%d'), state, CAST(solve_days AS VARCHAR)) AS label
FROM complaints ORDER BY ticket_id LIMIT 1000""")
def l6(spark, sf):
    return reports.map_points(complaints(spark, sf), 1000)


@query("l1_l2_top_values", "SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 3")
def l1_l2(spark, sf):
    return topk.n_largest(topk.value_counts(table(spark, sf, "events"), "event_type"), 3, "n", "event_type")


@query("w7_top_per_group", """SELECT c_mktsegment, c_custkey, c_acctbal FROM customer
QUALIFY row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC, c_custkey) <= 10""")
def w7(spark, sf):
    customers = table(spark, sf, "customer").select("c_mktsegment", "c_custkey", "c_acctbal")
    return topk.top_per_group(customers, ["c_mktsegment"], [F.desc("c_acctbal"), F.col("c_custkey")], 10)


@query("l5_sort_by_time", "SELECT event_id, ts FROM events")
def l5(spark, sf):
    return table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts")).orderBy("ts", "event_id")


@query("l10_sample_rows", "SELECT o_orderkey FROM orders ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 5000")
def l10(spark, sf):
    return sampling.sample_rows(table(spark, sf, "orders").select("o_orderkey"), 5000, "o_orderkey")


@query("l10_sample_percent", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM (
  SELECT *, l_orderkey || '-' || l_partkey || '-' || l_suppkey || '-' || l_linenumber AS id FROM lineitem)
ORDER BY md5(id || ':42'), id LIMIT CAST(floor((SELECT count(*) FROM lineitem) * 30 / 100) AS BIGINT)""")
def l10_percent(spark, sf):
    key = F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    rows = spread(table(spark, sf, "lineitem"), SPREAD).select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", key.alias("id"))
    return sampling.sample_percent(rows, 30, "id").drop("id")


@query("l12_random_split", """
SELECT o_orderkey, ('0x' || substr(md5(o_orderkey || ':42'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < 0.2 AS is_test FROM orders""")
def l12(spark, sf):
    return sampling.random_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


@query("w8_time_split", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) <= floor((SELECT count(*) FROM orders) * 0.8) AS is_train FROM orders""")
def w8(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("ts"))
    return sampling.time_split(df, "ts", "o_orderkey").select("o_orderkey", "is_train")


_PAIRS = """pairs AS (SELECT district, CAST(timestamp AS DATE) AS date, count(*) AS n FROM complaints GROUP BY 1, 2)"""


@query("j1_j2_group_count", f"""WITH {COMPLAINTS}, {_PAIRS}
SELECT ticket_id, n AS district_daily_count FROM complaints JOIN pairs ON complaints.district = pairs.district AND CAST(timestamp AS DATE) = date""")
def j1(spark, sf):
    df = complaints(spark, sf, activity=False).select("ticket_id", "district", F.to_date("timestamp").alias("date"))
    counted = joins.with_group_count(df, ["district", "date"], "district_daily_count", ["ticket_id"], default=1)
    return counted.select("ticket_id", "district_daily_count")


@query("a29_pair_counts", f"WITH {COMPLAINTS}, {_PAIRS} SELECT * FROM pairs")
def a29(spark, sf):
    df = complaints(spark, sf, activity=False).withColumn("date", F.to_date("timestamp"))
    return joins.count_per_key(df, ["district", "date"], "n")


@query("j8_in_top_keys", f"""WITH {COMPLAINTS}
SELECT ticket_id, district FROM complaints WHERE district IN (SELECT district FROM ({_TOP.format(k='district', n=3)}))""")
def j8(spark, sf):
    df = complaints(spark, sf, activity=False).select("ticket_id", "district")
    return joins.in_top_keys(df, topk.top_values(df, "district", 3), "district")


@query("j9_flag_members", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem WHERE l_quantity = 50 AND l_discount = 0.1) AS INT) AS flag
FROM orders""")
def j9(spark, sf):
    days = table(spark, sf, "lineitem").filter("l_quantity = 50 AND l_discount = 0.1D").select(F.to_date("l_shipdate").alias("date"))
    rows = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return joins.flag_members(rows, days, "date", "flag", ["o_orderkey"]).select("o_orderkey", "flag")


@query("a7_price_quantiles", """
SELECT n_name AS district, count(l_extendedprice) AS n, round(quantile_cont(l_extendedprice::DOUBLE, 0.05), 6) AS q0,
       round(quantile_cont(l_extendedprice::DOUBLE, 0.5), 6) AS q1, round(quantile_cont(l_extendedprice::DOUBLE, 0.95), 6) AS q2
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def a7_prices(spark, sf):
    """Exact quantiles of a real-valued column per district."""
    from townpulse.operators.quantiles import grouped_quantiles

    places = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(places, F.col("o_custkey") == F.col("c_custkey"))
    found = grouped_quantiles(rows.select(F.col("n_name").alias("district"), "l_extendedprice"), ["district"], "l_extendedprice", [0.05, 0.5, 0.95])
    return found.select("district", "n", *[F.round(q, 6).alias(q) for q in ("q0", "q1", "q2")])

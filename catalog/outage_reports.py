"""Descriptive outage and cluster reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import LABELLED_OUTAGES, labelled_outages
from catalog.registry import query
from townpulse.constants import WEEKDAY_NAMES_TH
from townpulse.plans import outage_clusters as clusters
from townpulse.plans.outage_cleaning import with_valid_times

_CELLS = ", ".join(f"count(*) FILTER (cluster = {c}) AS cluster_{c}" for c in range(4))
_THAI = ", ".join(f"({i}, '{n}')" for i, n in enumerate(WEEKDAY_NAMES_TH))


@query("a17_minutes_by_district", f"""WITH {LABELLED_OUTAGES}
SELECT district, CAST(sum(end_min - start_min) AS DOUBLE) AS duration_minutes FROM labelled WHERE end_min >= start_min GROUP BY 1""")
def a17(spark, sf):
    return clusters.minutes_by_district(with_valid_times(labelled_outages(spark, sf)))


@query("a18_cluster_sizes", f"WITH {LABELLED_OUTAGES} SELECT cluster, count(*) AS n FROM labelled GROUP BY 1")
def a18(spark, sf):
    return clusters.cluster_sizes(labelled_outages(spark, sf))


@query("a19_cluster_profile", f"""WITH {LABELLED_OUTAGES}
SELECT cluster, count(*) AS n, round(avg(temp), 2) AS temp, round(avg(rain), 2) AS rain, round(avg(wind_gust), 2) AS wind_gust,
       round(avg(start_min), 2) AS start_min, round(avg(duration), 2) AS duration FROM labelled GROUP BY 1""")
def a19(spark, sf):
    return clusters.cluster_profile(labelled_outages(spark, sf))


@query("a20_district_by_cluster", f"WITH {LABELLED_OUTAGES} SELECT district, {_CELLS} FROM labelled GROUP BY 1")
def a20(spark, sf):
    return clusters.by_cluster(labelled_outages(spark, sf), "district", [0, 1, 2, 3])


@query("a21_weekday_by_cluster", f"""WITH {LABELLED_OUTAGES}, names(weekday, day_name) AS (VALUES {_THAI})
SELECT weekday, day_name, {_CELLS} FROM labelled JOIN names ON isodow(date) - 1 = weekday GROUP BY 1, 2""")
def a21(spark, sf):
    return clusters.weekday_by_cluster(labelled_outages(spark, sf), [0, 1, 2, 3])


@query("a22_cluster_summary", f"""WITH {LABELLED_OUTAGES},
b AS (SELECT cluster, count(*) AS n, avg(duration) AS md, avg(temp) AS mt, avg(rain) AS mr, avg(wind_gust) AS mw, avg(start_min) AS ms FROM labelled GROUP BY 1),
d AS (SELECT cluster, string_agg(district || ':' || n, ';' ORDER BY n DESC, district) AS top_districts FROM (
  SELECT cluster, district, count(*) AS n FROM labelled GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, district) <= 5) GROUP BY 1),
w AS (SELECT cluster, string_agg(weekday || ':' || n, ';' ORDER BY n DESC, weekday) AS top_days FROM (
  SELECT cluster, isodow(date) - 1 AS weekday, count(*) AS n FROM labelled GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, isodow(date) - 1) <= 3) GROUP BY 1)
SELECT cluster, n, round(md, 6) AS mean_duration, round(mt, 6) AS mean_temp, round(mr, 6) AS mean_rain, round(mw, 6) AS mean_wind_gust,
       printf('%d:%02d', CAST(floor(ms / 60) AS INT), CAST(floor(ms % 60) AS INT)) AS mean_start, mr > 10 AS often_rain, mw > 30 AS often_wind,
       top_districts, top_days FROM b JOIN d USING (cluster) JOIN w USING (cluster)""")
def a22(spark, sf):
    means = ("mean_duration", "mean_temp", "mean_rain", "mean_wind_gust")
    return clusters.cluster_summary(labelled_outages(spark, sf)).withColumns({c: F.round(c, 6) for c in means})


@query("a23_cluster_totals", f"""WITH {LABELLED_OUTAGES}
SELECT count(DISTINCT cluster) AS n_clusters, round(avg(duration), 6) AS mean_duration, count(*) AS n_outages,
       count(DISTINCT district) AS n_districts FROM labelled""")
def a23(spark, sf):
    return clusters.cluster_totals(labelled_outages(spark, sf)).withColumn("mean_duration", F.round("mean_duration", 6))


@query("f25_cluster_scatter", f"""WITH {LABELLED_OUTAGES}
SELECT event_id, cluster, duration, measure, x FROM (
  SELECT event_id, cluster, duration, 'start_min' AS measure, CAST(start_min AS DOUBLE) AS x FROM labelled
  UNION ALL SELECT event_id, cluster, duration, 'temp', temp FROM labelled
  UNION ALL SELECT event_id, cluster, duration, 'rain', rain FROM labelled
  UNION ALL SELECT event_id, cluster, duration, 'wind_gust', wind_gust FROM labelled)""")
def f25(spark, sf):
    return clusters.cluster_scatter(labelled_outages(spark, sf), "event_id")


@query("f25_cluster_correlation", f"""WITH {LABELLED_OUTAGES}
SELECT cluster, round(corr(start_min, duration), 6) AS corr_start_min, round(corr(temp, duration), 6) AS corr_temp,
       round(corr(rain, duration), 6) AS corr_rain, round(corr(wind_gust, duration), 6) AS corr_wind_gust FROM labelled GROUP BY 1""")
def f25_corr(spark, sf):
    df = clusters.cluster_correlation(labelled_outages(spark, sf))
    return df.select("cluster", *[F.round(c, 6).alias(c) for c in df.columns if c != "cluster"])

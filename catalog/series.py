"""Daily series, rolling windows, training windows, baselines."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import COMPLAINTS, SERIES, complaints, requests, table
from catalog.registry import query
from townpulse.functions.metrics import error_metrics, mape, rmse
from townpulse.operators import joins, series
from townpulse.operators.cleaning import align_features


def daily(spark, sf):
    return series.fill_gaps(series.daily_counts(requests(spark, sf)))


@query("a28_daily_counts", "SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS complaint_count FROM orders GROUP BY 1")
def a28(spark, sf):
    return series.daily_counts(requests(spark, sf))


@query("a28_daily_sums", "SELECT CAST(l_shipdate AS DATE) AS date, CAST(sum(l_linenumber) AS BIGINT) AS complaint_count FROM lineitem GROUP BY 1")
def a28_sums(spark, sf):
    weighted = table(spark, sf, "lineitem").select(F.col("l_shipdate").alias("timestamp"), F.col("l_linenumber").alias("complaint_count"))
    return series.daily_counts(weighted)


@query("j10_fill_gaps", f"""WITH {COMPLAINTS},
c AS (SELECT district, CAST(timestamp AS DATE) AS date, count(*) AS n FROM complaints GROUP BY 1, 2),
s AS (SELECT district, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM c GROUP BY 1)
SELECT district, date, coalesce(n, 0) AS complaint_count FROM s LEFT JOIN c USING (district, date)""")
def j10(spark, sf):
    df = complaints(spark, sf, activity=False)
    return series.fill_gaps(series.daily_counts(df, by=["district"]), ["district"])


_ROUNDED = "date, complaint_count, dayofweek, month, is_weekend, round(roll_mean_7, 6) AS roll_mean_7, round(roll_std_7, 6) AS roll_std_7, round(roll_mean_30, 6) AS roll_mean_30"


@query("m13_w1_w2_features", f"WITH {SERIES} SELECT {_ROUNDED} FROM features")
def m13(spark, sf):
    df = series.prepare_series(requests(spark, sf))
    return df.withColumns({c: F.round(c, 6) for c in ("roll_mean_7", "roll_std_7", "roll_mean_30")})


@query("w3_centred", f"""WITH {SERIES}, r AS (
  SELECT date, avg(complaint_count) OVER w AS m, stddev_samp(complaint_count) OVER w AS s, count(*) OVER w AS k FROM daily
  WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
SELECT date, CASE WHEN k = 7 THEN round(m, 6) END AS mean, CASE WHEN k = 7 THEN round(s, 6) END AS std FROM r""")
def w3(spark, sf):
    mean, std = series.centred("complaint_count", 7)
    return daily(spark, sf).select("date", F.round(mean, 6).alias("mean"), F.round(std, 6).alias("std"))


_SEQS = """,
lagged AS (SELECT date AS origin, complaint_count AS y0, roll_mean_7, row_number() OVER (ORDER BY date) AS i, count(*) OVER () AS t,
   first_value(complaint_count) OVER (ORDER BY date ROWS 29 PRECEDING) AS oldest,
   sum(roll_mean_30) OVER (ORDER BY date ROWS 29 PRECEDING) AS sum_mean_30,
   lead(complaint_count, 1) OVER (ORDER BY date) AS y1, lead(complaint_count, 7) OVER (ORDER BY date) AS y7 FROM features),
seqs AS (SELECT * FROM lagged WHERE i >= 30 AND i <= t - 7)"""


@query("m14_w4_w5_sequences", f"""WITH {SERIES}{_SEQS}
SELECT origin, CAST(210 AS INT) AS width, CAST(oldest AS DOUBLE) AS oldest, CAST(y0 AS DOUBLE) AS newest,
       round(sum_mean_30, 6) AS sum_mean_30, CAST(y1 AS DOUBLE) AS y1, CAST(y7 AS DOUBLE) AS y7 FROM seqs""")
def m14(spark, sf):
    seqs = series.sequences(series.prepare_series(requests(spark, sf)))
    column = F.transform(F.sequence(F.lit(0), F.lit(29)), lambda d: F.get("x", d * 7 + 6))
    return seqs.select(
        "origin", F.size("x").alias("width"), F.get("x", F.lit(0)).alias("oldest"), F.get("x", F.lit(29 * 7)).alias("newest"),
        F.round(F.aggregate(column, F.lit(0.0), lambda a, v: a + v), 6).alias("sum_mean_30"),
        F.get("y", F.lit(0)).alias("y1"), F.get("y", F.lit(6)).alias("y7"),
    )


@query("w9_ordered_split", f"""WITH {SERIES}{_SEQS}, n AS (SELECT origin, row_number() OVER (ORDER BY origin) - 1 AS j, count(*) OVER () AS c FROM seqs)
SELECT origin, CASE WHEN j < floor(0.8 * c) THEN 'train' WHEN j < floor(0.8 * c) + floor(0.1 * c) THEN 'val' ELSE 'test' END AS split FROM n""")
def w9(spark, sf):
    return series.ordered_split(series.sequences(series.prepare_series(requests(spark, sf)))).select("origin", "split")


@query("w6_previous_mean", f"""WITH {SERIES}
SELECT date, round(avg(complaint_count) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING), 6) AS predicted FROM daily""")
def w6(spark, sf):
    return daily(spark, sf).select("date", F.round(series.previous_mean("complaint_count"), 6).alias("predicted"))


@query("w11_baselines", f"""WITH {SERIES}{_SEQS}
SELECT origin, 'naive' AS model, CAST(h AS INT) AS horizon, CAST(y0 AS DOUBLE) AS predicted FROM seqs, range(1, 8) r(h)
UNION ALL SELECT origin, 'ma7', CAST(h AS INT), round(roll_mean_7, 6) FROM seqs, range(1, 8) r(h)""")
def w11(spark, sf):
    seqs = series.sequences(series.prepare_series(requests(spark, sf)))
    return series.baselines(seqs).select("origin", "model", "horizon", F.round("predicted", 6).alias("predicted"))


@query("m17_x26_baseline_metrics", f"""WITH {SERIES}{_SEQS}, n AS (SELECT *, row_number() OVER (ORDER BY origin) - 1 AS j, count(*) OVER () AS c FROM seqs),
tests AS (SELECT origin, y0, roll_mean_7 FROM n WHERE j >= floor(0.8 * c) + floor(0.1 * c)),
pairs AS (SELECT m AS model, CAST(h AS INT) AS horizon, CAST(f.complaint_count AS DOUBLE) AS a, CASE m WHEN 'naive' THEN y0 ELSE roll_mean_7 END AS p
  FROM tests CROSS JOIN range(1, 8) r(h) CROSS JOIN (VALUES ('naive'), ('ma7')) v(m)
  JOIN daily f ON f.date = origin + CAST(h AS INT))
SELECT model, horizon, round(avg(abs(a - p)), 6) AS mae, round(sqrt(avg((a - p) * (a - p))), 6) AS rmse,
       round(log10(avg(abs(a - p) / greatest(abs(a), 2.220446049250313e-16::DOUBLE)) * 100), 6) AS log_mape
FROM pairs GROUP BY GROUPING SETS ((model), (model, horizon))""")
def m17(spark, sf):
    split = series.ordered_split(series.sequences(series.prepare_series(requests(spark, sf))))
    metrics = error_metrics(series.baselines(split.filter("split = 'test'")), ["model"])
    return metrics.select(
        "model", "horizon", F.round("mae", 6).alias("mae"), F.round("rmse", 6).alias("rmse"),
        F.round(F.log10("mape"), 6).alias("log_mape"),
    )


@query("m20_j3_x27_moving_average_backtest", f"""WITH {SERIES},
last AS (SELECT * FROM daily ORDER BY date DESC LIMIT 90),
p AS (SELECT date, complaint_count AS a, avg(complaint_count) OVER (ORDER BY date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS predicted FROM last)
SELECT count(*) AS n_days, round(avg(abs((a - predicted) / nullif(a, 0))) * 100, 6) AS mape, round(sqrt(avg((a - predicted) * (a - predicted))), 6) AS rmse
FROM p WHERE predicted IS NOT NULL""")
def m20(spark, sf):
    recent = series.last_days(daily(spark, sf), 90)
    predicted = recent.select("date", series.previous_mean("complaint_count").alias("predicted")).filter("predicted IS NOT NULL")
    both = joins.actual_vs_predicted(recent, predicted)
    a, p = F.col("complaint_count"), F.col("predicted")
    return both.agg(F.count(F.lit(1)).alias("n_days"), F.round(mape(a, p), 6).alias("mape"), F.round(rmse(a, p), 6).alias("rmse"))


@query("w12_last_days", f"""WITH {SERIES}
SELECT date, complaint_count FROM (SELECT * FROM daily ORDER BY date DESC LIMIT 90) WHERE date < (SELECT max(date) FROM daily)""")
def w12(spark, sf):
    return series.last_days(daily(spark, sf), 90, drop_last=True)


@query("f24_aligned_series", f"WITH {SERIES} SELECT date, complaint_count, month, CAST(0 AS INT) AS holiday FROM features")
def f24_series(spark, sf):
    return align_features(series.prepare_series(requests(spark, sf)), ["complaint_count", "month", "holiday"], keep=["date"])

"""Clustering of outages and forecasting of daily volumes."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.bindings import LABELLED_OUTAGES, SERIES, complaints, labelled_outages, outages, requests
from catalog.registry import query
from townpulse.operators import kmeans, series
from townpulse.operators.joins import actual_vs_predicted
from townpulse.operators.sampling import random_split
from townpulse.plans import forecast, outage_clusters
from townpulse.session import cut_lineage, fresh_path


def _outage_rows(spark, sf):
    """Every event, also those without a readable clock text or a nation; the model fills what they lack."""
    return outage_clusters.with_minutes(outages(spark, sf, how="left"))


def _train_and_all(spark, sf):
    split = cut_lineage(random_split(_outage_rows(spark, sf), "event_id"))
    return split.filter("NOT is_test").drop("is_test"), split


_TRAINED: dict = {}


def _trained(spark, sf):
    """The training job's saved model, what it tried, and all rows; searched once per session and table."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _TRAINED:
        train, rows = _train_and_all(spark, sf)
        model, tried = outage_clusters.train_clusters(train)
        path = fresh_path(spark, "outage-clusters")
        model.save(path)
        _TRAINED[key] = outage_clusters.ClusterModel.load(spark, path), tried, rows
    return _TRAINED[key]


@query("m21_m24_cluster_outages")
def m21(spark, sf):
    model, _, rows = _trained(spark, sf)
    return model.transform(rows).select("event_id", "district", "cluster")


@query("m22_find_best_k")
def m22(spark, sf):
    tried = _trained(spark, sf)[1]
    chosen = outage_clusters.best(tried).k
    rows = [(t.k, t.silhouette, t.cost, t.k == chosen) for t in tried]
    return spark.createDataFrame(rows, "k INT, silhouette DOUBLE, cost DOUBLE, is_best BOOLEAN")


@query("m23_evaluate_clusters")
def m23(spark, sf):
    model, _, rows = _trained(spark, sf)
    found = []
    for name, test in (("train", "NOT is_test"), ("test", "is_test")):
        own = rows.filter(test)
        found.append((name, model.silhouette(own), float(outage_clusters.silhouette_squared(model.transform(own))), own.count()))
    return spark.createDataFrame(found, "split STRING, silhouette DOUBLE, silhouette_squared DOUBLE, n BIGINT")


@query("m23_silhouette_of_groups", f"""WITH {LABELLED_OUTAGES},
p AS (SELECT event_id, cluster, temp::DOUBLE AS a, rain::DOUBLE AS b, wind_gust::DOUBLE AS c, start_min::DOUBLE AS d, duration::DOUBLE AS e FROM labelled),
means AS (
  SELECT x.event_id, x.cluster, y.cluster AS other, sum(sqrt((x.a-y.a)*(x.a-y.a) + (x.b-y.b)*(x.b-y.b) + (x.c-y.c)*(x.c-y.c) + (x.d-y.d)*(x.d-y.d) + (x.e-y.e)*(x.e-y.e)))
         / (count(*) - (x.cluster = y.cluster)::INT) AS m
  FROM p x, p y GROUP BY 1, 2, 3
),
widths AS (SELECT event_id, cluster, min(m) FILTER (other <> cluster) AS far, min(m) FILTER (other = cluster) AS own FROM means GROUP BY 1, 2)
SELECT cluster, count(*) AS n, round(avg((far - own) / greatest(far, own)), 6) AS silhouette FROM widths GROUP BY 1""")
def m23_groups(spark, sf):
    """The silhouette of given groups of outages; exact, as all rows are compared."""
    df = labelled_outages(spark, sf)
    rows = df.select("cluster", F.array(*[F.col(c).cast("double") for c in outage_clusters.NUMBERS]).alias("features"))
    found = kmeans.silhouettes(cut_lineage(rows), "features", label="cluster", n_labels=4)
    return found.select(F.col("label").alias("cluster"), "n", F.round("width", 6).alias("silhouette"))


@query("m21_m24_cluster_training", """
WITH t AS (SELECT event_id, ('0x' || substr(md5(event_id || ':42'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE < 0.2 AS is_test FROM events)
SELECT count(*) FILTER (NOT is_test) AS n_train, count(*) FILTER (is_test) AS n_test, CAST(count(*) AS BIGINT) AS n_nearest, true AS k_is_best, true AS separates FROM t""")
def m21_m24(spark, sf):
    """The whole training job: search k, save, label all rows, judge both parts."""
    model, tried, rows = _trained(spark, sf)
    labelled = cut_lineage(model.transform(rows).select("event_id", "features", "cluster", "is_test"))
    far = [F.aggregate(F.zip_with("features", F.array(*map(F.lit, c.tolist())), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda a, b: a + b) for c in model.centres]
    own = F.get(F.array(*far), F.col("cluster"))
    nearest = own <= F.least(*far) * (1 + 1e-9) + 1e-9
    counts = labelled.agg(F.count_if(~F.col("is_test")).alias("n_train"), F.count_if("is_test").alias("n_test"), F.count_if(nearest).alias("n_nearest"))
    chosen = outage_clusters.best(tried)
    good = len(model.centres) == chosen.k and chosen.silhouette == max(t.silhouette for t in tried)
    apart = all(model.silhouette(rows.filter(test)) > 0 for test in ("NOT is_test", "is_test"))
    return counts.withColumns({"k_is_best": F.lit(good), "separates": F.lit(apart)})


_SEARCHED: dict = {}
_FORECASTERS: dict = {}


def _searched(spark, sf, by=()):
    """The daily series, its split windows, the error of every candidate and the training windows; once per session, table and series."""
    key = (spark.sparkContext.applicationId, sf, tuple(by))
    if key not in _SEARCHED:
        rows = complaints(spark, sf, activity=False) if by else requests(spark, sf)
        features = cut_lineage(series.prepare_series(rows, by=by))
        split = cut_lineage(series.ordered_split(series.sequences(features, by=by), by=by))
        train = split.filter("split = 'train'")
        _SEARCHED[key] = features, split, forecast.search(train, forecast.grid(), by=list(by)), train
    return _SEARCHED[key]


def _forecaster(spark, sf, by=()):
    """The training job's saved model, with the daily series and its split windows: all horizons by the best candidate."""
    key = (spark.sparkContext.applicationId, sf, tuple(by))
    features, split, tried, train = _searched(spark, sf, by)
    if key not in _FORECASTERS:
        path = fresh_path(spark, "forecaster")
        forecast.train(train, [tried[0][0]], by=list(by)).save(path, spark)
        _FORECASTERS[key] = forecast.Forecaster.load(spark, path)
    return _FORECASTERS[key], features, split


@query("m15_grid_search")
def m15(spark, sf):
    tried = _searched(spark, sf)[2]
    rows = [(p["n_trees"], p["max_depth"], p["min_leaf"], p["min_split"], e) for p, e in tried]
    return spark.createDataFrame(rows, "n_trees INT, max_depth INT, min_leaf INT, min_split INT, mae DOUBLE")


@query("m16_m17_evaluate_forecaster")
def m16_m17(spark, sf):
    model, _, split = _forecaster(spark, sf)
    return forecast.evaluate(model, split.filter("split = 'test'"))


@query("m18_m24_u3_forecast_line")
def m18(spark, sf):
    model, features, _ = _forecaster(spark, sf)
    return forecast.past_and_future(forecast.backtest(model, features), forecast.forecast(model, features, 30))


@query("m18_forecast_by_district")
def m18_by_district(spark, sf):
    by = ["district"]
    model, features, _ = _forecaster(spark, sf, by)
    return forecast.forecast(model, features, 30, by)


@query("m19_x27_backtest_errors")
def m19(spark, sf):
    from townpulse.functions.metrics import mape, rmse

    model, features, _ = _forecaster(spark, sf)
    both = actual_vs_predicted(features.select("date", "complaint_count"), forecast.backtest(model, features))
    a, p = F.col("complaint_count"), F.col("predicted")
    return both.agg(F.count(F.lit(1)).alias("n_days"), mape(a, p).alias("mape"), rmse(a, p).alias("rmse"))


@query("m19_rolling_origins")
def m19_origins(spark, sf):
    model, features, _ = _forecaster(spark, sf)
    return forecast.origin_errors(forecast.rolling_origins(model, features), features)


@query("m19_naive_rolling_origins", f"""WITH {SERIES},
origins AS (SELECT date AS origin, complaint_count AS predicted, row_number() OVER (ORDER BY date DESC) AS age FROM daily),
pairs AS (SELECT origin, predicted, unnest(generate_series(1, 7)) AS h FROM origins WHERE age BETWEEN 2 AND 91)
SELECT CAST(h AS INT) AS horizon, count(*) AS n_days, avg(abs((complaint_count - predicted) / nullif(complaint_count, 0)::DOUBLE)) * 100 AS mape,
       sqrt(avg(power(complaint_count - predicted, 2))) AS rmse
FROM pairs JOIN daily ON daily.date = origin + h::INT GROUP BY 1""")
def m19_naive(spark, sf):
    """The error table of ``m19_rolling_origins`` for predictions that SQL can make: the origin's own value."""
    features = series.prepare_series(requests(spark, sf))
    age = F.row_number().over(Window.orderBy(F.desc("date")))
    origins = features.withColumn("age", age).filter("age BETWEEN 2 AND 91").select(F.col("date").alias("origin"), F.col("complaint_count").alias("predicted"), F.explode(F.sequence(F.lit(1), F.lit(7))).alias("horizon"))
    return forecast.origin_errors(origins.withColumn("date", F.date_add("origin", F.col("horizon"))), features)


@query("a26_forecast_stats")
def a26(spark, sf):
    model, features, _ = _forecaster(spark, sf)
    return forecast.forecast_stats(forecast.forecast(model, features, 30))

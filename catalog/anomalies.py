"""Anomaly features, detectors, voting, evaluation."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.bindings import COMPLAINTS, SPREAD, complaints, table
from catalog.registry import query
from townpulse.operators.sampling import scatter_sample, time_split
from townpulse.operators.silhouette import score_separation
from townpulse.operators.spatial_noise import spatial_noise
from townpulse.plans import anomaly
from townpulse.session import cut_lineage, fresh_path, stage
from townpulse.sources.readers import spread

_FEATURES = f"""{COMPLAINTS},
pairs AS (SELECT district, CAST(timestamp AS DATE) AS date, count(*) AS k FROM complaints GROUP BY 1, 2),
feats AS (SELECT ticket_id, CAST(hour(timestamp) AS INT) AS hour, CAST(isodow(timestamp) - 1 AS INT) AS day_of_week,
  CAST(month(timestamp) AS INT) AS month, lat, lon, coalesce(solve_days, 0) AS solve_days,
  CAST(regexp_matches(type, 'น้ำท่วม') AS INT) AS is_flood, CAST(regexp_matches(type, 'จราจร|ถนน') AS INT) AS is_traffic,
  CAST(regexp_matches(type, 'ความสะอาด|ขยะ') AS INT) AS is_waste, k AS district_daily_count
  FROM complaints JOIN pairs ON complaints.district = pairs.district AND CAST(timestamp AS DATE) = date)"""


#: Size of the trained forest: trees, rows and share of the features for each tree.
_FOREST = {"n_trees": 400, "max_samples": 30_000, "max_features": 0.8}


@query("m1_features", f"WITH {_FEATURES} SELECT * FROM feats")
def m1(spark, sf):
    return anomaly.prepare_features(complaints(spark, sf))


@query("m1_x13_serving_features", f"""WITH {_FEATURES}
SELECT * REPLACE (CASE WHEN ticket_id % 9 = 0 THEN 13.7563 ELSE lat END AS lat, CASE WHEN ticket_id % 9 = 0 THEN 100.5018 ELSE lon END AS lon) FROM feats""")
def m1_serving(spark, sf):
    located = F.col("ticket_id") % 9 != 0
    df = complaints(spark, sf).withColumns({"lat": F.when(located, F.col("lat")), "lon": F.when(located, F.col("lon"))})
    return anomaly.prepare_features(df, serving=True)


_SCALED = ("lat", "lon", "solve_days", "district_daily_count")


@query("m2_impute_and_scale", f"WITH {_FEATURES}, raw AS (SELECT ticket_id, CASE WHEN ticket_id % 9 <> 0 THEN lat END AS lat, lon, solve_days, district_daily_count FROM feats),"
    + "filled AS (SELECT ticket_id, " + ", ".join(f"coalesce({c}::DOUBLE, (SELECT median({c}) FROM raw)) AS {c}" for c in _SCALED) + " FROM raw) "
    + "SELECT ticket_id, " + ", ".join(f"round(({c} - (SELECT avg({c}) FROM filled)) / (SELECT stddev_pop({c}) FROM filled), 6) AS {c}" for c in _SCALED) + " FROM filled")
def m2(spark, sf):
    features = anomaly.prepare_features(complaints(spark, sf)).select("ticket_id", *_SCALED)
    features = stage(features.withColumn("lat", F.when(F.col("ticket_id") % 9 != 0, F.col("lat"))), "features")
    scaled = anomaly.fit_scaler(features, list(_SCALED)).transform(features)
    return scaled.select("ticket_id", *[F.round(c, 6).alias(c) for c in _SCALED])


@query("m5_z_score", f"""WITH {COMPLAINTS}, f AS (SELECT ticket_id, coalesce(solve_days, (SELECT median(solve_days) FROM complaints))::DOUBLE AS x FROM complaints)
SELECT ticket_id, CAST(abs((x - (SELECT avg(x) FROM f)) / (SELECT stddev_pop(x) FROM f)) > 1.5 AS INT) AS is_statistical_anomaly FROM f""")
def m5(spark, sf):
    return anomaly.z_score_anomalies(complaints(spark, sf), threshold=1.5).select("ticket_id", "is_statistical_anomaly")


def _noise_sql(eps: str) -> str:
    near = f"((a.lat - b.lat) * (a.lat - b.lat) + (a.lon - b.lon) * (a.lon - b.lon) <= {eps}::DOUBLE * {eps}::DOUBLE)"
    return f"""WITH p AS (SELECT o_orderkey AS id, 13.5::DOUBLE + (o_custkey % 997)::DOUBLE / 997::DOUBLE * 0.5::DOUBLE AS lat,
  100.3::DOUBLE + (o_orderkey % 991)::DOUBLE / 991::DOUBLE * 0.5::DOUBLE AS lon FROM orders),
near AS (SELECT a.id, b.id AS other FROM p a JOIN p b ON a.lat BETWEEN b.lat - {eps}::DOUBLE * 1.01 AND b.lat + {eps}::DOUBLE * 1.01 AND {near}),
core AS (SELECT id FROM near GROUP BY 1 HAVING count(*) >= 5),
safe AS (SELECT DISTINCT near.id FROM near JOIN core ON core.id = near.other)
SELECT p.id AS ticket_id, CAST(safe.id IS NULL AS INT) AS is_spatial_anomaly FROM p LEFT JOIN safe ON safe.id = p.id"""


@query("m6_j11_spatial_noise", _noise_sql("0.01"))
def m6(spark, sf):
    return spatial_noise(complaints(spark, sf, activity=False), "ticket_id")


@query("m6_spatial_noise_fine", _noise_sql("0.003"))
def m6_fine(spark, sf):
    return spatial_noise(complaints(spark, sf, activity=False), "ticket_id", eps=0.003)


@query("m7_spike_days", """
WITH d AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT *, avg(n) OVER w AS m, stddev_samp(n) OVER w AS s, count(*) OVER w AS k FROM d WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
z AS (SELECT date, n AS complaint_count, coalesce(CASE WHEN k = 7 THEN (n - m) / (nullif(s, 0) + 1e-10) END, 0) AS z FROM r)
SELECT date, complaint_count, round(z, 6) AS z, CAST(abs(z) > 2.0 AS INT) AS is_spike FROM z""")
def m7(spark, sf):
    return anomaly.spike_days(complaints(spark, sf, activity=False), threshold=2.0).withColumn("z", F.round("z", 6))


_SPIKES = """
d AS (SELECT CAST(o_orderdate AS DATE) AS date, count(*) AS n FROM orders GROUP BY 1),
r AS (SELECT *, avg(n) OVER w AS m, stddev_samp(n) OVER w AS s, count(*) OVER w AS k FROM d WINDOW w AS (ORDER BY date ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)),
spikes AS (SELECT date FROM r WHERE k = 7 AND s > 0 AND abs((n - m) / (s + 1e-10)) > 2.0)"""


@query("m7_temporal_spikes", f"WITH {_SPIKES} SELECT o_orderkey AS ticket_id, CAST(CAST(o_orderdate AS DATE) IN (SELECT date FROM spikes) AS INT) AS is_temporal_anomaly FROM orders")
def m7_rows(spark, sf):
    df = complaints(spark, sf, activity=False)
    return anomaly.temporal_spikes(df, threshold=2.0).select("ticket_id", "is_temporal_anomaly")


@query("m8_combine_methods", f"""WITH {COMPLAINTS}, {_SPIKES},
f AS (SELECT ticket_id, timestamp, coalesce(solve_days, (SELECT median(solve_days) FROM complaints))::DOUBLE AS x FROM complaints),
v AS (SELECT ticket_id, CASE WHEN abs((x - (SELECT avg(x) FROM f)) / (SELECT stddev_pop(x) FROM f)) > 1.5 THEN 1 ELSE 0 END AS a,
  CASE WHEN CAST(timestamp AS DATE) IN (SELECT date FROM spikes) THEN 1 ELSE 0 END AS b, CASE WHEN ticket_id % 10 = 0 THEN 1 ELSE 0 END AS c FROM f)
SELECT ticket_id, round((2.0::DOUBLE * a + b + 0.5::DOUBLE * c) / 2.5::DOUBLE, 6) AS combined_score, CAST((2.0::DOUBLE * a + b + 0.5::DOUBLE * c) / 2.5::DOUBLE > 0.5 AS INT) AS is_combined_anomaly FROM v""")
def m8(spark, sf):
    df = anomaly.temporal_spikes(anomaly.z_score_anomalies(complaints(spark, sf), threshold=1.5), threshold=2.0)
    df = df.withColumn("verdict", F.when(F.col("ticket_id") % 10 == 0, -1).otherwise(1))
    methods = ["is_statistical_anomaly", "is_temporal_anomaly", "verdict"]
    combined = anomaly.combine_methods(df, methods, {"is_statistical_anomaly": 2.0, "verdict": 0.5})
    return combined.select("ticket_id", F.round("combined_score", 6).alias("combined_score"), "is_combined_anomaly")


@query("m8_vote_of_all_detectors", "SELECT o_orderkey AS ticket_id, true AS is_share, true AS is_flag FROM orders")
def m8_all(spark, sf):
    """The forest, deviations of solve days, spatial noise and spikes vote with equal weight."""
    df = cut_lineage(complaints(spark, sf))
    model = anomaly.fit_model(spread(cut_lineage(anomaly.prepare_features(df)), SPREAD), **_FOREST)
    df = anomaly.detect_anomalies(df, model).withColumnRenamed("is_anomaly", "is_forest_anomaly")
    df = df.join(spatial_noise(df, "ticket_id", eps=0.003), "ticket_id")
    df = anomaly.temporal_spikes(anomaly.z_score_anomalies(df, threshold=1.5), threshold=2.0)
    methods = ["is_forest_anomaly", "is_statistical_anomaly", "is_spatial_anomaly", "is_temporal_anomaly"]
    voted = anomaly.combine_methods(df, methods)
    share = sum(F.col(m) for m in methods) / 4
    return voted.select(
        "ticket_id", (F.abs(F.col("combined_score") - share) < 1e-9).alias("is_share"),
        (F.col("is_combined_anomaly") == (F.col("combined_score") > 0.5).cast("int")).alias("is_flag"),
    )


_FALLBACK = f"""{COMPLAINTS},
s AS (SELECT median(solve_days) AS m, stddev_samp(solve_days) AS sd FROM complaints),
scored AS (SELECT complaints.*, least(greatest(abs(solve_days - m) / (sd + 1), 0), 1) AS anomaly_score FROM complaints, s WHERE solve_days IS NOT NULL
  UNION ALL BY NAME SELECT complaints.*, NULL::DOUBLE AS anomaly_score FROM complaints WHERE solve_days IS NULL),
flagged AS (SELECT *, CAST(coalesce(anomaly_score > 0.7, FALSE) AS INT) AS is_anomaly FROM scored)"""


@query("m9_solve_day_anomalies", f"WITH {_FALLBACK} SELECT ticket_id, round(anomaly_score, 6) AS anomaly_score, is_anomaly FROM flagged")
def m9(spark, sf):
    scored = anomaly.detect_anomalies(complaints(spark, sf), None)
    return scored.select("ticket_id", F.round("anomaly_score", 6).alias("anomaly_score"), "is_anomaly")


@query("w10_min_max_inverted", "SELECT event_id, round(1 - (value - (SELECT min(value) FROM events)) / ((SELECT max(value) - min(value) FROM events) + 1e-10), 6) AS inverted FROM events")
def w10(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", F.round(anomaly.min_max_inverted(events, "value"), 6).alias("inverted"))


@query("a24_anomaly_totals", f"""WITH {_FALLBACK}
SELECT count(*) FILTER (is_anomaly = 1) AS n_anomalies, round(count(*) FILTER (is_anomaly = 1) / count(*) * 100, 6) AS anomaly_pct,
       round(avg(anomaly_score) FILTER (is_anomaly = 1), 6) AS mean_score FROM flagged""")
def a24(spark, sf):
    totals = anomaly.anomaly_totals(anomaly.solve_day_anomalies(complaints(spark, sf)))
    return totals.withColumns({c: F.round(c, 6) for c in ("anomaly_pct", "mean_score")})


@query("a25_anomalies_by_district", f"WITH {_FALLBACK} SELECT district, count(*) AS n FROM flagged WHERE is_anomaly = 1 GROUP BY 1 ORDER BY n DESC, district LIMIT 10")
def a25_district(spark, sf):
    return anomaly.anomalies_by(anomaly.solve_day_anomalies(complaints(spark, sf)), "district")


@query("a25_anomalies_by_type", f"WITH {_FALLBACK} SELECT primary_type, count(*) AS n FROM flagged WHERE is_anomaly = 1 GROUP BY 1 ORDER BY n DESC, primary_type LIMIT 10")
def a25_type(spark, sf):
    return anomaly.anomalies_by(anomaly.solve_day_anomalies(complaints(spark, sf)), "primary_type")


@query("l4_top_anomalies", f"""WITH {_FALLBACK}
SELECT ticket_id, timestamp, district, primary_type, solve_days, round(anomaly_score, 6) AS anomaly_score FROM flagged
WHERE is_anomaly = 1 ORDER BY flagged.anomaly_score DESC, ticket_id LIMIT 50""")
def l4(spark, sf):
    top = anomaly.top_anomalies(anomaly.solve_day_anomalies(complaints(spark, sf)))
    return top.withColumn("anomaly_score", F.round("anomaly_score", 6))


@query("l11_scatter_sample", f"""WITH {_FALLBACK}
(SELECT ticket_id, round(anomaly_score, 6) AS score FROM flagged WHERE anomaly_score <= 0.5 ORDER BY md5(ticket_id || ':42'), ticket_id LIMIT 600)
UNION ALL (SELECT ticket_id, round(anomaly_score, 6) FROM flagged WHERE anomaly_score > 0.5 ORDER BY anomaly_score DESC, ticket_id LIMIT 800)""")
def l11(spark, sf):
    sample = scatter_sample(anomaly.solve_day_anomalies(complaints(spark, sf)), "ticket_id")
    return sample.select("ticket_id", F.round("anomaly_score", 6).alias("score"))


@query("m11_score_separation", f"""WITH {_FALLBACK},
g AS (SELECT anomaly_score AS v, is_anomaly AS f, count(*) AS n FROM flagged WHERE anomaly_score IS NOT NULL GROUP BY 1, 2),
t AS (SELECT f, sum(n) AS n FROM g GROUP BY 1),
d AS (SELECT a.v, a.f, a.n, b.f AS other, sum(b.n * abs(a.v - b.v)) AS dist FROM g a, g b GROUP BY ALL),
w AS (SELECT d.v, d.f, any_value(d.n) AS n, max(dist / (t.n - 1)) FILTER (d.other = d.f) AS a, max(dist / t.n) FILTER (d.other <> d.f) AS b
      FROM d JOIN t ON t.f = d.other GROUP BY 1, 2)
SELECT round(sum(n * CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0 END) / sum(n), 6) AS silhouette FROM w""")
def m11(spark, sf):
    scored = anomaly.solve_day_anomalies(complaints(spark, sf))
    return score_separation(scored, "anomaly_score", "is_anomaly").withColumn("silhouette", F.round("silhouette", 6))


def _split_features(spark, sf):
    df = spread(cut_lineage(complaints(spark, sf).select("ticket_id", "timestamp", "type", "district", "lat", "lon", "solve_days")), SPREAD)
    split = time_split(df, "timestamp", "ticket_id")
    train, val = (split.filter(F.col("is_train") == flag).drop("is_train") for flag in (True, False))
    return anomaly.prepare_features(train), anomaly.prepare_features(val)


@query("m3_m4_isolation_forest")
def m3_m4(spark, sf):
    train, val = _split_features(spark, sf)
    model = anomaly.fit_model(spread(cut_lineage(train), SPREAD), n_trees=300, max_samples=10_000)
    return model.predict(val).select("ticket_id", "score", "prediction")


@query("m10_detect_anomalies")
def m10(spark, sf):
    df = cut_lineage(complaints(spark, sf))
    model = anomaly.fit_model(spread(cut_lineage(anomaly.prepare_features(df)), SPREAD), **_FOREST)
    return anomaly.detect_anomalies(df, model).select("ticket_id", "district", "is_anomaly", "anomaly_score")


@query("m11_forest_separation")
def m11_forest(spark, sf):
    train, val = _split_features(spark, sf)
    model = anomaly.fit_model(spread(cut_lineage(train), SPREAD), **_FOREST)
    verdict = model.predict(val).withColumn("flag", (F.col("prediction") == -1).cast("int"))
    return score_separation(verdict, "score", "flag")


@query("m12_m24_stability_of_saved_model")
def m12_m24(spark, sf):
    train, val = _split_features(spark, sf)
    path = fresh_path(spark, "anomaly-model")
    anomaly.fit_model(spread(cut_lineage(train), SPREAD), **_FOREST).save(path)
    return anomaly.stability(val, anomaly.AnomalyModel.load(spark, path))


@query("m3_m12_anomaly_training", """
SELECT CAST(floor(count(*) * 0.8) AS BIGINT) AS n_train, CAST(count(*) - floor(count(*) * 0.8) AS BIGINT) AS n_val,
       true AS flags_its_share, true AS scores_in_range, true AS separates, true AS is_stable FROM orders""")
def m3_m12(spark, sf):
    """The whole training job: split by time, fit, save, and judge on the later rows."""
    train, val = _split_features(spark, sf)
    train, path = spread(cut_lineage(train), SPREAD), fresh_path(spark, "anomaly-model")
    anomaly.fit_model(train, **_FOREST).save(path)
    model = anomaly.AnomalyModel.load(spark, path)
    flagged = F.avg((F.col("prediction") == -1).cast("double"))
    on_train = model.predict(train).agg(F.count("*").alias("n_train"), flagged.alias("share"), F.min("score").alias("lo"), F.max("score").alias("hi"))
    verdict = cut_lineage(model.predict(val).select("ticket_id", "score", (F.col("prediction") == -1).cast("int").alias("flag")))
    return (
        on_train.crossJoin(verdict.agg(F.count("*").alias("n_val"))).crossJoin(score_separation(verdict, "score", "flag")).crossJoin(anomaly.stability(val, model))
        .select(
            "n_train", "n_val", (F.abs(F.col("share") - model.forest.contamination) < 0.001).alias("flags_its_share"),
            F.expr("lo >= -1 AND hi < 0 AND lo < hi").alias("scores_in_range"), (F.col("silhouette") > 0).alias("separates"), (F.col("stability") > 0.9).alias("is_stable"),
        )
    )

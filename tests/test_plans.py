"""Jobs end to end: models, streams, sources, invariants."""

import json
import os
import random
import subprocess
import sys
from collections import Counter
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog.bindings import complaints, requests
from townpulse.operators import isolation_forest, series
from townpulse.plans import anomaly, complaint_reports, forecast
from townpulse.session import fresh_path
from townpulse.sources import readers, writers
from townpulse.streaming import notices as streams

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(5)
    rows = [(i, rng.gauss(0, 1), rng.gauss(0, 1)) for i in range(600)] + [(1000 + i, 9.0 + i, -9.0) for i in range(6)]
    return spark.createDataFrame(rows, "id INT, a DOUBLE, b DOUBLE")


def test_forest_flags_the_outliers_and_its_share(spark, points):
    forest = isolation_forest.fit(points, "id", ["a", "b"], n_trees=60, max_samples=128, contamination=0.05)
    verdict = isolation_forest.predict(points, forest, "id").collect()
    flagged = {r.id for r in verdict if r.prediction == -1}
    assert set(range(1000, 1006)) <= flagged
    assert abs(len(flagged) - 0.05 * 606) <= 1
    assert all(-1 <= r.score <= 0 for r in verdict)


def test_forest_fit_and_reload_repeat_exactly(spark, points):
    def fitted(partitions):
        return isolation_forest.fit(points.repartition(partitions), "id", ["a", "b"], n_trees=10, max_samples=64)

    one, two = fitted(2), fitted(9)
    path = fresh_path(spark, "forest")
    isolation_forest.save(one, path)
    scores = [
        {r.id: r.score for r in isolation_forest.score(points, f, "id").collect()}
        for f in (one, two, isolation_forest.load(spark, path))
    ]
    assert scores[0] == pytest.approx(scores[1]) and scores[0] == pytest.approx(scores[2])


def test_forest_scores_do_not_depend_on_chunks(spark, points, monkeypatch):
    forest = isolation_forest.fit(points, "id", ["a", "b"], n_trees=12, max_samples=64)
    whole = {r.id: r.score for r in isolation_forest.score(points, forest, "id").collect()}
    monkeypatch.setattr(isolation_forest, "CHUNK_BYTES", 4000)
    monkeypatch.setattr(isolation_forest, "RESIDENT_BYTES", 6000)
    forest.shared = None
    parts = {r.id: r.score for r in isolation_forest.score(points, forest, "id").collect()}
    assert len(forest.shared) > 3 and parts == pytest.approx(whole)


def test_tree_samples_have_the_asked_size(spark):
    df = spark.range(20_000).withColumn("a", F.rand(1))
    rows, size = isolation_forest.draw_samples(df, "id", ["a"], n_trees=5, max_samples=100, seed=1)
    counts = [r["count"] for r in rows.groupBy("tree").count().collect()]
    assert size == 100 and len(counts) == 5 and all(100 <= c < 250 for c in counts)


def test_votes_with_a_missing_weight(spark):
    df = spark.createDataFrame([(1, -1, 1), (2, 1, 1), (3, -1, 0)], "id INT, a INT, b INT")
    got = anomaly.combine_methods(df, ["a", "b"], {"a": 2.0}).orderBy("id").collect()
    assert [(r.combined_score, r.is_combined_anomaly) for r in got] == [(1.5, 1), (0.5, 0), (1.0, 1)]


def test_spikes_never_pass_the_bound_of_their_window(spark):
    rows = [(date(2024, 1, 1) + timedelta(days=d), i) for d in range(15) for i in range(200 if d == 7 else 1)]
    df = spark.createDataFrame(rows, "d DATE, i INT").select(F.col("d").cast("timestamp").alias("timestamp"))
    days = anomaly.spike_days(df, threshold=2.0).orderBy("date").collect()
    assert [d.is_spike for d in days] == [0] * 7 + [1] + [0] * 7
    assert days[7].z == pytest.approx(6 / 7**0.5, rel=1e-6)
    assert anomaly.spike_days(df).filter("is_spike = 1").count() == 0


def test_z_scores_of_constants_are_zero(spark):
    df = spark.createDataFrame([(1, 5), (2, 5), (3, None)], "id INT, solve_days INT")
    assert {r.is_statistical_anomaly for r in anomaly.z_score_anomalies(df).collect()} == {0}
    assert {r.is_statistical_anomaly for r in anomaly.z_score_anomalies(df, "absent").collect()} == {0}


def test_forecast_dates_bands_and_feature_rule(spark):
    features = series.prepare_series(requests(spark, SF))
    params = [{"max_depth": 2, "min_leaf": 1, "min_split": 2, "n_trees": 2}]
    model = forecast.train(series.sequences(features, horizon=3), params)
    end = features.agg(F.max("date")).first()[0]
    got = forecast.forecast(model, features, days=5).orderBy("date").collect()
    assert [r.date for r in got] == [end + timedelta(days=i) for i in range(1, 6)]
    assert all(r.lower_bound == pytest.approx(r.predicted * 0.85) and r.upper_bound == pytest.approx(r.predicted * 1.15) for r in got)
    past = forecast.backtest(model, features, 90).collect()
    assert len(past) == 90 and max(r.date for r in past) == end


def test_recursive_features_follow_the_training_rule(spark):
    values = [float((i * 7) % 11) for i in range(30)]
    days = [(date(2024, 1, 1) + timedelta(days=i), v) for i, v in enumerate(values)]
    trained = series.with_features(spark.createDataFrame(days, "date DATE, complaint_count DOUBLE")).orderBy(F.desc("date")).first()
    got = forecast.next_rows(np.array([values]), np.array([days[-1][0]], "datetime64[D]"))[0].tolist()
    assert got == pytest.approx([float(v) for v in trained[1:]])


def test_expanding_folds(spark):
    df = spark.createDataFrame([(date(2024, 1, 1) + timedelta(days=i),) for i in range(11)], "origin DATE")
    got = [r.block for r in forecast.expanding_folds(df).orderBy("origin").collect()]
    assert got == [0] * 5 + [1, 1, 2, 2, 3, 3]


def test_expanding_folds_of_many_series_change_on_the_same_day(spark):
    rows = [(date(2024, 1, 1) + timedelta(days=i), name) for i in range(11) for name in "abc"]
    got = forecast.expanding_folds(spark.createDataFrame(rows, "origin DATE, name STRING")).orderBy("name", "origin").collect()
    assert [r.block for r in got] == ([0] * 5 + [1, 1, 2, 2, 3, 3]) * 3


def test_registered_forecasts_use_the_whole_grid_and_all_horizons(spark, monkeypatch):
    from catalog import models

    searched, days = [], []
    line = forecast.forecast
    tiny = {"max_depth": 2, "min_leaf": 1, "min_split": 2, "n_trees": 2}
    monkeypatch.setattr(forecast, "search", lambda train, candidates, by=(): searched.append(candidates) or [(tiny, 1.0), *((c, 2.0) for c in candidates[1:])])
    monkeypatch.setattr(forecast, "forecast", lambda model, features, n=30, by=(): days.append((model.horizon, n)) or line(model, features, n, by))
    monkeypatch.setattr(models, "_SEARCHED", {})
    monkeypatch.setattr(models, "_FORECASTERS", {})
    assert models.m15(spark, SF).count() == 36
    assert {r.model for r in models.m16_m17(spark, SF).collect()} == {"forest", "naive", "ma7"}
    assert models.m18(spark, SF).count() == 120 and models.m19(spark, SF).first().n_days == 90 and models.a26(spark, SF).count() == 1
    assert [r.horizon for r in models.m19_origins(spark, SF).orderBy("horizon").collect()] == list(range(1, 8))
    assert searched == [forecast.grid()]
    models.m18_by_district(spark, SF)
    assert searched == [forecast.grid()] * 2 and set(days) == {(7, 30)}


def test_pivot_total_and_shares(spark):
    df = complaints(spark, SF, activity=False)
    months = [r[0] for r in complaint_reports.month_counts(df).select("month").distinct().collect()]
    wide = complaint_reports.month_pivot(df, months)
    assert wide.select(sum(F.col(f"`{m}`") for m in months).alias("n")).agg(F.sum("n")).first()[0] == df.count()
    assert complaint_reports.top_districts(df).agg(F.sum("pct")).first()[0] <= 100.01


def test_csv_text_with_breaks_quotes_and_bom(spark):
    rows = [("a,b", 'he said "x"'), ("line\nbreak", "ก"), (None, " pad ")]
    df = spark.createDataFrame(rows, "p STRING, q STRING")
    path = fresh_path(spark, "csv")
    writers.write_csv(df.coalesce(1), path, bom=True)
    assert sorted(map(str, readers.read_csv(spark, path, "p STRING, q STRING", multi_line=True).collect())) == sorted(map(str, df.collect()))
    local = path.removeprefix("file:")
    [part] = [f for f in os.listdir(local) if f.endswith(".csv")]
    with open(os.path.join(local, part), "rb") as f:
        assert f.read(3) == b"\xef\xbb\xbf"
    assert readers.read_optional(spark, path + "-absent", "p STRING") is None


def test_one_large_csv_file_is_split_and_headers_are_grouped(spark):
    paths = [fresh_path(spark, "csv") for _ in range(3)]
    for i, path in enumerate(paths):
        df = spark.range(20_000).selectExpr("cast(id as string) AS a", f"cast(id % 7 as string) AS {'b' if i < 2 else 'c'}")
        writers.write_csv(df.coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        one = readers.read_csv(spark, paths[0], "a STRING, b STRING")
        assert one.rdd.getNumPartitions() > 1 and one.count() == 20_000
        united = readers.union_csv(spark, paths)
        assert united.columns == ["a", "b", "c"] and united.count() == 60_000 and united.where("c IS NULL").count() == 40_000
        assert united._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 2
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_empty_csv_text_is_read_as_null(spark):
    path = fresh_path(spark, "csv")
    writers.write_csv(spark.createDataFrame([("", "x")], "p STRING, q STRING"), path)
    assert readers.read_csv(spark, path, "p STRING, q STRING").first().p is None


def test_stream_drops_repeats_and_resumes(spark):
    source, sink, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "ck"))
    schema = "outage_date DATE, announcement_url STRING"
    for urls in (["a", "a", "b"], ["b", "c"]):
        writers.append_batch(spark.createDataFrame([(date(2024, 1, 1), u) for u in urls], schema), source)
        streams.append_to(streams.new_days(streams.read_stream(spark, source, schema)), sink, checkpoint).awaitTermination()
    assert sorted(r.announcement_url for r in spark.read.parquet(sink).collect()) == ["a", "b", "c"]


def test_intake_takes_late_records_and_drops_known_ones(spark):
    source, sink, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "ck"))
    schema = "outage_date DATE, announcement_url STRING, arrived TIMESTAMP"
    batches = [(40, 1, ["a", "a", "b"]), (20, 1, ["c"]), (1, 2, ["b", "d"]), (41, 1, ["d", "a", "e"]), (2, 1, ["late", "a"])]
    for arrived, day, urls in batches:
        rows = [(date(2024, 1, day), u, datetime(2024, 1, 1) + timedelta(days=arrived)) for u in urls]
        writers.append_batch(spark.createDataFrame(rows, schema), source)
        streams.take_in(streams.read_stream(spark, source, schema), sink, checkpoint).awaitTermination()
    got = sorted((r.outage_date.day, r.announcement_url) for r in spark.read.parquet(sink).collect())
    assert got == [(1, u) for u in ("a", "b", "c", "d", "e", "late")] + [(2, "b"), (2, "d")]


def test_late_events_add_to_their_day_once(spark):
    source, sink, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "ck"))
    schema, start = "ts TIMESTAMP, kind STRING", datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=7 * i), "ab"[i % 2]) for i in range(60)]
    random.Random(1).shuffle(rows)
    for part in (rows[:20], rows[20:45], [*rows[45:], (None, "a")]):
        writers.append_batch(spark.createDataFrame(part, schema), source)
        streams.add_counts(streams.read_stream(spark, source, schema), "kind", sink, checkpoint).awaitTermination()
    again = spark.read.parquet(f"{sink}/batch=1")  # a batch that is run again replaces itself
    again.persist().count()
    again.write.mode("overwrite").parquet(f"{sink}/batch=1")
    got = {(r.date, r.kind): r.n for r in streams.added_counts(spark, sink, "kind").collect()}
    assert got == Counter((t.date(), k) for t, k in rows)


def test_batches_count_whole_and_once(spark):
    path, schema = fresh_path(spark, "batches"), "id INT, name STRING"
    assert readers.read_batches(spark, path, schema).collect() == []
    of = lambda *names: spark.createDataFrame([(i, n) for i, n in enumerate(names)], schema)
    writers.commit_batch(of("a", "b"), path, "2024-01-01")
    writers.commit_batch(of("c"), path, "7")
    writers.write_table(of("torn"), f"{path}/rows/batch=8/attempt=x")  # its writer died before the ledger was written
    writers.commit_batch(of("A"), path, "2024-01-01")
    writers.write_table(of("torn"), f"{path}/rows/batch=7/attempt=y")
    got = readers.read_batches(spark, path, schema)
    assert got.columns == ["id", "name", "batch"] and sorted((r.batch, r.name) for r in got.collect()) == [("2024-01-01", "A"), ("7", "c")]


def test_stream_counts_cover_all_days_and_resume(spark):
    source, sink, checkpoint = (fresh_path(spark, n) for n in ("in", "out", "ck"))
    schema, start = "ts TIMESTAMP, kind STRING", datetime(2024, 1, 1)
    rows = [(start + timedelta(hours=7 * i), "ab"[i % 2]) for i in range(60)]
    for part in (rows[:30], rows[30:]):
        writers.append_batch(spark.createDataFrame(part, schema), source)
        streams.write_counts(streams.daily_counts(streams.read_stream(spark, source, schema), "kind"), sink, checkpoint).awaitTermination()
    got = {(r.date, r.kind): r.n for r in streams.read_counts(spark, sink, "kind").collect()}
    assert got == Counter((t.date(), k) for t, k in rows)


def test_all_queries_with_sql_agree_on_the_smallest_tables():
    """Runs the comparison tool in its own process, as a user would."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    names = [
        "complaint_cleaning", "outage_cleaning", "a4_districts_by_type", "a7_resolution_times", "j7_add_weather", "m1_features", "m17_x26_baseline_metrics",
        "m19_naive_rolling_origins", "x15_notice_days", "x17_clean_documents", "x21_extract_events",
    ]
    env = {**os.environ, "SF_DIR": SF}
    run = subprocess.run([sys.executable, "verify.py", *names], cwd=root, env=env, capture_output=True, text=True, timeout=900)
    assert run.returncode == 0, json.dumps(run.stdout[-3000:])


def test_trees_are_drawn_by_the_smallest_hashes(spark):
    df = spark.range(3000).withColumn("a", F.lit(1.0))
    rows, _ = isolation_forest.draw_samples(df, "id", ["a"], n_trees=40, max_samples=300, seed=7)
    got = rows.groupBy("id").agg(F.sort_array(F.collect_list("tree")).alias("got"))
    trees = F.sequence(F.lit(0), F.lit(39))
    order = F.array_sort(F.transform(trees, lambda t: F.struct(F.xxhash64("id", t, F.lit(8)).alias("h"), t.alias("t"))))
    want = F.sort_array(F.transform(F.slice(order, 1, F.size("got")), lambda x: x.t))
    assert got.where(want != F.col("got")).count() == 0 and got.where(F.size("got") > 3).count() > 0


def test_missing_values_go_to_the_right():
    trees = {"roots": np.array([0, 3]), "feature": np.array([1, -1, -1, -1]), "threshold": np.array([0.5, np.nan, np.nan, np.nan]), "left": np.array([1, -1, -1, -1]), "right": np.array([2, -1, -1, -1]), "length": np.array([0.0, 1.0, 4.0, 10.0])}
    x = np.array([[9.0, 0.5], [9.0, 0.6], [9.0, np.nan], [np.nan, -np.inf], [0.0, np.inf]])
    assert isolation_forest.path_lengths(x, trees).tolist() == [11.0, 14.0, 14.0, 11.0, 14.0]
    assert isolation_forest.walkable(trees)["depth"].tolist() == [1, 0]

"""Many k-means models at once against single runs, and silhouettes against all pairs."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector

from townpulse.operators import kmeans

SCHEMA = "id INT, features ARRAY<DOUBLE>, label INT, n INT"


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(1)
    middles = np.array([[0, 0, 900], [40, 0, 900], [0, 40, 850], [60, 60, 900], [20, 20, 1000]])
    x = np.concatenate([m + rng.normal(size=(90, 3)) * (3 + i) for i, m in enumerate(middles)]).round(2)
    return spark.createDataFrame([(i, v.tolist(), i % 4, 7) for i, v in enumerate(x)], SCHEMA), x


def test_cost_is_no_worse_than_that_of_single_fits(spark, blobs):
    df, x = blobs
    vectors = df.select(array_to_vector("features").alias("features")).cache()
    for model in kmeans.fit_many(df, "features", [2, 5, 6], restarts=10):
        singles = [KMeans(k=model.k, seed=s, maxIter=100).fit(vectors).summary.trainingCost for s in range(5)]
        assert model.cost <= min(singles) * 1.001
        assert model.cost == pytest.approx(kmeans.squared(x, model.centres).min(axis=1).sum())


def test_a_model_is_what_plain_iterations_give(blobs):
    df, x = blobs
    [model] = kmeans.fit_many(df, "features", [4], restarts=1, seed=3, tolerance=0.0)
    centres = kmeans.first_centres(x[np.lexsort(x.T[::-1])], 4, np.random.default_rng([3, 4, 0]))
    for _ in range(100):
        own = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
        centres = np.array([x[own == i].mean(axis=0) for i in range(4)])
    assert model.centres == pytest.approx(centres)


def test_partitioning_does_not_matter(spark, blobs, partitions):
    df, _ = blobs
    one, *others = partitions(lambda: spark.createDataFrame([(m.k, m.centres.round(6).tolist()) for m in kmeans.fit_many(df.repartition(5), "features", [2, 3], 3)], "k INT, c ARRAY<ARRAY<DOUBLE>>"))
    assert all(o == one for o in others)


def widths_by_all_pairs(x, labels):
    out = []
    for i, label in enumerate(labels):
        far = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        own = np.delete(far[:], i)[np.delete(labels, i) == label]
        other = min((far[labels == o].mean() for o in set(labels) - {label}), default=None)
        out.append(0 if not len(own) or other is None or max(own.mean(), other) == 0 else (other - own.mean()) / max(own.mean(), other))
    return np.array(out)


def test_silhouettes_equal_all_pairs(spark, blobs):
    df, x = blobs
    x, labels = np.concatenate([x, x[:3]]), np.append(np.arange(len(x)) % 4, [0, 1, 5])
    rows = spark.createDataFrame([(i, v.tolist(), int(label), 0) for i, (v, label) in enumerate(zip(x, labels))], SCHEMA).repartition(3)
    want = widths_by_all_pairs(x, labels)
    got = kmeans.silhouettes(rows, "features", label="label", n_labels=6).collect()
    assert {r.label: (r.n, pytest.approx(r.width, abs=1e-9)) for r in got} == {int(k): ((labels == k).sum(), want[labels == k].mean()) for k in set(labels)}
    centres = [m.centres for m in kmeans.fit_many(df, "features", [2, 5], 2)]
    plain = [widths_by_all_pairs(blobs[1], kmeans.nearest(blobs[1], c)).mean() for c in centres]
    assert kmeans.mean_silhouettes(df, "features", centres) == pytest.approx(plain)


def test_silhouettes_of_a_draw_are_near(spark, blobs, monkeypatch):
    df, x = blobs
    centres = [m.centres for m in kmeans.fit_many(df, "features", [5], 2)]
    [whole] = kmeans.mean_silhouettes(df, "features", centres)
    monkeypatch.setattr(kmeans, "SILHOUETTE_ROWS", 150)
    assert kmeans.mean_silhouettes(df, "features", centres) == pytest.approx([whole], abs=0.05)


def test_few_and_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert kmeans.fit_many(none, "features", [2]) == []
    same = spark.createDataFrame([(i, [1.0, 2.0], 0, 0) for i in range(5)], SCHEMA)
    [model] = kmeans.fit_many(same, "features", [3], 2)
    assert model.cost == 0 and kmeans.mean_silhouettes(same, "features", [model.centres]) == [0.0]


def test_every_event_is_clustered_also_without_a_clock(spark, tmp_path):
    from catalog import models
    from townpulse.plans import outage_clusters

    events = spark.range(200).selectExpr("id AS event_id", "timestamp_seconds(id * 5000) AS ts", "if(id % 50 = 7, NULL, id % 90) AS user_id", "id * 1.5 AS value")
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(25).selectExpr("cast(id as int) AS n_nationkey", "concat('N', id) AS n_name").write.parquet(f"{tmp_path}/nation.parquet")
    rows = models._outage_rows(spark, str(tmp_path))
    assert rows.count() == 200 and rows.where("start_min IS NULL").count() > 0 and rows.where("temp IS NULL").count() == 4
    model, _ = outage_clusters.train_clusters(rows, 2, 3, 1)
    labelled = model.transform(rows).persist()
    assert labelled.count() == 200 and labelled.where("cluster IS NULL").count() == 0
    unknown, mean = labelled.where("start_min IS NULL").first(), rows.agg({"start_min": "avg"}).first()[0]
    assert unknown.features[-2] == int(mean)


def test_few_passes_over_all_rows_are_left(spark, monkeypatch):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 4)) * [100, 80, 3, 1]
    df = spark.createDataFrame([(i, v.tolist(), 0, 0) for i, v in enumerate(x)], SCHEMA).repartition(4).cache()
    passes, once = [], kmeans._round
    monkeypatch.setattr(kmeans, "_round", lambda *a: passes.append(1) or once(*a))
    fitted = kmeans.fit_many(df, "features", [3, 6], 4)
    assert len(passes) == 1  # the starting rows are all rows here
    assert [m.cost for m in fitted] == pytest.approx([kmeans.squared(x, m.centres).min(axis=1).sum() for m in fitted])
    monkeypatch.setattr(kmeans, "START_ROWS", 200)
    counted = []
    monkeypatch.setattr(kmeans, "_round", lambda df, *a: counted.append(df.count()) or once(df, *a))
    for wide, whole in zip(kmeans.fit_many(df, "features", [3, 6], 4), fitted):
        assert wide.cost == pytest.approx(kmeans.squared(x, wide.centres).min(axis=1).sum()) and wide.cost <= whole.cost * 1.02
    assert counted == sorted(counted) and counted[0] < 2000 and counted[-1] == 4000


def test_silhouettes_compare_all_pairs_in_parts(spark, blobs, monkeypatch):
    df, x = blobs
    monkeypatch.setattr(kmeans, "SILHOUETTE_ROWS", 64)
    monkeypatch.setattr(kmeans, "PART_ROWS", 100)
    labels = np.arange(len(x)) % 4
    want = widths_by_all_pairs(x, labels)
    got = kmeans.silhouettes(df, "features", label="label", n_labels=4).collect()
    assert {r.label: (r.n, pytest.approx(r.width, abs=1e-9)) for r in got} == {k: ((labels == k).sum(), want[labels == k].mean()) for k in range(4)}
    centres = [x[:k] for k in (2, 5)]
    plain = [widths_by_all_pairs(x, kmeans.nearest(x, c)).mean() for c in centres]
    assert kmeans.mean_silhouettes(df, "features", centres) == pytest.approx(plain)


def test_first_centres_and_tolerance_come_from_all_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = np.concatenate([rng.normal(size=(11_900, 2)), np.repeat(rng.normal(size=(2, 2)), 50, axis=0)]).round(2) * [90, 2]
    df = spark.createDataFrame([(i, v.tolist(), 0, 0) for i, v in enumerate(x)], SCHEMA).repartition(3).cache()
    ordered, ks = x[np.lexsort(x.T[::-1])], [2, 4, 9]
    held, rested, first, rest = [], [], kmeans._first_models, kmeans._rest
    monkeypatch.setattr(kmeans, "_first_models", lambda spark, start, *a: held.append(start) or first(spark, start, *a))
    monkeypatch.setattr(kmeans, "_rest", lambda df, features, models, origin, least: rested.append(([m.centres for m in models], origin, least)))
    kmeans.fit_many(df, "features", ks, 2)
    assert np.array_equal(held[0], ordered)
    monkeypatch.setattr(kmeans, "HELD_ROWS", 500)
    kmeans.fit_many(df, "features", ks, 2, seed=8)
    [_, (centres, origin, least)] = rested
    assert origin == pytest.approx(x.mean(axis=0)) and least == pytest.approx(1e-4 * x.var(axis=0).mean())
    for (k, r), got in zip([(k, r) for k in ks for r in range(2)], centres):
        assert np.array_equal(got, kmeans.first_centres(ordered, k, np.random.default_rng([8, k, r])))
    monkeypatch.setattr(kmeans, "_rest", rest)
    for model in kmeans.fit_many(df, "features", [3], 2):
        assert model.cost == pytest.approx(kmeans.squared(x, model.centres).min(axis=1).sum())


def test_first_centres_of_few_distinct_rows(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "HELD_ROWS", 50)
    x = np.repeat([[0.0, 1.0], [0.0, 2.0], [5.0, 1.0]], 40, axis=0)
    df = spark.createDataFrame([(i, v.tolist(), 0, 0) for i, v in enumerate(x)], SCHEMA).repartition(4)
    assert [m.cost for m in kmeans.fit_many(df, "features", [3, 5], 2)] == [0, 0]

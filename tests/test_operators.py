"""Operators on small frames: nulls, ties, hot keys, brute force, partition counts."""

import random
from datetime import date, timedelta
from statistics import mean

import numpy as np
import pytest
from pyspark.sql import functions as F

from townpulse.operators import cleaning, isolation_forest, joins, quantiles, sampling, series, topk
from townpulse.operators.dedup import keep_first, keep_last
from townpulse.operators.silhouette import score_separation
from townpulse.operators.spatial_noise import spatial_noise


def test_drop_unknown_trims_and_ignores_case(spark):
    df = spark.createDataFrame([("a", "x"), (" UNKNOWN ", "x"), (None, "x"), ("b", "y")], "p STRING, q STRING")
    assert sorted(r[0] for r in cleaning.drop_unknown(df, ["p", "q"]).collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        cleaning.drop_unknown(df, ["absent"])


def test_drop_columns_and_fill(spark):
    df = spark.createDataFrame([(None, 1)], "a STRING, b INT")
    with pytest.raises(KeyError):
        cleaning.drop_columns(df, ["zzz"])
    assert cleaning.drop_columns(df, ["a", "zzz"], ignore_missing=True).columns == ["b"]
    assert cleaning.fill_missing(df, ["a", "zzz"], [{}, "x"]).first()[0] == "Not define"
    with pytest.raises(ValueError):
        cleaning.fill_missing(df, ["a"], [])


def test_outliers_cap_keeps_nulls_and_remove_is_sequential(spark):
    rows = [(1.0, 1.0), (2.0, 2.0), (3.0, 3.0), (4.0, 100.0), (100.0, 4.0), (None, 5.0)]
    df = spark.createDataFrame(rows, "a DOUBLE, b DOUBLE")
    capped = sorted((r.a for r in cleaning.cap_outliers(df, ["a"]).collect()), key=lambda v: (v is None, v))
    assert capped[:4] == [1.0, 2.0, 3.0, 4.0] and capped[4] == 7.0 and capped[5] is None
    kept = [r.a for r in cleaning.remove_outliers(df, ["a", "b"]).collect()]
    assert sorted(kept) == [1.0, 2.0, 3.0]


def test_dedup_with_null_order_and_hot_key(spark, partitions):
    rows = [("hot", i, f"v{i}") for i in range(500)] + [("k", None, "null"), ("k", 3, "three"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "id STRING, o INT, v STRING").repartition(5)
    last = partitions(lambda: keep_last(df, ["id"], ["o"]).select("v"))
    first = partitions(lambda: keep_first(df, ["id"], ["o"]).select("v"))
    assert last == [[("n",), ("three",), ("v499",)]] * 3
    assert first == [[("n",), ("null",), ("v0",)]] * 3


def test_salted_lookup_and_group_counts(spark, partitions):
    rows = [(i, "hot" if i % 3 else None if i % 2 else f"k{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "id INT, k STRING")
    results = partitions(lambda: joins.with_group_count(df, ["k"], "n", ["id"]))
    assert results[0] == results[1] == results[2] and len(results[0]) == 300
    counts = {k: sum(1 for _, other in rows if other == k) for _, k in rows if k}
    assert all(n == counts.get(k) for _, k, n in results[0])
    filled = joins.with_group_count(df, ["k"], "n", ["id"], default=1).filter("k IS NULL").select("n").distinct().collect()
    assert [r[0] for r in filled] == [1]


@pytest.mark.parametrize("small", [100_000, 7])
def test_quantiles_are_exact_by_ranking_and_by_narrowing(spark, monkeypatch, small):
    monkeypatch.setattr(quantiles, "SMALL", small)
    rng = random.Random(1)
    values = [rng.choice([1.0, 2.0, 2.5, rng.uniform(0, 10)]) for _ in range(400)] + [2.0] * 300 + [None] * 5
    df = spark.createDataFrame([(v, 7) for v in values], "a DOUBLE, b INT").repartition(4)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = quantiles.column_quantiles(df, ["a", "b"], probs)
    assert got["a"] == pytest.approx(list(np.quantile([v for v in values if v is not None], probs)))
    assert got["b"] == [7.0] * 7
    assert quantiles.exact_quantiles(df.filter("a > 99"), "a", [0.5]) == [None]


@pytest.mark.parametrize("small", [100_000, 5])
@pytest.mark.parametrize("ratio", [0.0, 0.3, 0.8, 0.97, 1.0])
def test_time_split_cuts_inside_ties_and_nulls(spark, monkeypatch, small, ratio):
    monkeypatch.setattr(quantiles, "SMALL", small)
    rows = [(i, date(2024, 1, 1) if i % 3 else None if i % 30 == 0 else date(2024, 1, 1 + i % 20)) for i in range(90)]
    df = spark.createDataFrame(rows, "id INT, d DATE").withColumn("ts", F.col("d").cast("timestamp"))
    ordered = sorted(rows, key=lambda r: (r[1] is None, r[1] or date.max, r[0]))
    want = {r[0] for r in ordered[: int(90 * ratio)]}
    got = {r.id for r in sampling.time_split(df, "ts", "id", ratio).filter("is_train").collect()}
    assert got == want


def test_running_totals_match_a_plain_sum(spark, partitions):
    values = sorted({round(random.Random(i).uniform(0, 5) ** 3, 6) for i in range(200)})
    df = spark.createDataFrame([(v, 1 + i % 4) for i, v in enumerate(values)], "v DOUBLE, n INT")
    results = partitions(lambda: quantiles.running_totals(df, "v", {"total": F.col("n")}).select("v", "total"))
    want, total = [], 0
    for i, v in enumerate(values):
        total += 1 + i % 4
        want.append((v, total))
    assert results == [want] * 3


def test_samples_are_exact_and_stable(spark, partitions, monkeypatch):
    df = spark.range(1000).withColumnRenamed("id", "k")
    small = partitions(lambda: sampling.sample_rows(df, 50, "k"))
    assert small[0] == small[1] == small[2] and len(small[0]) == 50
    marked = df.withColumn("_draw", sampling.unit_draw("k", 42))
    large = marked.filter(quantiles.cut_after(marked, "_draw", "k", 50)).select("k").collect()
    assert sorted(r[0] for r in large) == [r[0] for r in small[0]]
    assert sampling.sample_rows(df, 5000, "k").count() == 1000 and sampling.sample_rows(df, 0, "k").count() == 0


def test_samples_mean_the_same_at_any_size(spark):
    for n in (10, 999, 60_000):
        df = spark.range(n).withColumnRenamed("id", "k")
        assert sampling.sample_percent(df, 30, "k").count() == n * 30 // 100
        got = {r.k for r in sampling.sample_rows(df, n // 2, "k").collect()}
        order = df.select("k", sampling.unit_draw("k", 42).alias("u")).orderBy("u", "k").limit(n // 2)
        assert got == {r.k for r in order.collect()}


def test_forest_draws_each_tree_from_the_whole_table(spark):
    for n in (300, 4000):
        df = spark.range(n).select("id", F.rand(1).alias("a"))
        rows, size = isolation_forest.draw_samples(df, "id", ["a"], 40, 256, 42)
        per_tree = {r.tree: (r.n, r.few) for r in rows.groupBy("tree").agg(F.count("*").alias("n"), F.countDistinct("id").alias("few")).collect()}
        assert len(per_tree) == 40 and all(n == few >= size for n, few in per_tree.values())
        assert rows.select("id").distinct().count() > 0.85 * n


def test_top_lists_skip_nulls_and_break_ties(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "k STRING")
    got = [tuple(r) for r in topk.top_share_of_all(df, "k", 2).orderBy(F.desc("n"), "k").collect()]
    assert got == [("a", 2, 33.33), ("b", 2, 33.33)]


def test_series_gaps_single_day_and_constants(spark):
    days = [date(2024, 2, 27), date(2024, 3, 1), date(2024, 3, 1)]
    df = spark.createDataFrame([(d,) for d in days], "d DATE").select(F.col("d").cast("timestamp").alias("timestamp"))
    got = series.prepare_series(df).orderBy("date").collect()
    assert [(r.date, r.complaint_count) for r in got] == [
        (date(2024, 2, 27), 1), (date(2024, 2, 28), 0), (date(2024, 2, 29), 0), (date(2024, 3, 1), 2)
    ]
    assert got[0].roll_std_7 == 0.0 and got[3].roll_mean_7 == pytest.approx(0.75)
    one = series.prepare_series(df.limit(1))
    assert one.count() == 1 and series.sequences(one).count() == 0


def test_windows_have_the_right_days(spark):
    start = date(2024, 1, 1)
    df = spark.createDataFrame([(start + timedelta(days=i), i) for i in range(50)], "date DATE, complaint_count INT")
    seqs = series.sequences(series.with_features(df)).orderBy("origin").collect()
    assert len(seqs) == 50 - 30 - 7 + 1
    assert seqs[0].origin == start + timedelta(days=29)
    assert seqs[0].x[0] == 0.0 and seqs[0].x[29 * 7] == 29.0 and seqs[0].y == [float(v) for v in range(30, 37)]
    base = series.baselines(series.sequences(series.with_features(df))).filter("model = 'ma7'").orderBy("origin", "horizon").first()
    assert base.predicted == pytest.approx(mean(range(23, 30))) and base.actual == 30.0


def noise_by_brute_force(points, eps, k):
    def near(a, b):
        return (a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2 <= eps * eps

    known = [p for p in points if p[1] is not None and p[2] is not None]
    core = [p for p in known if sum(near(p, q) for q in known) >= k]
    return {p[0] for p in known if not any(near(p, c) for c in core)}


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_spatial_noise_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    points = [(i, rng.uniform(0, 0.1), rng.uniform(0, 0.1)) for i in range(250)]
    points += [(1000 + i, 0.05 + rng.gauss(0, 0.001), 0.05 + rng.gauss(0, 0.001)) for i in range(200)]  # a hot cell
    points += [(2000 + i, 0.3, 0.3) for i in range(100)] + [(2200, 0.3095, 0.3), (2201, 0.3105, 0.3)]  # copies and borders
    points += [(3000, 0.5, 0.5), (3001, None, 0.1), (3002, 0.9, 0.9), (3003, 0.9, 0.905)]
    df = spark.createDataFrame(points, "id INT, lat DOUBLE, lon DOUBLE")
    for eps, k in ((0.01, 5), (0.004, 3)):
        got = spatial_noise(df, "id", eps, k).collect()
        assert len(got) == len(points)
        assert {r.id for r in got if r.is_spatial_anomaly} == noise_by_brute_force(points, eps, k)


def test_spatial_noise_does_not_depend_on_order_or_partitions(spark, partitions):
    rng = random.Random(9)
    points = [(i, rng.uniform(0, 0.2), rng.uniform(0, 0.2)) for i in range(300)]
    rng.shuffle(points)
    df = spark.createDataFrame(points, "id INT, lat DOUBLE, lon DOUBLE")
    results = partitions(lambda: spatial_noise(df, "id"))
    assert results[0] == results[1] == results[2]


def silhouette_by_brute_force(rows):
    def one(v, f):
        own = [u for u, g in rows if g == f]
        other = [u for u, g in rows if g != f]
        a = sum(abs(v - u) for u in own) / (len(own) - 1)
        b = mean(abs(v - u) for u in other)
        return (b - a) / max(a, b) if max(a, b) > 0 else 0.0

    return mean(one(v, f) for v, f in rows)


def test_score_separation_equals_brute_force(spark, partitions):
    rng = random.Random(3)
    rows = [(rng.choice([0.1, 0.2, rng.random()]), 0) for _ in range(120)] + [(rng.uniform(0.5, 1.5), 1) for _ in range(30)]
    df = spark.createDataFrame(rows, "s DOUBLE, f INT")
    results = partitions(lambda: score_separation(df, "s", "f"))
    assert [r[0][0] for r in results] == pytest.approx([silhouette_by_brute_force(rows)] * 3)
    assert score_separation(df.filter("f = 0"), "s", "f").first()[0] == 0.0
    assert score_separation(df.filter("f = 0 OR s > 1.49"), "s", "f").first() is not None


def test_trees_isolate_the_outlier():
    x = np.concatenate([np.random.default_rng(0).normal(size=(255, 2)), [[20.0, 20.0]]])
    tree = isolation_forest.grow_tree(x, np.array([True, True]), np.random.default_rng(1), 8)
    flat = {"roots": np.array([0]), **{c: tree[c].to_numpy() for c in ("feature", "threshold", "left", "right", "length")}}
    got = isolation_forest.path_lengths(x, flat)

    def walk(row):
        at = 0
        while tree.feature[at] >= 0:
            at = tree.left[at] if row[tree.feature[at]] <= tree.threshold[at] else tree.right[at]
        return tree.length[at]

    assert got == pytest.approx([walk(r) for r in x])
    assert got[-1] < np.median(got)
    assert (tree.feature >= 0).sum() * 2 + 1 == len(tree)


def test_average_path_values():
    got = isolation_forest.average_path(np.array([0, 1, 2, 3, 256]))
    assert got == pytest.approx([0, 0, 1, 2 * (np.log(2) + isolation_forest.EULER_GAMMA) - 4 / 3, 10.244770920], rel=1e-6)


def test_quantiles_per_group_equal_sorting(spark, monkeypatch):
    import numpy as np

    from townpulse.operators import quantiles

    rng = random.Random(9)
    rows = [(g, h, v) for g, h, n in (("a", 1, 4000), ("a", None, 700), (None, 2, 3), ("c", 1, 1), ("same", 1, 900)) for v in [rng.gauss(0, 9) if g != "same" else 5.0 for _ in range(n)]]
    rows += [("a", 1, None), ("empty", 1, None)] + [("a", 1, 2.5)] * 1500
    df = spark.createDataFrame(rows, "g STRING, h INT, v DOUBLE").repartition(4)
    probabilities = [0.0, 0.05, 0.5, 0.953, 1.0]
    want = {}
    for g, h, v in rows:
        if v is not None:
            want.setdefault((g, h), []).append(v)
    for small in (100_000, 50):
        monkeypatch.setattr(quantiles, "SMALL", small)
        got = quantiles.grouped_quantiles(df, ["g", "h"], "v", probabilities).collect()
        assert {(r.g, r.h): r.n for r in got} == {k: len(v) for k, v in want.items()}
        for r in got:
            assert [r[f"q{i}"] for i in range(5)] == pytest.approx(np.quantile(want[r.g, r.h], probabilities).tolist())


def test_scratch_tables_are_deleted_and_others_stay(spark):
    from pyspark.errors import AnalysisException

    from townpulse.session import fresh_path, scratch, stage

    lasting = fresh_path(spark, "lasting")
    with scratch(spark):
        with scratch(spark):
            inner = stage(spark.range(3), "inner")
        outer = stage(spark.range(4), "outer")
        outer.write.parquet(lasting)
        gone = [f.rsplit("/", 1)[0] for f in (*inner.inputFiles(), *outer.inputFiles())]
    after = stage(spark.range(5), "after")
    assert spark.read.parquet(lasting).count() == 4 and after.count() == 5
    for path in set(gone):
        with pytest.raises(AnalysisException):
            spark.read.parquet(path)

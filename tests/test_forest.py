"""The regression forest against a plain grower, Spark's forests and a day-by-day loop."""

import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from townpulse.operators import regression_forest as rf
from townpulse.operators import series
from townpulse.plans import forecast


def grown_plainly(x, y, w, min_leaf, min_split, max_depth):
    """(split, rows, depth, means, children) by trying every border of every feature."""
    nodes = []

    def grow(rows, depth):
        at, best = len(nodes), None
        nodes.append(None)
        if len(rows) >= max(min_split, 2 * min_leaf) and (max_depth is None or depth < max_depth) and (y[rows] != y[rows][0]).any():
            for f in range(x.shape[1]):
                for a, b in zip(np.unique(x[rows, f]), np.unique(x[rows, f])[1:]):
                    parts = rows[x[rows, f] <= a], rows[x[rows, f] > a]
                    if min(map(len, parts)) >= min_leaf:
                        gain = sum(((y[p] * w[p][:, None]).sum(0) ** 2 / w[p].sum()).sum() for p in parts)
                        if best is None or gain > best[0] + 1e-9:
                            best = gain, (f, a + (b - a) / 2), parts
        mean = (y[rows] * w[rows][:, None]).sum(0) / w[rows].sum()
        nodes[at] = best and best[1], len(rows), depth, mean, best and [grow(p, depth + 1) for p in best[2]]
        return at

    grow(np.flatnonzero(w), 0)
    return nodes


def assert_same(tree, nodes, i=0, j=0):
    split, rows, depth, mean, children = nodes[j]
    assert (tree["rows"][i], tree["depth"][i]) == (rows, depth) and tree["value"][i] == pytest.approx(mean)
    if split is None:
        assert tree["feature"][i] == -1
    else:
        assert (tree["feature"][i], tree["threshold"][i]) == split
        for k in (0, 1):
            assert_same(tree, nodes, tree["left"][i] + k, children[k])


def test_trees_equal_a_plain_grower():
    rng = np.random.default_rng(1)
    for _ in range(80):
        n = rng.integers(1, 40)
        x, y, w = rng.integers(0, 8, (n, 4)).astype(float), rng.integers(0, 30, (n, rng.integers(1, 4))).astype(float), rng.integers(0, 3, n)
        w[0] = 1
        limits = {"min_leaf": int(rng.integers(1, 4)), "min_split": int(rng.integers(2, 6)), "max_depth": [None, 0, 2, 4][rng.integers(0, 4)]}
        assert_same(rf.grow_tree(x, y, w, **limits), grown_plainly(x, y, w, **limits))


def flat(trees):
    """Node tables of single trees as the arrays that predictions use."""
    sizes = [len(t["feature"]) for t in trees]
    roots = np.cumsum(sizes) - sizes
    joined = {k: np.concatenate([t[k] for t in trees]) for k in ("feature", "threshold", "left", "rows", "value")}
    return {**joined, "left": joined["left"] + np.repeat(roots, sizes), "roots": roots}


def test_limits_read_off_grown_trees_are_those_of_trees_grown_under_them():
    rng = np.random.default_rng(2)
    x, y = rng.integers(0, 30, (120, 5)).astype(float), rng.integers(0, 50, (120, 1)).astype(float)
    new = rng.integers(0, 30, (50, 5)).astype(float)
    counts, depths, splits = [2, 5], [0, 3, None, 40], [2, 7]
    for leaf in (1, 3):
        got = rf.predict_nested(new, flat([rf.grow_tree(x, y, rf.draw(120, 2000, 1, t), leaf) for t in range(5)]), counts, depths, splits)
        for d, depth in enumerate(depths):
            for s, split in enumerate(splits):
                for c, n in enumerate(counts):
                    alone = flat([rf.grow_tree(x, y, rf.draw(120, 2000, 1, t), leaf, split, depth) for t in range(n)])
                    assert got[d, s, c] == pytest.approx(rf.predict(new, alone)[:, 0])


def seqs_of(spark, n=160, width=6, horizon=2, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 20, (n, width)).astype(float)
    y = np.column_stack([x[:, 0] * (h + 1) + 3 * (x[:, 1] > 10) + rng.integers(0, 4, n) for h in range(horizon)])
    rows = [(date(2024, 1, 1) + timedelta(days=i), x[i].tolist(), y[i].tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "origin DATE, x ARRAY<DOUBLE>, y ARRAY<DOUBLE>"), x, y


def test_the_search_has_the_errors_of_single_forests(spark, partitions):
    seqs, x, y = seqs_of(spark, 60)
    space = forecast.grid({"max_depth": [2, None], "min_leaf": [1, 2], "min_split": [2, 5], "n_trees": [2, 4]})
    results = partitions(lambda: spark.createDataFrame([(str(c), round(e, 9)) for c, e in forecast.search(seqs.repartition(3), space)], "c STRING, e DOUBLE"), (1, 7))
    assert results[0] == results[1] and len(results[0]) == 16
    block = np.array([0] * 15 + [1] * 15 + [2] * 15 + [3] * 15)
    for c in space:
        errors = []
        for fold in (1, 2, 3):
            own, new = np.flatnonzero(block < fold), np.flatnonzero(block == fold)
            trees = [rf.grow_tree(x[own], y[own][:, :1], rf.draw(len(own), 2000, 42, t), c["min_leaf"], c["min_split"], c["max_depth"]) for t in range(c["n_trees"])]
            errors.append(np.abs(rf.predict(x[new], flat(trees))[:, 0] - y[new, 0]).mean())
        assert dict(results[0])[str(c)] == pytest.approx(np.mean(errors))
    order = [e for _, e in forecast.search(seqs, space)]
    assert order == sorted(order)


def test_errors_are_close_to_those_of_sparks_forests(spark):
    """Each horizon's error is within a tenth of that of a forest of Spark's for that horizon alone."""
    seqs, x, y = seqs_of(spark, 400)
    train, test = seqs.where("origin < '2024-12-01'"), seqs.where("origin >= '2024-12-01'")
    model = forecast.train(train, [{"max_depth": 6, "min_leaf": 1, "min_split": 2, "n_trees": 30}])
    data = model.predict(test).withColumn("features", array_to_vector("x"))
    for h in range(2):
        single = RandomForestRegressor(labelCol="label", predictionCol="alone", numTrees=30, maxDepth=6, featureSubsetStrategy="all", seed=1).fit(
            train.select(array_to_vector("x").alias("features"), F.get("y", F.lit(h)).alias("label")))
        row = single.transform(data).agg(F.avg(F.abs(F.get("y", F.lit(h)) - F.get("predictions", F.lit(h)))).alias("ours"), F.avg(F.abs(F.get("y", F.lit(h)) - F.col("alone"))).alias("alone")).first()
        assert row.ours < 1.1 * row.alone


def plain_forecast(history, end, trees, days, lookback=30):
    """The recursion one day at a time, each feature from its definition."""
    history, day, out, window = list(history), end, [], None

    def row(values, day):
        week, month = values[-7:], values[-30:]
        return [values[-1], day.weekday(), day.month, float(day.weekday() >= 5), sum(week) / len(week), np.std(week, ddof=1), sum(month) / len(month)]

    window = [row(history[: i + 1], day - timedelta(days=len(history) - 1 - i)) for i in range(len(history))][-lookback:]
    history = history[-lookback:]
    while len(out) < days:
        block = rf.predict(np.array([sum(window, [])]), trees)[0].tolist()
        out += block
        for value in block:
            day += timedelta(days=1)
            history = [*history[1:], value]
            window = [*window[1:], row(history, day)]
    return out[:days]


def test_forecasts_equal_a_plain_loop(spark):
    draw, rows = random.Random(4), []
    for name in ("a", "b", "c"):
        for i in range(80 + ord(name) % 5):
            rows.append((name, date(2024, 1, 1) + timedelta(days=i), draw.randint(0, 40)))
    by = ["name"]
    features = series.with_features(spark.createDataFrame(rows, "name STRING, date DATE, complaint_count INT"), by)
    model = forecast.train(series.sequences(features, by=by), [{"max_depth": None, "min_leaf": 1, "min_split": 2, "n_trees": 7}], by=by)
    got = forecast.forecast(model, features, 20, by).orderBy("name", "date").collect()
    trees = rf.tree_arrays(model.nodes)
    for name in ("a", "b", "c"):
        own = [r for r in rows if r[0] == name]
        mine = [r for r in got if r.name == name]
        assert [r.date for r in mine] == [own[-1][1] + timedelta(days=i + 1) for i in range(20)]
        assert [r.predicted for r in mine] == pytest.approx(plain_forecast([float(v) for *_, v in own], own[-1][1], trees, 20))
    again = forecast.Forecaster(model.nodes, model.params, model.horizon)
    origins = forecast.rolling_origins(again, features, 10, by)
    assert origins.count() == 3 * 10 * 7
    first = {(r.name, r.date): r.predicted for r in forecast.backtest(again, features, 10, by).collect()}
    long = {(r.name, r.date): r.predicted for r in origins.where("horizon = 1").collect()}
    assert first == long and len(first) == 30


def test_pool_and_trees_have_bounds(spark, monkeypatch):
    monkeypatch.setattr(rf, "POOL_ROWS", 100)
    monkeypatch.setattr(rf, "TREE_ROWS", 50)
    seqs, _, _ = seqs_of(spark, 900)
    assert 60 < len(rf.pool(seqs, ["origin"], ["x", "y"])) < 140
    model = forecast.train(seqs, [{"max_depth": None, "min_leaf": 1, "min_split": 2, "n_trees": 4}])
    assert model.nodes.groupBy("tree").count().agg(F.max("count")).first()[0] < 2 * 50


def test_saved_models_predict_the_same(spark, tmp_path):
    seqs, x, _ = seqs_of(spark)
    model = forecast.train(seqs, [{"max_depth": 4, "min_leaf": 2, "min_split": 2, "n_trees": 3}], lookback=1)
    model.save(str(tmp_path / "m"), spark)
    again = forecast.Forecaster.load(spark, str(tmp_path / "m"))
    assert (again.params, again.horizon, again.lookback) == (model.params, 2, 1)
    assert again.predict(seqs).orderBy("origin").collect() == model.predict(seqs).orderBy("origin").collect()


def test_only_the_pool_passes_the_driver(spark, monkeypatch, tmp_path):
    seqs, x, _ = seqs_of(spark)
    sent = []
    to_arrow, kind = type(seqs).toArrow, type(seqs)
    monkeypatch.setattr(kind, "toArrow", lambda self: sent.append(to_arrow(self)) or sent[-1])
    model = forecast.train(seqs, forecast.grid({"max_depth": [3, None], "min_leaf": [1], "min_split": [2], "n_trees": [20, 40]}))
    model.save(str(tmp_path / "m"), spark)
    again = forecast.Forecaster.load(spark, str(tmp_path / "m"))
    assert again.predict(seqs).where("size(predictions) = 2").count() == len(x)
    assert again.nodes.count() > 10 * len(x)
    assert sum(t.num_rows for t in sent) <= len(x)


def test_scores_do_not_depend_on_the_parts(spark, monkeypatch):
    seqs, x, _ = seqs_of(spark)
    model = forecast.train(seqs, [{"max_depth": None, "min_leaf": 1, "min_split": 2, "n_trees": 5}])
    expected = rf.predict(x, rf.tree_arrays(model.nodes))
    for rows in (4000, 30, 3):
        monkeypatch.setattr(rf, "PART_ROWS", rows)
        got = model.predict(seqs).orderBy("origin").collect()
        assert [r.predictions for r in got] == expected.tolist()
    assert model.predict(seqs.limit(0)).collect() == []


def test_growth_does_not_depend_on_the_block(monkeypatch):
    rng = np.random.default_rng(6)
    x, y = rng.integers(0, 9, (70, 6)).astype(float), rng.random((70, 3))
    expected = rf.grow_tree(x, y, rf.draw(70, 2000, 1, 0))
    for block in (1, 50, 200):
        monkeypatch.setattr(rf, "BLOCK", block)
        got = rf.grow_tree(x, y, rf.draw(70, 2000, 1, 0))
        assert all(np.array_equal(got[k], expected[k], equal_nan=True) for k in expected)


def test_equal_columns_change_no_tree(spark):
    rng = np.random.default_rng(7)
    x, y = rng.integers(0, 9, (80, 4)).astype(float), rng.integers(0, 30, (80, 1)).astype(float)
    x = x[:, [3, 0, 0, 3, 1, 2, 1]]
    got = rf.tree_arrays(rf.grow(spark, x, y, [rf.Job(np.arange(80))], 3))
    expected = flat([rf.grow_tree(x, y, rf.draw(80, 2000, 42, t)) for t in range(3)])
    assert all(np.array_equal(got[k], expected[k], equal_nan=True) for k in expected)


def test_one_walk_reaches_the_nodes_of_all_limits():
    rng = np.random.default_rng(8)
    x, y = rng.integers(0, 30, (120, 5)).astype(float), rng.integers(0, 50, (120, 1)).astype(float)
    trees, new = flat([rf.grow_tree(x, y, rf.draw(120, 2000, 1, t)) for t in range(4)]), rng.integers(0, 30, (25, 5)).astype(float)
    for (depth, split), at in rf.reached(new, trees, [0, 2, 5, None], [2, 4, 9]).items():
        for t, root in enumerate(trees["roots"]):
            for i, row in enumerate(new):
                node, level = root, 0
                while trees["feature"][node] >= 0 and trees["rows"][node] >= split and level != depth:
                    node = trees["left"][node] + (row[trees["feature"][node]] > trees["threshold"][node])
                    level += 1
                assert at[t, i] == node


def test_one_series_is_trained_on_whole(spark):
    seqs, x, y = seqs_of(spark, 2600)
    [limits] = forecast.grid({"max_depth": [None], "min_leaf": [1], "min_split": [2], "n_trees": [2]})
    got = rf.tree_arrays(forecast.train(seqs, [limits]).nodes)
    expected = flat([rf.grow_tree(x, y, rf.draw(2600, 2600, 42, t)) for t in range(2)])
    assert all(np.array_equal(got[k], expected[k], equal_nan=True) for k in expected)
    [(_, error)] = forecast.search(seqs, [limits], folds=1)
    trees = flat([rf.grow_tree(x[:1300], y[:1300, :1], rf.draw(1300, 1300, 42, t)) for t in range(2)])
    assert error == pytest.approx(np.abs(rf.predict(x[1300:], trees)[:, 0] - y[1300:, 0]).mean())


def test_trees_draw_from_every_row(spark):
    days = spark.range(25_000).selectExpr("date_add(date'1950-01-01', int(id)) AS origin", "array(id * 1D) AS x", "array(1D) AS y")
    assert rf.pool(days, ["origin"], ["x", "y"]).num_rows == 25_000
    assert rf.pool(days, ["origin"], ["x", "y"], 5_000).num_rows < 6_000

"""Forecasting daily volumes with a random forest that predicts all horizons at once.

Series have one row per day; many series (for example districts) train and predict
together, each keeping its own windows. One series is searched and trained on whole; of many
series together trees draw from a bounded pool (``MANY``), see ``operators/regression_forest.py``.
Windows are scored in parts that meet the forest in a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field
from itertools import product
from math import ceil
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from townpulse.constants import BAND_HIGH, BAND_LOW, FORECAST_HORIZON, LOOKBACK_DAYS, SERIES_FEATURES
from townpulse.functions.metrics import error_metrics, mape, rmse
from townpulse.operators import regression_forest as forest
from townpulse.operators.series import baselines, look_back

# Search space; fixed values. No depth stands for no limit.
GRID = {"max_depth": [10, 20, None], "min_leaf": [1, 2], "min_split": [2, 5], "n_trees": [200, 300, 500]}

#: Of many series together: about how many windows trees draw from, and how many a tree draws at most.
MANY = {"pool": 20_000, "tree": 2_000}


def grid(space: dict[str, list] = GRID) -> list[dict]:
    return [dict(zip(space, values)) for values in product(*space.values())]


def expanding_folds(seqs: DataFrame, folds: int = 3) -> DataFrame:
    """Add ``block``: 0 for rows only trained on, 1..folds for the later test blocks.

    Blocks are cut between days, so all series change block on the same day. Only the
    distinct days are numbered in one task.
    """
    days = seqs.select("origin").distinct()
    i = F.row_number().over(Window.orderBy("origin")) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy())
    size = F.floor(n / (folds + 1))
    block = F.greatest(F.lit(0), folds - F.floor((n - 1 - i) / size)).cast("int")
    return seqs.join(days.withColumn("block", block), "origin")


_POOLS: WeakKeyDictionary = WeakKeyDictionary()


def pooled(seqs: DataFrame, folds: int = 3, by: list[str] = ()) -> pa.Table:
    """The training rows that trees draw from, with the block of each; kept while ``seqs`` is, for the training after a search."""
    own, key = _POOLS.setdefault(seqs, {}), (folds, *by)
    if key not in own:
        own[key] = forest.pool(expanding_folds(seqs, folds), [*by, "origin"], ["x", "y", "block"], MANY["pool"] if by else None)
    return own[key]


def search(train: DataFrame, candidates: list[dict] | None = None, folds: int = 3, by: list[str] = ()) -> list[tuple[dict, float]]:
    """Mean absolute error of horizon 1 per candidate, over expanding folds, best first; of equals the earlier.

    All trees of all folds grow in one job, one forest for each fold and least leaf size;
    the other limits are read off the grown trees. All folds are then scored in one pass.
    """
    spark, candidates = train.sparkSession, candidates if candidates is not None else grid()
    counts, depths, splits, leaves = (sorted({c[k] for c in candidates}, key=lambda v: (v is None, v)) for k in ("n_trees", "max_depth", "min_split", "min_leaf"))
    rows = pooled(train, folds, by)
    block = rows["block"].to_numpy()
    jobs = [forest.Job(np.flatnonzero(block < fold), leaf) for fold in range(1, folds + 1) for leaf in leaves]
    nodes = forest.grow(spark, forest.matrix(rows["x"]), forest.matrix(rows["y"])[:, :1], jobs, max(counts), most=MANY["tree"] if by else None)
    trees = forest.packed(nodes).withColumn("block", F.expr(f"job div {len(leaves)} + 1").cast("int"))
    tested = expanding_folds(train, folds).where("block > 0").select(*by, "origin", "block", "x", F.get("y", F.lit(0)).alias("y"))
    most = max((r["count"] for r in tested.groupBy("block").count().collect()), default=0)
    sums = forest.score(tested, most, trees, _errors_of(counts, depths, splits), "block INT, place INT, error DOUBLE, n LONG", ["block"])
    errors = np.zeros((folds, len(leaves), len(depths), len(splits), len(counts)))
    for r in sums.groupBy("block", "place").agg((F.sum("error") / F.sum("n")).alias("mae")).collect():
        errors[r.block - 1].flat[r.place] = r.mae
    mean = errors.mean(axis=0)

    def error(c: dict) -> float:
        return float(mean[leaves.index(c["min_leaf"]), depths.index(c["max_depth"]), splits.index(c["min_split"]), counts.index(c["n_trees"])])

    return sorted(((c, error(c)) for c in candidates), key=lambda r: r[1])


def _errors_of(counts: list[int], depths: list[int | None], splits: list[int]):
    def run(rows: pa.Table, trees: pa.Table) -> pa.Table:
        x, y = forest.matrix(rows["x"]), rows["y"].to_numpy()
        forests = [forest.unpacked(trees.filter(pc.equal(trees["job"], job))) for job in sorted(set(trees["job"].to_pylist()))]
        errors = np.concatenate([np.abs(forest.predict_nested(x, own, counts, depths, splits) - y).sum(axis=-1).ravel() for own in forests])
        block = np.full(len(errors), rows["block"][0].as_py())
        return pa.table({"block": pa.array(block, pa.int32()), "place": pa.array(np.arange(len(errors)), pa.int32()), "error": errors, "n": pa.array(np.full(len(errors), len(y)), pa.int64())})

    return run


def _lists(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as lists."""
    return pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32()), pa.array(values.ravel()))


@dataclass
class Forecaster:
    """A fitted forest. ``nodes`` is a table on shared storage; ``params`` are those it was grown with."""

    nodes: DataFrame
    params: dict
    horizon: int
    lookback: int = LOOKBACK_DAYS
    _trees: DataFrame | None = field(default=None, repr=False)

    def trees(self) -> DataFrame:
        """The forest, a row for each tree, staged once per model; its size is bounded by ``params`` alone."""
        if self._trees is None:
            self._trees = forest.packed(self.nodes)
        return self._trees

    def add(self, windows: DataFrame, name: str, values: Callable[[pa.Table, dict[str, np.ndarray]], np.ndarray]) -> DataFrame:
        """Add a column with the rows of the matrix that ``values`` makes of some windows and the forest."""
        def run(rows: pa.Table, trees: pa.Table) -> pa.Table:
            return rows.append_column(name, _lists(values(rows, forest.unpacked(trees))))

        schema = windows.withColumn(name, F.lit(None).cast("array<double>")).schema
        return forest.score(windows, windows.count(), self.trees(), run, schema)

    def predict(self, windows: DataFrame) -> DataFrame:
        """Add ``predictions``, an array over the horizons, to rows with a window ``x``."""
        return self.add(windows, "predictions", lambda rows, trees: forest.predict(forest.matrix(rows["x"]), trees))

    def save(self, path: str, spark: SparkSession) -> None:
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        text = json.dumps({"params": self.params, "horizon": self.horizon, "lookback": self.lookback})
        spark.createDataFrame([(text,)], "params STRING").coalesce(1).write.mode("overwrite").text(f"{path}/params")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forecaster:
        params = json.loads(spark.read.text(f"{path}/params").first()[0])
        return Forecaster(spark.read.schema(forest.NODES).parquet(f"{path}/nodes"), **params)


def train(seqs: DataFrame, candidates: list[dict] | None = None, by: list[str] = (), lookback: int = LOOKBACK_DAYS) -> Forecaster:
    """Choose parameters by horizon 1, then grow one forest for all horizons with them."""
    candidates = candidates if candidates is not None else grid()
    best = candidates[0] if len(candidates) == 1 else search(seqs, candidates, by=by)[0][0]
    rows = pooled(seqs, by=by) if seqs in _POOLS else forest.pool(seqs, [*by, "origin"], ["x", "y"], MANY["pool"] if by else None)
    x, y = forest.matrix(rows["x"]), forest.matrix(rows["y"])
    job = forest.Job(np.arange(len(x)), best["min_leaf"], best["min_split"], best["max_depth"])
    nodes = forest.grow(seqs.sparkSession, x, y, [job], best["n_trees"], most=MANY["tree"] if by else None)
    return Forecaster(nodes, best, y.shape[1], lookback)


def evaluate(forecaster: Forecaster, test: DataFrame, by: list[str] = ()) -> DataFrame:
    """mae, rmse, mape of the forest and both baselines, overall and per horizon."""
    predicted = forecaster.predict(test).select(
        *by, "origin", F.posexplode(F.arrays_zip("y", "predictions")).alias("_h", "z")
    ).select(
        *by, "origin", (F.col("_h") + 1).alias("horizon"), F.col("z.y").alias("actual"),
        F.lit("forest").alias("model"), F.col("z.predictions").alias("predicted"),
    )
    return error_metrics(predicted.unionByName(baselines(test, by=list(by))), [*by, "model"])


def next_rows(history: np.ndarray, day: np.ndarray) -> np.ndarray:
    """Feature rows of ``day``, whose values are the last of ``history`` (a row per series); as in training."""
    week, month = history[:, -7:], history[:, -30:]
    weekday = (day.astype("datetime64[D]").astype(int) + 3) % 7
    number = day.astype("datetime64[M]").astype(int) % 12 + 1
    std = week.std(axis=1, ddof=1) if week.shape[1] > 1 else np.zeros(len(week))
    return np.column_stack([history[:, -1], weekday, number, weekday >= 5, week.mean(axis=1), std, month.mean(axis=1)])


def roll_forward(x: np.ndarray, day: np.ndarray, trees: dict[str, np.ndarray], days: int) -> np.ndarray:
    """Predictions for ``days`` days after ``day``, each block of horizons fed back into the windows ``x``."""
    width = len(SERIES_FEATURES)
    window, out = x.reshape(len(x), -1, width).copy(), []
    horizon = trees["value"].shape[1]
    for _ in range(ceil(days / horizon)):
        block = forest.predict(window.reshape(len(x), -1), trees)
        out.append(block)
        for h in range(horizon):
            day = day + np.timedelta64(1, "D")
            history = np.column_stack([window[:, 1:, 0], block[:, h]])
            window = np.concatenate([window[:, 1:], next_rows(history, day)[:, None]], axis=1)
    return np.concatenate(out, axis=1)[:, :days]


def forecast(forecaster: Forecaster, features: DataFrame, days: int = 30, by: list[str] = ()) -> DataFrame:
    """Predict ``days`` days past the end of each series, feeding predictions back in.

    A series is one row, its last window and day; all its days are predicted together, in a
    single pass.
    """
    newest = Window.partitionBy(*by).orderBy(F.desc("date"))
    ends = look_back(features, forecaster.lookback, by).withColumn("_age", F.row_number().over(newest)).where("_age = 1")
    ahead = forecaster.add(ends, "_ahead", lambda rows, trees: roll_forward(forest.matrix(rows["x"]), rows["date"].to_numpy(), trees, days))
    dated = ahead.select(*by, F.col("date").alias("_end"), F.posexplode("_ahead").alias("_h", "predicted"))
    return dated.select(
        *by, F.date_add("_end", F.col("_h") + 1).alias("date"), "predicted",
        (F.col("predicted") * BAND_LOW).alias("lower_bound"), (F.col("predicted") * BAND_HIGH).alias("upper_bound"),
    )


def rolling_origins(forecaster: Forecaster, features: DataFrame, days: int = 90, by: list[str] = ()) -> DataFrame:
    """(origin, horizon, date, predicted) of all horizons from each of the origins whose next day is among the last ``days``."""
    w = Window.partitionBy(*by).orderBy(F.desc("date"))
    windows = look_back(features, forecaster.lookback, by).withColumn("_age", F.row_number().over(w))
    recent = windows.filter(F.col("_age").between(2, days + 1)).select(*by, F.col("date").alias("origin"), "x")
    long = forecaster.predict(recent).select(*by, "origin", F.posexplode("predictions").alias("_h", "predicted"))
    return long.select(*by, "origin", (F.col("_h") + 1).alias("horizon"), F.date_add("origin", F.col("_h") + 1).alias("date"), "predicted")


def backtest(forecaster: Forecaster, features: DataFrame, days: int = 90, by: list[str] = ()) -> DataFrame:
    """(date, predicted): one step ahead for the last ``days`` days, where history allows."""
    return rolling_origins(forecaster, features, days, by).filter("horizon = 1").select(*by, "date", "predicted")


def origin_errors(predicted: DataFrame, features: DataFrame, by: list[str] = ()) -> DataFrame:
    """Days, mape and rmse per horizon of ``rolling_origins`` (or any such table) where the actual day is known."""
    actual = features.select(*by, "date", F.col("complaint_count").alias("actual"))
    a, p = F.col("actual"), F.col("predicted")
    return predicted.join(actual, [*by, "date"]).groupBy(*by, "horizon").agg(F.count(F.lit(1)).alias("n_days"), mape(a, p).alias("mape"), rmse(a, p).alias("rmse"))


def past_and_future(past: DataFrame, future: DataFrame) -> DataFrame:
    """Backtest and forecast as one line."""
    cols = ["date", "predicted"]
    return past.select(*cols, F.lit("past").alias("segment")).unionByName(future.select(*cols, F.lit("future").alias("segment")))


def forecast_stats(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("predicted").alias("mean"), F.max("predicted").alias("highest"), F.min("predicted").alias("lowest"))

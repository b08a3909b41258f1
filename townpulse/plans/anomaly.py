"""Unusual complaints: features, detectors, voting, evaluation."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import reduce
from math import pi

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from townpulse.constants import (
    ANOMALY_FEATURES,
    DEFAULT_DAY_OF_WEEK,
    DEFAULT_HOUR,
    DEFAULT_LAT,
    DEFAULT_LON,
    DEFAULT_MONTH,
)
from townpulse.functions.categories import type_flags
from townpulse.functions.times import weekday_number
from townpulse.operators import isolation_forest
from townpulse.operators.joins import with_group_count
from townpulse.operators.quantiles import column_quantiles
from townpulse.operators.sampling import scatter_sample  # noqa: F401  (part of this plan's surface)
from townpulse.operators.series import centred, daily_counts
from townpulse.operators.spatial_noise import spatial_noise  # noqa: F401
from townpulse.operators.topk import top_values
from townpulse.schemas import require_columns
from townpulse.session import cut_lineage


def prepare_features(df: DataFrame, key: str = "ticket_id", serving: bool = False) -> DataFrame:
    """(key, features) from the columns that exist, for training and for serving alike.

    Serving fills nulls with fixed values and takes an unknown district-day to be 1.
    """
    require_columns(df, [key, "timestamp"])
    ts = F.col("timestamp")

    def with_default(col: Column, value) -> Column:
        return F.coalesce(col, F.lit(value)) if serving else col

    features: dict[str, Column] = {
        "hour": with_default(F.hour(ts), DEFAULT_HOUR),
        "day_of_week": with_default(weekday_number(ts), DEFAULT_DAY_OF_WEEK),
        "month": with_default(F.month(ts), DEFAULT_MONTH),
    }
    if "complaint_count" in df.columns:
        features["complaint_count"] = F.col("complaint_count")
    if "lat" in df.columns and "lon" in df.columns:
        features["lat"] = with_default(F.col("lat"), DEFAULT_LAT)
        features["lon"] = with_default(F.col("lon"), DEFAULT_LON)
    if "solve_days" in df.columns:
        features["solve_days"] = F.coalesce(F.col("solve_days"), F.lit(0))
    kind = next((c for c in ("type", "primary_type") if c in df.columns), None)
    if kind:
        features |= type_flags(F.col(kind))
    if "district" not in df.columns:
        return df.select(F.col(key), *[c.alias(n) for n, c in features.items()])
    rows = df.select(F.col(key), "district", F.to_date(ts).alias("_date"), *[c.alias(n) for n, c in features.items()])
    counted = with_group_count(rows, ["district", "_date"], "district_daily_count", [key], 1 if serving else None)
    return counted.drop("district", "_date")


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in ANOMALY_FEATURES if c in df.columns]


@dataclass
class Scaler:
    """Medians, means and population deviations of the training features."""

    medians: dict[str, float]
    means: dict[str, float]
    stds: dict[str, float]

    def fill(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in self.medians.items()})

    def transform(self, df: DataFrame) -> DataFrame:
        filled = self.fill(df)
        return filled.withColumns({
            c: (F.col(c) - F.lit(self.means[c])) / F.lit(self.stds[c] or 1.0) for c in self.medians
        })


def medians(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """Exact medians: whole-number columns (few values) in one pass, real ones by selection."""
    real = [f.name for f in df.schema.fields if f.name in cols and isinstance(f.dataType, (DoubleType, FloatType))]
    whole = [c for c in cols if c not in real]
    found = df.agg(*[F.percentile(c, F.lit(0.5)).alias(c) for c in whole]).first().asDict() if whole else {}
    if real:
        found |= {c: q for c, [q] in column_quantiles(df, real, [0.5]).items()}
    return {c: 0.0 if found[c] is None else float(found[c]) for c in cols}


def fit_scaler(train: DataFrame, cols: list[str]) -> Scaler:
    scaler = Scaler(medians(train, cols), {}, {})
    stats = [e for c in cols for e in (F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]
    row = scaler.fill(train).agg(*stats).first()
    scaler.means = {c: row[f"m_{c}"] for c in cols}
    scaler.stds = {c: row[f"s_{c}"] for c in cols}
    return scaler


@dataclass
class AnomalyModel:
    scaler: Scaler
    forest: isolation_forest.IsolationForest

    def prepare(self, features: DataFrame) -> DataFrame:
        missing = {c: F.lit(0) for c in self.forest.features if c not in features.columns}
        return self.scaler.transform(features.withColumns(missing) if missing else features)

    def predict(self, features: DataFrame, key: str = "ticket_id") -> DataFrame:
        """(…, score, prediction): scaled features with the forest's verdict."""
        return isolation_forest.predict(self.prepare(features), self.forest, key)

    def save(self, path: str) -> None:
        spark = self.forest.nodes.sparkSession
        isolation_forest.save(self.forest, f"{path}/forest")
        text = json.dumps(self.scaler.__dict__)
        spark.createDataFrame([(text,)], "scaler STRING").coalesce(1).write.mode("overwrite").text(f"{path}/scaler")

    @staticmethod
    def load(spark: SparkSession, path: str) -> AnomalyModel:
        scaler = Scaler(**json.loads(spark.read.text(f"{path}/scaler").first()[0]))
        return AnomalyModel(scaler, isolation_forest.load(spark, f"{path}/forest"))


def fit_model(features: DataFrame, key: str = "ticket_id", **params) -> AnomalyModel:
    """Scale and grow; ``params`` go to the forest (trees, samples, features, contamination)."""
    names = feature_names(features)
    scaler = fit_scaler(features, names)
    forest = isolation_forest.fit(scaler.transform(features), key, names, **params)
    return AnomalyModel(scaler, forest)


def min_max_inverted(df: DataFrame, col: str) -> Column:
    """``1 - (x - min) / (max - min)`` over the whole column, by a scalar subquery."""
    ends = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi")).alias("e")).scalar()
    return 1 - (F.col(col) - ends["lo"]) / (ends["hi"] - ends["lo"] + F.lit(1e-10))


def detect_anomalies(df: DataFrame, model: AnomalyModel | None, key: str = "ticket_id") -> DataFrame:
    """Add is_anomaly and anomaly_score (1 = most unusual); without a model, by solve_days."""
    if model is None:
        return solve_day_anomalies(df)
    # rows are told apart by a number of their own, as keys may be null or occur twice
    df = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
    verdict = model.predict(prepare_features(df.drop(key).withColumnRenamed("_row", key), key, serving=True), key).select(F.col(key).alias("_row"), "score", "prediction")
    verdict = cut_lineage(verdict)  # scored once, read for the range and for the rows
    scored = verdict.withColumn("anomaly_score", min_max_inverted(verdict, "score"))
    flags = scored.select("_row", (F.col("prediction") == -1).cast("int").alias("is_anomaly"), "anomaly_score")
    return df.join(flags, "_row").drop("_row")


def solve_day_anomalies(df: DataFrame) -> DataFrame:
    """Distance of solve_days from the median in deviations, cut to [0, 1]; flag above 0.7."""
    stats = df.agg(F.struct(
        F.percentile("solve_days", F.lit(0.5)).alias("median"), F.stddev_samp("solve_days").alias("std")
    ).alias("s")).scalar()
    distance = F.abs(F.col("solve_days") - stats["median"]) / (stats["std"] + 1)
    # least and greatest skip nulls, which must stay null here
    clipped = F.when(distance.isNotNull(), F.least(F.greatest(distance, F.lit(0.0)), F.lit(1.0)))
    scored = df.withColumn("anomaly_score", clipped)
    return scored.withColumn("is_anomaly", F.coalesce(F.col("anomaly_score") > 0.7, F.lit(False)).cast("int"))


def z_score_anomalies(df: DataFrame, col: str = "solve_days", threshold: float = 3.0) -> DataFrame:
    """Add is_statistical_anomaly: nulls take the median, deviations are of the population.

    For columns with few distinct values such as day counts.
    """
    if col not in df.columns:
        return df.withColumn("is_statistical_anomaly", F.lit(0))
    filled = df.withColumn("_x", F.coalesce(F.col(col).cast("double"), df.agg(F.percentile(col, F.lit(0.5)).alias("m")).scalar()))
    stats = filled.agg(F.struct(F.avg("_x").alias("mean"), F.stddev_pop("_x").alias("std")).alias("s")).scalar()
    z = (F.col("_x") - stats["mean"]) / F.nullif(stats["std"], F.lit(0.0))
    return filled.withColumn("is_statistical_anomaly", F.coalesce(F.abs(z) > threshold, F.lit(False)).cast("int")).drop("_x")


def spike_days(df: DataFrame, window: int = 7, threshold: float = 3.0, ts: str = "timestamp") -> DataFrame:
    """(date, complaint_count, z, is_spike) per day with complaints; edges have z 0.

    A day counts in its own window, so at window 7 |z| stays below 2.27.
    """
    daily = daily_counts(df, ts)
    mean, std = centred("complaint_count", window)
    z = (F.col("complaint_count") - mean) / (F.nullif(std, F.lit(0.0)) + F.lit(1e-10))
    scored = daily.withColumn("z", F.coalesce(z, F.lit(0.0)))
    return scored.withColumn("is_spike", (F.abs("z") > threshold).cast("int"))


def temporal_spikes(df: DataFrame, window: int = 7, threshold: float = 3.0, ts: str = "timestamp") -> DataFrame:
    """Add is_temporal_anomaly; the day table is bounded by the calendar and broadcast."""
    days = spike_days(df, window, threshold, ts).select(F.col("date").alias("_date"), F.col("is_spike").alias("is_temporal_anomaly"))
    marked = df.withColumn("_date", F.to_date(ts)).join(F.broadcast(days), "_date", "left").drop("_date")
    return marked.withColumn("is_temporal_anomaly", F.coalesce("is_temporal_anomaly", F.lit(0)))


def combine_methods(df: DataFrame, methods: list[str], weights: dict[str, float] | None = None) -> DataFrame:
    """Weighted vote of 0/1 columns or -1/1 columns (those with a negative value).

    The sum is divided by the total of the given weights; a method without one adds 1.
    """
    weights = weights if weights is not None else {m: 1.0 for m in methods}
    lowest = df.agg(F.struct(*[F.min(m).alias(m) for m in methods]).alias("lo")).scalar()
    votes = [
        F.lit(float(weights.get(m, 1.0))) * F.when(lowest[m] < 0, (F.col(m) == -1).cast("int")).otherwise(F.col(m))
        for m in methods
    ]
    total = float(sum(weights.values()))
    score = reduce(Column.__add__, votes)
    combined = df.withColumn("combined_score", score / F.lit(total) if total > 0 else score)
    return combined.withColumn("is_combined_anomaly", (F.col("combined_score") > 0.5).cast("int"))


def hash_normal(key: str, salt: str, seed: int) -> Column:
    """A standard normal number per id and salt (Box-Muller on two hashes)."""
    u = [
        (F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(f"{salt}/{i}"), F.lit(seed)), 11) + F.lit(0.5)) / F.lit(float(2**53))
        for i in (0, 1)
    ]
    return F.sqrt(-2 * F.log(u[0])) * F.cos(F.lit(2 * pi) * u[1])


def stability(features: DataFrame, model: AnomalyModel, key: str = "ticket_id", runs: int = 5, noise: float = 0.01, seed: int = 42) -> DataFrame:
    """Mean agreement of the verdicts with those under small noise, over ``runs`` runs."""
    names = model.forest.features
    noisy = features.select(
        F.col(key), F.explode(F.sequence(F.lit(0), F.lit(runs))).alias("run"), *names
    )
    shifts = {}
    for name in names:
        shift = F.coalesce(*[
            F.when(F.col("run") == r, hash_normal(key, f"{name}/{r}", seed) * noise) for r in range(1, runs + 1)
        ], F.lit(0.0))
        shifts[name] = F.col(name) + shift
    verdicts = model.predict(noisy.withColumns(shifts), key).groupBy(key).agg(
        *[F.max(F.when(F.col("run") == r, F.col("prediction"))).alias(f"p{r}") for r in range(runs + 1)]
    )
    same = [F.avg((F.col(f"p{r}") == F.col("p0")).cast("double")) for r in range(1, runs + 1)]
    return verdicts.agg((reduce(Column.__add__, same) / F.lit(runs)).alias("stability"))


def anomaly_totals(df: DataFrame) -> DataFrame:
    flagged = F.col("is_anomaly") == 1
    return df.agg(
        F.count_if(flagged).alias("n_anomalies"),
        (F.count_if(flagged) / F.count(F.lit(1)) * 100).alias("anomaly_pct"),
        F.avg(F.when(flagged, F.col("anomaly_score"))).alias("mean_score"),
    )


def anomalies_by(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    return top_values(df.filter(F.col("is_anomaly") == 1), col, n)


def top_anomalies(df: DataFrame, n: int = 50, key: str = "ticket_id") -> DataFrame:
    shown = [key, "timestamp", "district", "primary_type", "solve_days", "anomaly_score"]
    return df.filter(F.col("is_anomaly") == 1).select(*shown).orderBy(F.desc("anomaly_score"), key).limit(n)

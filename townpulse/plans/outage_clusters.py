"""Grouping outages by behaviour, and the tables that describe the groups."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import Imputer, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from townpulse.constants import WEEKDAY_NAMES_TH
from townpulse.functions.times import at_time, minute_of_day, wrapped_duration
from townpulse.operators import kmeans
from townpulse.operators.topk import top_per_group, value_counts
from townpulse.schemas import require_columns

REQUIRED = ["date", "day_of_week", "start", "end", "district", "temp", "rain", "wind_gust"]
CATEGORIES = ["day_of_week", "district"]
NUMBERS = ["temp", "rain", "wind_gust", "start_min", "duration"]


def with_minutes(df: DataFrame) -> DataFrame:
    """Add start_min, end_min and duration (past midnight where the end is earlier)."""
    df = require_columns(df, REQUIRED).withColumns({
        "start_min": minute_of_day(F.col("start")), "end_min": minute_of_day(F.col("end")),
    })
    return df.withColumn("duration", wrapped_duration(F.col("start_min"), F.col("end_min")))


def with_times(df: DataFrame) -> DataFrame:
    """Add start_dt and end_dt, null where date or clock is bad."""
    df = df.withColumn("date", F.col("date").try_cast("date"))
    return df.withColumns({
        "start_dt": at_time(F.col("date"), F.col("start")), "end_dt": at_time(F.col("date"), F.col("end")),
    })


def encoder() -> Pipeline:
    """Weekday and district as 0/1 columns, the numbers as they are; unknown ones take the mean of training."""
    indexed = [f"{c}_index" for c in CATEGORIES]
    hot = [f"{c}_hot" for c in CATEGORIES]
    filled = [f"{c}_filled" for c in NUMBERS]
    return Pipeline(stages=[
        Imputer(inputCols=NUMBERS, outputCols=filled),
        StringIndexer(inputCols=CATEGORIES, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=indexed, outputCols=hot, dropLast=True),
        VectorAssembler(inputCols=[*hot, *filled], outputCol="features"),
    ])


def encoded(encoding: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with ``features``, an array."""
    made = [f"{c}{s}" for c in CATEGORIES for s in ("_index", "_hot")] + [f"{c}_filled" for c in NUMBERS]
    return encoding.transform(df).withColumn("features", vector_to_array("features")).drop(*made)


@dataclass
class ClusterModel:
    """A fitted encoder and the centres of the clusters."""

    encoding: PipelineModel
    centres: np.ndarray

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``features`` and ``cluster``, the number of the nearest centre."""
        centres = self.centres

        @F.pandas_udf("int")
        def label(features: pd.Series) -> pd.Series:
            return pd.Series(kmeans.nearest(np.stack(features), centres) if len(features) else [], dtype="int32")

        return encoded(self.encoding, df).withColumn("cluster", label("features"))

    def silhouette(self, df: DataFrame) -> float:
        """Mean silhouette of the rows by plain distances."""
        return kmeans.mean_silhouettes(encoded(self.encoding, df), "features", [self.centres])[0]

    def save(self, path: str) -> None:
        self.encoding.write().overwrite().save(f"{path}/encoding")
        spark = SparkSession.active()
        rows = [(i, [float(v) for v in c]) for i, c in enumerate(self.centres)]
        spark.createDataFrame(rows, "cluster INT, centre ARRAY<DOUBLE>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centres")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ClusterModel:
        rows = sorted(spark.read.parquet(f"{path}/centres").collect(), key=lambda r: r.cluster)
        return ClusterModel(PipelineModel.load(f"{path}/encoding"), np.array([r.centre for r in rows]))


@dataclass
class Tried:
    k: int
    silhouette: float
    cost: float
    centres: np.ndarray


def find_best_k(features: DataFrame, k_min: int = 2, k_max: int = 10, restarts: int = 10) -> list[Tried]:
    """The best model of every k and its silhouette; all models are fitted in one loop, see ``best``."""
    models = kmeans.fit_many(features, "features", [*range(k_min, k_max + 1)], restarts)
    scores = kmeans.mean_silhouettes(features, "features", [m.centres for m in models]) if models else []
    return [Tried(m.k, score, float(m.cost), m.centres) for m, score in zip(models, scores)]


def best(tried: list[Tried]) -> Tried:
    """The first of the highest silhouettes."""
    return max(tried, key=lambda t: t.silhouette)


def silhouette_squared(clustered: DataFrame) -> float:
    """Spark's silhouette of ``features`` (an array) and ``cluster``, which uses squared distances."""
    vectors = clustered.select("cluster", array_to_vector("features").alias("features"))
    return ClusteringEvaluator(featuresCol="features", predictionCol="cluster").evaluate(vectors)


def train_clusters(train: DataFrame, k_min: int = 2, k_max: int = 10, restarts: int = 10) -> tuple[ClusterModel, list[Tried]]:
    """Search k on the training rows; the model of the best k, and all that were tried."""
    encoding = encoder().fit(train)
    features = encoded(encoding, train).select("features").persist()
    try:
        tried = find_best_k(features, k_min, k_max, restarts)
    finally:
        features.unpersist()
    return ClusterModel(encoding, best(tried).centres), tried


def cluster_sizes(df: DataFrame) -> DataFrame:
    return value_counts(df, "cluster").orderBy("cluster")


def cluster_profile(df: DataFrame) -> DataFrame:
    means = [F.round(F.avg(c), 2).alias(c) for c in NUMBERS]
    return df.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *means)


def by_cluster(df: DataFrame, key: str, clusters: list[int]) -> DataFrame:
    """Crosstab of ``key`` and the given clusters, zero where empty."""
    cells = [F.count_if(F.col("cluster") == c).alias(f"cluster_{c}") for c in clusters]
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(*cells)


def weekday_by_cluster(df: DataFrame, clusters: list[int]) -> DataFrame:
    """Crosstab of weekday and cluster, in weekday order."""
    numbered = df.withColumn("weekday", F.weekday("date"))
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES_TH])
    return by_cluster(numbered, "weekday", clusters).withColumn("day_name", F.get(names, F.col("weekday"))).orderBy("weekday")


def cluster_scatter(df: DataFrame, key: str) -> DataFrame:
    """Long form: (key, cluster, measure, x, duration) for start time and weather."""
    measures = ["start_min", "temp", "rain", "wind_gust"]
    return df.select(key, "cluster", "duration", *[F.col(c).cast("double").alias(c) for c in measures]).unpivot(
        [key, "cluster", "duration"], measures, "measure", "x"
    )


def cluster_correlation(df: DataFrame) -> DataFrame:
    """Correlation with duration per cluster; an addition that sums up the scatter."""
    pairs = [F.corr(c, "duration").alias(f"corr_{c}") for c in ("start_min", "temp", "rain", "wind_gust")]
    return df.groupBy("cluster").agg(*pairs)


def cluster_summary(df: DataFrame, districts: int = 5, days: int = 3) -> DataFrame:
    """One row per cluster: size, means, frequent districts and weekdays, weather flags."""
    base = df.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.avg("duration").alias("mean_duration"), F.avg("temp").alias("mean_temp"),
        F.avg("rain").alias("mean_rain"), F.avg("wind_gust").alias("mean_wind_gust"), F.avg("start_min").alias("_start"),
    )
    minutes = F.floor(F.col("_start") % 60)
    base = base.withColumns({
        "mean_start": F.format_string("%d:%02d", F.floor(F.col("_start") / 60), minutes),
        "often_rain": F.col("mean_rain") > 10, "often_wind": F.col("mean_wind_gust") > 30,
    }).drop("_start")
    dated = df.withColumn("weekday", F.weekday("date"))
    for key, k, name in (("district", districts, "top_districts"), ("weekday", days, "top_days")):
        top = top_per_group(value_counts(dated, ["cluster", key]), ["cluster"], [F.desc("n"), F.col(key)], k)
        entry = F.struct((-F.col("n")).alias("o"), F.col(key).alias("k"))
        text = F.transform(F.sort_array(F.collect_list(entry)), lambda e: F.concat_ws(":", e["k"], -e["o"]))
        base = base.join(F.broadcast(top.groupBy("cluster").agg(F.array_join(text, ";").alias(name))), "cluster", "left")
    return base


def cluster_totals(df: DataFrame) -> DataFrame:
    return df.agg(
        F.countDistinct("cluster").alias("n_clusters"), F.avg("duration").alias("mean_duration"),
        F.count(F.lit(1)).alias("n_outages"), F.countDistinct("district").alias("n_districts"),
    )


def minutes_by_district(df: DataFrame) -> DataFrame:
    """Total outage minutes per district, longest first."""
    return df.filter(F.col("district").isNotNull()).groupBy("district").agg(
        F.sum("duration_minutes").alias("duration_minutes")
    ).orderBy(F.desc("duration_minutes"), "district")

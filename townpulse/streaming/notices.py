"""Continuous intake of notice days and continuous daily counts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, path: str, schema: StructType | str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def new_days(stream: DataFrame, keys: list[str] = ("outage_date", "announcement_url"), arrived: str | None = None, late: str = "7 days") -> DataFrame:
    """First record per key. With an arrival column, keys are forgotten after ``late``."""
    if arrived is None:
        return stream.dropDuplicates(list(keys))
    return stream.withWatermark(arrived, late).dropDuplicatesWithinWatermark(list(keys))


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Take in all waiting files and stop; a rerun resumes from the checkpoint."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def take_in(
    stream: DataFrame, path: str, checkpoint: str, keys: list[str] = ("outage_date", "announcement_url"), day: str = "outage_date",
) -> StreamingQuery:
    """Append the first record per key to a table, however late it comes.

    The table itself says which keys are known, so there is no state to bound and no
    watermark to fall behind: the rows of a batch meet the stored keys of their own days,
    of which the table's partitions are all that is read. A batch goes to a folder of its
    own and is overwritten when it is repeated; batches after it are not looked at then.
    """
    spark, keys = stream.sparkSession, list(keys)

    def write(batch: DataFrame, number: int) -> None:
        first = batch.dropDuplicates(keys).persist()
        try:
            known = _earlier(spark, path, number)
            fresh = first
            if known is not None:
                days = first.select(day).distinct()
                fresh = first.join(known.join(days, day, "left_semi").select(*keys), keys, "left_anti")
            fresh.write.mode("overwrite").partitionBy(day).parquet(f"{path}/batch={number}")
        finally:
            first.unpersist()

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _earlier(spark: SparkSession, path: str, number: int) -> DataFrame | None:
    try:
        return spark.read.parquet(path).filter(F.col("batch") < number)
    except AnalysisException as err:
        if err.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def daily_counts(stream: DataFrame, by: str, ts: str = "ts", late: str = "1 day") -> DataFrame:
    """Counts per day and key; a day is closed once the watermark has passed it, and later events of it are left out.

    For counts that late events still change see ``add_counts``.
    """
    return (
        stream.withWatermark(ts, late).groupBy(F.window(ts, "1 day"), by)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.to_date("window.start").alias("date"), by, "n")
    )


def add_counts(stream: DataFrame, by: str, path: str, checkpoint: str, ts: str = "ts") -> StreamingQuery:
    """Store what each batch adds to the counts per day and key; late events add to their day like others.

    A batch's own counts go to a folder named by it, so a repeated batch replaces itself and
    nothing is counted twice. Without a window to close there is neither state nor watermark.
    """
    def write(batch: DataFrame, number: int) -> None:
        dated = batch.select(F.to_date(ts).alias("date"), by).filter(F.col("date").isNotNull())
        dated.groupBy("date", by).agg(F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def added_counts(spark: SparkSession, path: str, by: str) -> DataFrame:
    """The counts per day and key that all batches of ``add_counts`` come to."""
    return spark.read.parquet(path).groupBy("date", by).agg(F.sum("n").alias("n"))


def write_counts(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write each batch's changed counts to a folder of its own, so a repeated batch replaces itself."""
    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return (
        counts.writeStream.outputMode("update").foreachBatch(write)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_counts(spark: SparkSession, path: str, by: str) -> DataFrame:
    """The latest count per day and key, of all days, closed or not."""
    return spark.read.parquet(path).groupBy("date", by).agg(F.max_by("n", "batch").alias("n"))

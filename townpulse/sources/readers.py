"""Reading tables with declared schemas."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from townpulse.sources.writers import LEDGER


def read_csv(spark: SparkSession, path: str | list[str], schema: StructType | str, multi_line: bool = False) -> DataFrame:
    """CSV with a header; empty text is null. A missing path raises AnalysisException.

    Large files are split among tasks. With ``multi_line`` quoted fields may hold line
    breaks, and each file is one task.
    """
    return (
        spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
        .option("multiLine", multi_line).option("escape", '"').csv(path)
    )


def read_optional(spark: SparkSession, path: str, schema: StructType | str, multi_line: bool = False) -> DataFrame | None:
    """Like ``read_csv``, but None where there is no such path."""
    try:
        return read_csv(spark, path, schema, multi_line)
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def union_csv(spark: SparkSession, paths: list[str], multi_line: bool = False) -> DataFrame:
    """CSV files with differing headers, united by column name, absent columns null.

    All columns are text. One plan is made per different header, not per path.
    """
    by_header: dict[tuple[str, ...], list[str]] = {}
    for path in paths:
        header = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line).csv(path).columns
        by_header.setdefault(tuple(header), []).append(path)
    united = None
    for header, own in by_header.items():
        schema = StructType([StructField(c, StringType()) for c in header])
        frame = read_csv(spark, own, schema, multi_line)
        united = frame if united is None else united.unionByName(frame, allowMissingColumns=True)
    return united


def read_batches(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The rows of a table of committed batches, with ``batch``; see ``writers.commit_batch``.

    The attempts that count are few lines, and their folders are all that is read. Without a
    table there are no rows.
    """
    kept = StructType(schema.fields) if isinstance(schema, StructType) else spark.createDataFrame([], schema).schema
    folders = StructType([*kept.fields, StructField("batch", StringType()), StructField("attempt", StringType())])
    try:
        ledger = spark.read.schema(LEDGER).json(f"{path}/ledger")
    except AnalysisException as err:
        if err.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], folders).drop("attempt")
        raise
    latest = ledger.groupBy("batch").agg(F.max_by("attempt", F.struct("at", "attempt")).alias("attempt"))
    return spark.read.schema(folders).parquet(f"{path}/rows").join(latest, ["batch", "attempt"]).select(*kept.names, "batch")


def page_range(df: DataFrame, start: int = 1, stop: int | None = None, max_pages: int | None = None, col: str = "page") -> DataFrame:
    """Pages ``start`` to ``stop`` (included), at most ``max_pages``; prunes a table partitioned by page."""
    df = df.filter(F.col(col) >= start)
    if stop is not None:
        df = df.filter(F.col(col) <= stop)
    if max_pages is not None:
        df = df.filter(F.col(col) < start + max_pages)
    return df


def spread(df: DataFrame, partitions: int) -> DataFrame:
    """Even partitions ahead of costly work on few large files: as many as the caller asks for, or more to keep all cores busy to the end."""
    return df.repartition(max(partitions, 4 * df.sparkSession.sparkContext.defaultParallelism))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: its type, the row count and its nulls, from a single pass."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"_{i}") for i, c in enumerate(df.columns)]
    counted = df.agg(F.count(F.lit(1)).alias("n_rows"), *nulls)
    lines = [
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col("n_rows"), F.col(f"_{i}").alias("n_nulls"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counted.select(F.inline(F.array(*lines)))


def audited(df: DataFrame, step: str) -> tuple[DataFrame, Observation]:
    """Count the rows that pass a step while a later action runs; read ``observation.get``."""
    seen = Observation(step)
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows")), seen

"""Writing tables."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame

#: A line per attempt at a batch that was written whole.
LEDGER = "batch STRING, attempt STRING, at LONG"
BOM = "﻿"


def write_csv(df: DataFrame, path: str, bom: bool = False, mode: str = "overwrite") -> None:
    """CSV folder with headers; with ``bom`` every file starts with the UTF-8 mark."""
    if bom:
        df = df.withColumnRenamed(df.columns[0], BOM + df.columns[0])
    options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    df.write.mode(mode).options(**options).csv(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] = (), mode: str = "overwrite", compression: str = "zstd") -> None:
    """Parquet folder, the default for every table that is read again."""
    df.write.mode(mode).option("compression", compression).partitionBy(*partition_by).parquet(path)


def append_batch(df: DataFrame, path: str) -> None:
    """Add the rows of one batch to a table; earlier batches stay."""
    write_table(df, path, mode="append")


def commit_batch(df: DataFrame, path: str, batch: str) -> None:
    """Add the rows of a batch to a table as a whole, or replace those it had.

    Rows go to a folder of their own for every attempt, and count once a line of the ledger
    names it; of several attempts at a batch the last one written there counts. A writer that
    dies leaves rows that nobody reads, and a batch that is run again takes the place of the
    first. Read such a table with ``readers.read_batches``.
    """
    attempt = uuid.uuid4().hex
    write_table(df, f"{path}/rows/batch={batch}/attempt={attempt}")
    line = [(batch, attempt, time.time_ns())]
    df.sparkSession.createDataFrame(line, LEDGER).coalesce(1).write.mode("append").json(f"{path}/ledger")


def write_pages(days: DataFrame, path: str) -> None:
    """Notice days as one table with a partition per page; the whole table is the union."""
    days.repartition("page", "announcement_url").sortWithinPartitions("outage_date", ascending=False).write.mode(
        "overwrite"
    ).partitionBy("page").parquet(path)

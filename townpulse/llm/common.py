"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words in every operator of this package: space, tab, line breaks.
WHITE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"

VOCABULARIES = os.environ.get("TOKENIZER_DIR", "/opt/tokenizers")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file; the package that ships them is asked first."""
    try:
        import public_tokenizers
    except ImportError:
        return os.path.join(VOCABULARIES, name)
    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` under batches small enough for very long texts."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return df.mapInArrow(fn, schema)


def sample_by_hash(df: DataFrame, n: int, key: str) -> DataFrame:
    """About ``n`` rows, never more: those of smallest hash of ``key``.

    The cut is found on the hashes alone, so no task gathers wide rows to sort them; only
    if a key repeats, as many of its rows are left out as pass ``n``.
    """
    hashed = F.xxhash64(key)
    cut = df.select(hashed.alias("h")).orderBy("h").limit(n).agg(F.max("h")).first()[0]
    return df.where(hashed <= F.lit(cut)).limit(n)


class Memo(dict):
    """A bounded memory of ``fn``: emptied when full, long keys are not kept.

    Looking a key up is a plain dict access, so ``map(memo.__getitem__, keys)`` is fast.
    """

    def __init__(self, fn: Callable, most: int = 400_000, longest: int = 64) -> None:
        super().__init__()
        self.fn, self.most, self.longest = fn, most, longest

    def __missing__(self, key):
        value = self.fn(key)
        if len(key) <= self.longest:
            if len(self) >= self.most:
                self.clear()
            self[key] = value
        return value

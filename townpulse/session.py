"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("townpulse")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, ready for ``checkpoint()``.

    Only a session of one process may run without the setting; it then gets a temporary
    folder. Several processes on one machine are a cluster like any other.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if path is None:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        path = tempfile.mkdtemp(prefix="townpulse-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path.rstrip("/")


#: Paths handed out inside each open ``scratch``, the innermost last.
_OPEN: list[list[str]] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if _OPEN:
        _OPEN[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end; what is to last has its path from before."""
    own: list[str] = []
    _OPEN.append(own)
    try:
        yield
    finally:
        _OPEN.remove(own)
        for name in own:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` once on shared storage, so that reuse and retries read it back."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Like ``cut_lineage``, but columnar: later steps read only the columns they use."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the workers of a cluster that has no copy of it, once per session.

    Python operators run its functions on the workers. Where it is installed there (see
    ``pyproject.toml``) this is not needed.
    """
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="townpulse-"), "townpulse.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("townpulse", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(path)

"""Reproducible samples and splits: they depend on the row's id and a seed alone."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from townpulse.operators.quantiles import cut_after
from townpulse.operators.topk import n_largest
from townpulse.session import stage


def draw(key: str, seed: int) -> Column:
    """A random-looking order of the ids."""
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def unit_draw(key: str, seed: int) -> Column:
    """A uniform number in [0, 1) per id, from the first 52 bits of ``draw``."""
    return F.conv(F.substring(draw(key, seed), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 42, total: int | None = None) -> DataFrame:
    """Exactly the ``n`` rows of smallest draw, ties by ``key``; all when there are fewer.

    Draws are uniform, so the ``n``-th smallest lies within a few deviations of ``n / total``.
    One pass counts the rows below that range and stages the few (draw, key) inside it,
    from which the cut is read; rows are then filtered, and no task holds the sample.
    """
    total = df.count() if total is None else total
    if total <= n:
        return df
    if n <= 0:
        return df.limit(0)
    share = n / total
    width = 8 * sqrt(share * (1 - share) / total) + 1 / total
    low, high = share - width, share + width
    marked = df.withColumn("_draw", unit_draw(key, seed))
    seen = Observation()
    inside = marked.observe(seen, F.count_if(F.col("_draw") < low).alias("below")).filter(F.col("_draw").between(low, high))
    inside = stage(inside.select("_draw", F.col(key).alias("_key")), "draws")
    wanted = n - seen.get["below"]
    first = inside.orderBy("_draw", "_key").limit(max(wanted, 0))
    found = first.agg(F.count("*").alias("n"), F.max(F.struct("_draw", "_key")).alias("last")).first()
    if wanted < 1 or found.n < wanted:  # eight deviations off: does not happen with uniform draws
        return marked.filter(cut_after(marked, "_draw", key, n, total)).drop("_draw")
    draw_at, key_at = (F.lit(x) for x in found.last)
    return marked.filter((F.col("_draw") < draw_at) | (F.col("_draw") == draw_at) & (F.col(key) <= key_at)).drop("_draw")


def sample_percent(df: DataFrame, percent: float, key: str, seed: int = 42) -> DataFrame:
    """Exactly ``floor(percent / 100 * n)`` rows of a table of any size."""
    total = df.count()
    return sample_rows(df, int(total * percent / 100), key, seed, total)


def scatter_sample(df: DataFrame, key: str, normal: int = 600, top: int = 800, seed: int = 42) -> DataFrame:
    """Plot sample: some rows scored up to 0.5 and the highest-scored others."""
    low = sample_rows(df.filter(F.col("anomaly_score") <= 0.5), normal, key, seed)
    high = n_largest(df.filter(F.col("anomaly_score") > 0.5), top, "anomaly_score", key)
    return low.unionByName(high)


def random_split(df: DataFrame, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``, true for about ``test_share`` of the ids."""
    return df.withColumn("is_test", unit_draw(key, seed) < F.lit(test_share))


def time_split(df: DataFrame, ts: str, key: str, ratio: float = 0.8) -> DataFrame:
    """Add ``is_train``, true for exactly the first ``floor(ratio * n)`` rows by time."""
    return df.withColumn("is_train", cut_after(df, ts, key, int(df.count() * ratio)))

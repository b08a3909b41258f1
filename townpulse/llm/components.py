"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.session import stage


def components(links: DataFrame) -> DataFrame:
    """``links`` (u, v) to (id, component): the smallest id reachable from each end of a link.

    Every round points neighbours at the smallest id near them: first those above a node
    (large star), then those below (small star), so the longest path shrinks to about its
    logarithm's number of rounds. Only minima per node are aggregated, no neighbourhood is
    gathered, and each round is staged.
    """
    ends = lambda df: df.select("u", "v").union(df.select(F.col("v").alias("u"), F.col("u").alias("v")))
    links = stage(links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    while True:
        both = ends(links)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(least.select("u", F.col("m").alias("v")))
        links = stage(small.distinct(), "links")
        # done once every link ends at a root: no end has a link of its own, nobody has two
        roots = links.select(F.col("v").alias("root")).distinct()
        twice = links.groupBy("u").agg(F.count("*").alias("n")).where("n > 1").select("u")
        if twice.union(links.join(roots, F.col("u") == F.col("root"), "left_semi").select("u")).isEmpty():
            named = links.select(F.col("u").alias("id"), F.col("v").alias("component"))
            return named.union(roots.select(F.col("root").alias("id"), F.col("root").alias("component")))

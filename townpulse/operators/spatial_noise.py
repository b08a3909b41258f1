"""Points that density clustering would call noise.

A point is core when at least ``min_samples`` points, itself included, lie within
``eps``; it is noise when it is not core and no core point lies within ``eps``.
Cluster numbers are not needed, so no connected components are built.

The grid has cells whose diagonal is just under ``eps``. In a cell of ``min_samples``
points or more all points are core. Only points of the other cells ("sparse", fewer
than ``min_samples`` points each) need neighbours:

* sparse against sparse: at most 25 cells of fewer than ``min_samples`` points;
* sparse against a full cell: the sparse points around a cell are a bounded list,
  handed to the rows of that cell by a salted join, counted by partial aggregation.

No step pairs up the points of one cell, however many it holds. The three results that
are used several times are staged on shared storage.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townpulse.operators.joins import salted_lookup
from townpulse.session import stage

_CELL = ["_i", "_j"]


def _near(eps: float, lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    return (lat - lat2) * (lat - lat2) + (lon - lon2) * (lon - lon2) <= F.lit(eps * eps)


def _around(cells: DataFrame) -> DataFrame:
    """Repeat each row for the 5 x 5 cells that can hold points within ``eps``."""
    steps = F.array(*[F.lit(s) for s in range(-2, 3)])
    return (
        cells.withColumn("_di", F.explode(steps)).withColumn("_dj", F.explode(steps))
        .withColumns({"_i": F.col("_i") + F.col("_di"), "_j": F.col("_j") + F.col("_dj")})
        .drop("_di", "_dj")
    )


def spatial_noise(df: DataFrame, key: str, eps: float = 0.01, min_samples: int = 5, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """(key, is_spatial_anomaly) for every row; rows without coordinates get 0."""
    side = eps / sqrt(2.0) * (1 - 1e-6)
    points = df.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        F.col(key).alias("_id"), F.col(lat).alias("_lat"), F.col(lon).alias("_lon"),
        F.floor(F.col(lat) / side).alias("_i"), F.floor(F.col(lon) / side).alias("_j"),
    )
    # At most min_samples points per cell travel on from each task, whatever the cell holds.
    cell = Window.partitionBy(*_CELL)
    few = points.withColumn("_rank", F.row_number().over(cell.orderBy("_id"))).filter(F.col("_rank") <= min_samples)
    few = stage(few.withColumn("_n", F.count(F.lit(1)).over(cell)), "cells")
    sparse = few.filter(F.col("_n") < min_samples).drop("_rank", "_n")
    full_cells = few.filter((F.col("_n") >= min_samples) & (F.col("_rank") == 1)).select(*_CELL)

    probes = _around(sparse.select(F.col("_id").alias("_p"), F.col("_lat").alias("_plat"), F.col("_lon").alias("_plon"), *_CELL))
    sparse_pairs = stage(probes.join(sparse, _CELL).filter(
        _near(eps, F.col("_plat"), F.col("_plon"), F.col("_lat"), F.col("_lon"))
    ).select("_p", "_id"), "pairs")

    # Probe lists of full cells: at most 24 neighbours of fewer than min_samples points each.
    probe_lists = probes.join(full_cells, _CELL, "left_semi").groupBy(*_CELL).agg(
        F.collect_list(F.struct("_p", "_plat", "_plon")).alias("_probes")
    )
    hits = salted_lookup(points, probe_lists, _CELL, ["_id"], "inner").select(
        F.explode_outer(F.filter(
            "_probes", lambda p: _near(eps, p["_plat"], p["_plon"], F.col("_lat"), F.col("_lon"))
        )).alias("_hit")
    ).filter(F.col("_hit").isNotNull())
    near_full = stage(hits.groupBy(F.col("_hit._p").alias("_id")).agg(F.count(F.lit(1)).alias("_full")), "hits")
    near_sparse = sparse_pairs.groupBy(F.col("_p").alias("_id")).agg(F.count(F.lit(1)).alias("_few"))

    counts = near_sparse.join(near_full, "_id", "left").withColumn("_full", F.coalesce("_full", F.lit(0)))
    core = counts.filter(F.col("_few") + F.col("_full") >= min_samples).select("_id")
    beside_core = sparse_pairs.join(core, "_id", "left_semi").select(F.col("_p").alias("_id"))
    safe = beside_core.unionByName(near_full.select("_id")).unionByName(core).distinct()
    noise = sparse.join(safe, "_id", "left_anti").select(F.col("_id").alias(key), F.lit(1).alias("_noise"))
    return df.select(key).join(noise, key, "left").select(
        key, F.coalesce(F.col("_noise"), F.lit(0)).alias("is_spatial_anomaly")
    )

"""Exact order statistics and running totals over whole columns of any size."""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, floor

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townpulse.session import cut_lineage

SMALL = 100_000
SKETCH = 10_000
#: Marks that a group's sketch is asked for.
GRID = 200


@dataclass
class _Target:
    """One wanted rank, and the open interval known to hold it with ``n`` values."""

    col: str
    rank: int
    n: int
    lo: object = None
    hi: object = None
    value: object = None
    done: bool = False

    def values(self) -> Column:
        """The column where it lies in the interval, else null."""
        v = F.col(self.col)
        if self.lo is None and self.hi is None:
            return v
        above = v > F.lit(self.lo) if self.lo is not None else F.lit(True)
        below = v < F.lit(self.hi) if self.hi is not None else F.lit(True)
        return F.when(above & below, v)

    def narrow(self, q_lo, q_hi, below_lo: int, upto_lo: int, below_hi: int, upto_hi: int) -> None:
        if self.rank < below_lo:
            self.hi, self.n = q_lo, below_lo
        elif self.rank < upto_lo:
            self.value, self.done = q_lo, True
        elif self.rank >= upto_hi:
            self.lo, self.n, self.rank = q_hi, self.n - upto_hi, self.rank - upto_hi
        elif self.rank >= below_hi:
            self.value, self.done = q_hi, True
        else:
            self.lo, self.hi = q_lo, q_hi
            self.n, self.rank = below_hi - upto_lo, self.rank - upto_lo


def order_statistics(df: DataFrame, ranks: dict[str, list[int]], sizes: dict[str, int]) -> dict[str, dict[int, object]]:
    """The values at the given ranks (from 0) of each column's non-null values in order.

    ``sizes`` holds the number of non-null values per column. A quantile sketch narrows
    the interval around each rank until few values are left; only those are ranked.
    Each round is a scan with partial aggregation for all ranks together, no row is
    shuffled, and the driver receives single numbers.
    """
    targets = [_Target(c, r, sizes[c]) for c, rs in ranks.items() for r in rs]
    wanted = [(t.col, t.rank) for t in targets]
    while large := [t for t in targets if not t.done and t.n > SMALL]:
        sketches = []
        for t in large:
            ends = [max(0.0, t.rank / t.n - 2 / SKETCH), min(1.0, t.rank / t.n + 2 / SKETCH)]
            sketches.append(F.percentile_approx(t.values(), F.array(*[F.lit(p) for p in ends]), F.lit(SKETCH)))
        cuts = df.agg(*[q.alias(f"q{i}") for i, q in enumerate(sketches)]).first()
        counts = []
        for t, (lo, hi) in zip(large, cuts):
            v = t.values()
            counts += [F.count_if(v < lo), F.count_if(v <= lo), F.count_if(v < hi), F.count_if(v <= hi)]
        row = df.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
        for i, (t, (lo, hi)) in enumerate(zip(large, cuts)):
            t.narrow(lo, hi, *row[4 * i:4 * i + 4])
    _rank_small(df, [t for t in targets if not t.done])
    found: dict[str, dict[int, object]] = {c: {} for c in ranks}
    for (c, rank), t in zip(wanted, targets):
        found[c][rank] = t.value
    return found


def _rank_small(df: DataFrame, targets: list[_Target]) -> None:
    """Look up ranks among at most ``SMALL`` values each, in one job per column."""
    for col in dict.fromkeys(t.col for t in targets):
        mine = [t for t in targets if t.col == col]
        spans = list(dict.fromkeys((t.lo, t.hi) for t in mine))
        rows = F.array_compact(F.array(*[
            F.when(_Target(col, 0, 0, lo, hi).values().isNotNull(), F.struct(F.lit(i).alias("span"), F.col(col).alias("v")))
            for i, (lo, hi) in enumerate(spans)
        ]))
        counts = df.select(F.explode_outer(rows).alias("e")).filter("e IS NOT NULL").groupBy("e.span", "e.v").agg(F.count(F.lit(1)).alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(Window.partitionBy("span").orderBy("v")))
        picks = [
            F.min(F.when((F.col("span") == spans.index((t.lo, t.hi))) & (F.col("upto") > t.rank), F.col("v"))).alias(f"r{i}")
            for i, t in enumerate(mine)
        ]
        for t, value in zip(mine, upto.agg(*picks).first()):
            t.value = value


def exact_quantiles(df: DataFrame, col: str, probabilities: list[float]) -> list[float | None]:
    """Quantiles of one column with linear interpolation between neighbouring values."""
    return column_quantiles(df, [col], probabilities)[col]


def column_quantiles(df: DataFrame, cols: list[str], probabilities: list[float]) -> dict[str, list[float | None]]:
    """Exact quantiles of several columns, narrowed down together."""
    row = df.agg(*[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)]).first()
    sizes = {c: n for c, n in zip(cols, row) if n}
    places = {c: [(n - 1) * p for p in probabilities] for c, n in sizes.items()}
    ranks = {c: sorted({f(x) for x in xs for f in (floor, ceil)}) for c, xs in places.items()}
    found = order_statistics(df, ranks, sizes)
    result: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in cols}
    for c, xs in places.items():
        at = {r: float(v) for r, v in found[c].items()}
        result[c] = [at[floor(x)] + (at[ceil(x)] - at[floor(x)]) * (x - floor(x)) for x in xs]
    return result


def grouped_quantiles(df: DataFrame, by: list[str], col: str, probabilities: list[float]) -> DataFrame:
    """Exact quantiles per group, columns ``q0``, ``q1``, ... with linear interpolation, and ``n``; null values are left out.

    The same narrowing as for a whole column, for all groups at once: a sketch per group and
    rank gives an interval, rows outside are counted and dropped, and once no group has many
    values left those are ranked. Intervals are a table with a row per group and rank that
    is joined, not collected, so neither the groups nor their distinct values need be few.
    """
    rows = df.select(*by, F.col(col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    keys = [F.col(c).alias(f"_k{i}") for i, c in enumerate(by)]
    names = [f"_k{i}" for i in range(len(by))]
    rows = rows.select(*keys, "_v")
    sizes = cut_lineage(rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_n")))
    place = lambda p: (F.col("_n") - 1) * F.lit(float(p))
    wanted = F.array_distinct(F.array(*[f(place(p)).cast("long") for p in probabilities for f in (F.floor, F.ceil)]))
    # every wanted rank of every group, the interval that holds it, and the values below that
    targets = sizes.select(*names, F.col("_n").alias("_left"), F.explode(wanted).alias("_rank"), F.lit(None).cast("double").alias("_lo"), F.lit(None).cast("double").alias("_hi"), F.lit(0).cast("long").alias("_below"))
    targets = cut_lineage(targets)

    def inside(targets: DataFrame) -> DataFrame:
        same = [F.col(f"r.{k}").eqNullSafe(F.col(f"t.{k}")) for k in names]
        held = (F.col("_lo").isNull() | (F.col("r._v") >= F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("r._v") <= F.col("_hi")))
        joined = rows.alias("r").join(targets.alias("t"), [*same, held]) if same else rows.alias("r").join(targets.alias("t"), held)
        return joined.select(*[F.col(f"t.{k}").alias(k) for k in names], "t._rank", "t._below", "t._left", "r._v")

    while not targets.filter(F.col("_left") > SMALL).isEmpty():
        large, small = targets.filter(F.col("_left") > SMALL), targets.filter(F.col("_left") <= SMALL)
        own = (F.col("_rank") - F.col("_below")) / F.col("_left")
        each = [*names, "_rank", "_below", "_left"]
        # the sketch takes fixed probabilities; the two marks around the rank are picked from an even grid of them
        grid = [i / GRID for i in range(GRID + 1)]
        marks = inside(large).groupBy(*each).agg(F.percentile_approx("_v", F.array(*map(F.lit, grid)), F.lit(SKETCH)).alias("_g"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        at = F.floor(own * GRID).cast("int")
        low, high = F.when(at >= 1, F.get("_g", at - 1)).otherwise(F.col("_a")), F.when(at + 2 <= GRID, F.get("_g", at + 2)).otherwise(F.col("_b"))
        cuts = cut_lineage(marks.select(*each, low.alias("_lo2"), high.alias("_hi2")))
        on = [F.col(f"i.{k}").eqNullSafe(F.col(f"c.{k}")) for k in each]
        counted = inside(large).alias("i").join(cuts.alias("c"), on).groupBy(*[F.col(f"c.{k}").alias(k) for k in [*each, "_lo2", "_hi2"]]).agg(
            F.count_if(F.col("_v") < F.col("_lo2")).alias("_under"), F.count_if(F.col("_v").between(F.col("_lo2"), F.col("_hi2"))).alias("_within"))
        narrowed = counted.select(*names, F.col("_within").alias("_left"), "_rank", F.col("_lo2").alias("_lo"), F.col("_hi2").alias("_hi"), (F.col("_below") + F.col("_under")).alias("_below"), F.col("_left").alias("_had"))
        narrowed = cut_lineage(narrowed)
        # an interval of one value is known; one that no longer shrinks is ranked as it is
        settled = (F.col("_lo") == F.col("_hi")) | (F.col("_left") >= F.col("_had"))
        left = F.when(settled, F.lit(0)).otherwise(F.col("_left"))
        targets = cut_lineage(small.unionByName(narrowed.withColumn("_left", left).drop("_had")))
    counts = inside(targets).groupBy(*names, "_rank", "_below", "_v").agg(F.count(F.lit(1)).alias("_m"))
    upto = F.col("_below") + F.sum("_m").over(Window.partitionBy(*names, "_rank").orderBy("_v"))
    found = counts.withColumn("_upto", upto).filter(F.col("_upto") > F.col("_rank")).groupBy(*names, "_rank").agg(F.min("_v").alias("_v"))
    ranked = found.groupBy(*names).agg(F.map_from_entries(F.collect_list(F.struct("_rank", "_v"))).alias("_at"))
    joined = sizes.alias("s").join(ranked.alias("f"), [F.col(f"s.{k}").eqNullSafe(F.col(f"f.{k}")) for k in names])
    columns = []
    for i, p in enumerate(probabilities):
        low, high = (F.try_element_at("_at", f(place(p)).cast("long")) for f in (F.floor, F.ceil))
        columns.append((low + (high - low) * (place(p) - F.floor(place(p)))).alias(f"q{i}"))
    return joined.select(*[F.col(f"s.{k}").alias(c) for k, c in zip(names, by)], F.col("_n").alias("n"), *columns)


def with_range_bucket(df: DataFrame, col: str, buckets: int, name: str = "bucket") -> DataFrame:
    """Number the ranges of a double column so that each holds about as many rows."""
    cuts = sorted(set(df.approxQuantile(col, [i / buckets for i in range(1, buckets)], 0.25 / buckets)))
    if not cuts:
        return df.withColumn(name, F.lit(0.0))
    bucketizer = Bucketizer(splits=[-float("inf"), *cuts, float("inf")], inputCol=col, outputCol=name)
    return bucketizer.transform(df)


def running_totals(df: DataFrame, order: str, sums: dict[str, Column], buckets: int | None = None) -> DataFrame:
    """Add, per name in ``sums``, the total over all rows up to and including this one.

    ``order`` must be unique. Rows are summed inside value ranges of equal size; the
    totals of the ranges before come from a table with one row per range.
    """
    buckets = buckets or max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = with_range_bucket(df.withColumns({f"_{k}": v for k, v in sums.items()}), order, buckets, "_bucket")
    totals = ranged.groupBy("_bucket").agg(*[F.sum(f"_{k}").alias(k) for k in sums])
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_bucket", *[F.coalesce(F.sum(k).over(before), F.lit(0)).alias(f"_before_{k}") for k in sums]
    )
    inside = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return ranged.join(F.broadcast(offsets), "_bucket").select(
        *df.columns,
        *[(F.col(f"_before_{k}") + F.sum(f"_{k}").over(inside)).alias(k) for k in sums],
    )


def value_at(df: DataFrame, col: str, rank: int, n: int):
    return order_statistics(df, {col: [rank]}, {col: n})[col][rank]


def cut_after(df: DataFrame, order: str, tie: str, rows: int, known: int | None = None) -> Column:
    """True for exactly the first ``rows`` rows by (order, tie); ``tie`` must be unique.

    Rows whose ``order`` is null come last. ``known``, if given, says that there are that
    many rows and no such nulls.
    """
    missing = 0
    if known is None:
        known, missing = df.agg(F.count(order), F.count_if(F.col(order).isNull())).first()
    if rows <= 0:
        return F.lit(False)
    if rows >= known + missing:
        return F.lit(True)
    if rows > known:
        last = value_at(df.filter(F.col(order).isNull()), tie, rows - known - 1, missing)
        return F.col(order).isNotNull() | (F.col(tie) <= F.lit(last))
    edge = value_at(df, order, rows - 1, known)
    x = F.col(order)
    before, tied = df.agg(F.count_if(x < F.lit(edge)), F.count_if(x == F.lit(edge))).first()
    if before + tied == rows:
        return F.coalesce(x <= F.lit(edge), F.lit(False))
    last = value_at(df.filter(x == F.lit(edge)), tie, rows - before - 1, tied)
    return F.coalesce((x < F.lit(edge)) | ((x == F.lit(edge)) & (F.col(tie) <= F.lit(last))), F.lit(False))

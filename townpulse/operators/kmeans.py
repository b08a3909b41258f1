"""Many k-means models in one loop, and their silhouettes in one pass.

Every iteration reads the rows once: a batch is compared with the centres of all models
that still move, and only sums per centre leave a task. So a search over many numbers of
clusters and restarts costs as many passes as its slowest model, not as all of them
together. First centres are drawn from all rows. Up to ``HELD_ROWS`` rows a task holds the
table and moves the centres of a model until they rest; a larger table is passed over for
every step. Sums, centres and tables of that size are all that the driver and a task hold.

The silhouette compares every row with every other one. A task holds a part of the rows with
their sums of distances to each cluster, and all rows stream past it; so its cost grows with
the square of the rows, and what is shuffled with rows times parts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townpulse.session import scratch, stage

#: Rows, those of smallest hash, over which models rest before they go on over ``WIDENING`` times as many, and so on up to all; no number stands for all at once.
START_ROWS: int | None = None
WIDENING = 8
#: Rows that a task holds at most to move the centres of a model by itself.
HELD_ROWS = 100_000
#: Rows whose sums of distances a task holds at most, and those that stream past it at a time.
PART_ROWS = 50_000
SILHOUETTE_ROWS = 1_000
MOST_ROUNDS = 300
#: Rows compared at a time, and those whose distances to all rows of a stream stay near the processor.
BLOCK = 1024
CACHED = 128


@dataclass
class Model:
    """Centres of one model, the cost of all rows against them, and its number of rounds."""

    k: int
    centres: np.ndarray
    cost: float = np.inf
    rounds: int = 0
    done: bool = False


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as rows."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def packed(rows: np.ndarray) -> pa.Array:
    """The bytes of each row of a matrix, which Spark copies faster than lists."""
    offsets = np.arange(len(rows) + 1) * rows.itemsize * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])


def unpacked(column: pa.Array, kind: type) -> np.ndarray:
    """Rows of ``packed``."""
    if not len(column):
        return np.zeros((0, 0), kind)
    column = column.cast(pa.binary())
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]].view(kind).reshape(len(column), -1)


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances; near ones are taken from the differences, as the short cut loses their digits."""
    norms, others = (x * x).sum(axis=1)[:, None], (centres * centres).sum(axis=1)
    out = norms - 2 * (x @ centres.T) + others
    i, j = np.nonzero(out < 1e-6 * (norms + others))
    out[i, j] = ((x[i] - centres[j]) ** 2).sum(axis=1)
    return out


def drawn(features: str, n: int, most: int) -> Column:
    """Whether a row is among about ``most`` of ``n``, by a hash of its values."""
    return F.shiftrightunsigned(F.xxhash64(features), 11) / F.lit(float(1 << 53)) * F.lit(float(n)) < most


def first_centres(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Centres far apart: each the best of some rows drawn by their cost against those before it."""
    centres = [rows[rng.integers(len(rows))]]
    near = squared(rows, np.array(centres))[:, 0]
    for _ in range(k - 1):
        total = near.sum()
        tried = rng.choice(len(rows), 2 + int(np.log(k)), p=near / total if total > 0 else None)
        left = np.minimum(squared(rows, rows[tried]), near[:, None])
        best = left.sum(axis=0).argmin()
        centres.append(rows[tried[best]])
        near = left[:, best]
    return np.array(centres)


class _Grouping:
    """The centres of many models, ready to be compared with blocks of rows at once.

    Rows and centres are taken relative to ``origin``, which leaves distances as they are
    and keeps their digits. All centres meet a block in one product; what a row's own norm
    adds is the same for all and comes in with the cost.
    """

    def __init__(self, models: list[np.ndarray], origin: np.ndarray):
        self.origin, centres = origin, np.concatenate(models) - origin
        self.weights = np.column_stack([-2 * centres, (centres * centres).sum(axis=1)])
        self.runs, at, first = [], 0, 0  # neighbours of equal k share their steps: (first model, models, first centre, k)
        for k, same in groupby(len(m) for m in models):
            m = len(list(same))
            self.runs.append((first, m, at, k))
            at, first = at + m * k, first + m
        self.sums = np.zeros((at, len(origin) + 1))  # of the rows of a centre, and behind them their number
        self.cost = np.zeros(first)

    def add(self, x: np.ndarray) -> None:
        """Give each row of a block to the nearest centre of every model, of equal ones to the first."""
        near = np.ones((x.shape[1] + 1, len(x)))
        near[:-1] = (x - self.origin).T
        far = self.weights @ near
        norms = (near[:-1] ** 2).sum()
        for first, m, at, k in self.runs:
            part = far[at:at + m * k].reshape(m, k, -1)
            least = part.min(axis=1)
            self.cost[first:first + m] += least.sum(axis=1) + norms
            own = part == least[:, None]
            if np.count_nonzero(own) > least.size:
                own &= np.cumsum(own, axis=1) == 1
            part[:] = own
        self.sums += far @ np.column_stack([x, np.ones(len(x))])

    def moved(self) -> list[np.ndarray]:
        """The new centres of each model; one without rows stays."""
        n = self.sums[:, -1:]
        centres = np.where(n > 0, self.sums[:, :-1] / np.maximum(n, 1), self.weights[:, :-1] / -2 + self.origin)
        return [centres[at + i * k:at + (i + 1) * k] for _, m, at, k in self.runs for i in range(m)]


def _round(df: DataFrame, features: str, moving: list[np.ndarray], origin: np.ndarray) -> _Grouping:
    """All rows given to the centres of each model, from one pass."""
    shared = df.sparkSession.sparkContext.broadcast((moving, origin))

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _Grouping(*shared.value)
        for batch in batches:
            rows = matrix(batch.column(0))
            for i in range(0, len(rows), BLOCK):
                own.add(rows[i:i + BLOCK])
        # behind the sums of a centre and its rows, the cost of the model of that number
        flat = np.zeros((len(own.sums), own.sums.shape[1] + 1))
        flat[:, :-1], flat[:len(own.cost), -1] = own.sums, own.cost
        at = np.indices(flat.shape).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(at[0], pa.int32()), pa.array(at[1], pa.int32()), pa.array(flat.ravel())], ["centre", "place", "value"])

    parts = df.select(features).mapInArrow(add_up, "centre INT, place INT, value DOUBLE")
    total = parts.groupBy("centre", "place").agg(F.sum("value").alias("value")).toArrow()
    shared.unpersist()
    whole = _Grouping(moving, origin)
    out = np.zeros((len(whole.sums), whole.sums.shape[1] + 1))
    out[total["centre"].to_numpy(), total["place"].to_numpy()] = total["value"].to_numpy()
    whole.sums, whole.cost = out[:, :-1], np.maximum(out[:len(whole.cost), -1], 0)
    return whole


def settled(start: np.ndarray, centres: np.ndarray, least: float) -> np.ndarray:
    """Centres moved over the starting rows alone until they rest, by the rule of ``fit_many``."""
    origin = start.mean(axis=0)
    for _ in range(MOST_ROUNDS):
        own = _Grouping([centres], origin)
        for i in range(0, len(start), BLOCK):
            own.add(start[i:i + BLOCK])
        [moved] = own.moved()
        if ((moved - centres) ** 2).sum() <= least:
            return centres
        centres = moved
    return centres


def _first_models(spark: SparkSession, start: np.ndarray, ks: list[int], restarts: int, seed: int, least: float) -> list[Model]:
    """All models where they rest on the starting rows; each is found by a task, so that few passes over all rows are left."""
    wanted = [(k, r) for k in ks for r in range(restarts)]
    shared = spark.sparkContext.broadcast(start)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                k, r = wanted[i]
                centres = settled(shared.value, first_centres(shared.value, k, np.random.default_rng([seed, k, r])), least)
                yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([centres.ravel().tolist()])], ["model", "centres"])

    found = spark.range(0, len(wanted), 1, max(1, len(wanted))).mapInArrow(find, "model INT, centres ARRAY<DOUBLE>").collect()
    shared.unpersist()
    return [Model(k, np.array(r.centres).reshape(k, -1)) for (k, _), r in zip(wanted, sorted(found, key=lambda r: r.model))]


def _rest(df: DataFrame, features: str, models: list[Model], origin: np.ndarray, least: float) -> None:
    """Move the centres of all models until they rest on the rows of ``df``."""
    for model in models:
        model.done, model.rounds = False, 0
    while moving := [m for m in models if not m.done]:
        found = _round(df, features, [m.centres for m in moving], origin)
        for model, cost, moved in zip(moving, found.cost, found.moved()):
            model.cost, model.rounds = cost, model.rounds + 1
            model.done = ((moved - model.centres) ** 2).sum() <= least or model.rounds >= MOST_ROUNDS
            if not model.done:
                model.centres = moved


def _sums(rows: DataFrame, values: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sums of the columns that ``values`` makes of blocks of rows, for each part in order."""
    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0.0
        for part, x in _blocks(batches):
            total = total + values(x).sum(axis=0)
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([total.tolist()])], ["part", "sums"])

    found = rows.mapInArrow(add_up, "part INT, sums ARRAY<DOUBLE>").collect()
    return np.array([r.sums for r in sorted(found, key=lambda r: r.part)])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray]]:
    """Part and rows, ``BLOCK`` at a time."""
    for batch in batches:
        rows = matrix(batch.column(0))
        for i in range(0, len(rows), BLOCK):
            yield batch.column(1)[0].as_py(), rows[i:i + BLOCK]


def _costs(x: np.ndarray, models: list[np.ndarray]) -> np.ndarray:
    """(row, model): the squared distance to the nearest centre."""
    firsts = np.cumsum([0] + [len(m) for m in models[:-1]])
    return np.minimum.reduceat(squared(x, np.concatenate(models)), firsts, axis=1)


def _rows_at(rows: DataFrame, weigh: Callable[[np.ndarray], np.ndarray], places: list[tuple[int, int, float]]) -> np.ndarray:
    """For each (part, column, sum) the first row of the part where the running sum of that column of ``weigh`` exceeds the sum."""
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upto, left, last = 0.0, None, {}
        for part, x in _blocks(batches):
            if left is None:
                left = [(i, c, total) for i, (p, c, total) in enumerate(places) if p == part]
            if not left:
                continue
            weights = weigh(x)
            running = upto + np.cumsum(weights, axis=0)
            upto, found = running[-1], []
            for i, c, total in left:
                if running[-1, c] > total:
                    found.append((i, x[np.searchsorted(running[:, c], total, side="right")]))
                elif weights[:, c].any():  # the last to take where rounding leaves a sum beyond all rows
                    last[i] = x[np.flatnonzero(weights[:, c])[-1]]
            gone = {i for i, _ in found}
            left = [place for place in left if place[0] not in gone]
            if found:
                yield rows_of(found)
        if left:
            yield rows_of([(i, last[i]) for i, *_ in left])

    def rows_of(found: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int32()), pa.array([x.tolist() for _, x in found])], ["place", "x"])

    got = rows.mapInArrow(find, "place INT, x ARRAY<DOUBLE>").collect()
    return np.array([r.x for r in sorted(got, key=lambda r: r.place)])


def spread_centres(rows: DataFrame, sizes: np.ndarray, wanted: list[tuple[int, int]], seed: int) -> list[np.ndarray]:
    """What ``first_centres`` draws for each (k, restart) from all rows, by passes over the ordered ``rows`` of parts of these ``sizes``."""
    rngs = [np.random.default_rng([seed, k, r]) for k, r in wanted]
    n, ends = int(sizes.sum()), np.cumsum(sizes)

    def numbered(i: int) -> tuple[int, int, float]:
        part = int(np.searchsorted(ends, i, side="right"))
        return part, 0, float(i - (ends[part] - sizes[part]))

    first = _rows_at(rows, lambda x: np.ones((len(x), 1)), [numbered(rng.integers(n)) for rng in rngs])
    centres = [x[None] for x in first]
    totals = _sums(rows, lambda x: _costs(x, centres))  # (part, model)
    for size in range(1, max(k for k, _ in wanted)):
        growing = [m for m, (k, _) in enumerate(wanted) if k > size]
        own, by_cost, by_number, owner = [centres[m] for m in growing], [], [], []
        for g, m in enumerate(growing):
            upto, tries = np.cumsum(totals[:, m]), 2 + int(np.log(wanted[m][0]))
            owner += [g] * tries
            if upto[-1] > 0:
                for total in rngs[m].random(tries) * upto[-1]:
                    part = min(int(np.searchsorted(upto, total, side="right")), int(np.flatnonzero(totals[:, m])[-1]))
                    by_cost.append((part, g, total - (upto[part] - totals[part, m])))
            else:
                by_number += [numbered(i) for i in rngs[m].integers(0, n, tries)]
        for_cost = [i for i, g in enumerate(owner) if totals[:, growing[g]].any()]
        for_number = [i for i, g in enumerate(owner) if not totals[:, growing[g]].any()]
        tried = np.empty((len(owner), first.shape[1]))
        if by_cost:
            tried[for_cost] = _rows_at(rows, lambda x: _costs(x, own), by_cost)
        if by_number:
            tried[for_number] = _rows_at(rows, lambda x: np.ones((len(x), 1)), by_number)
        left = _sums(rows, lambda x: np.minimum(squared(x, tried), _costs(x, own)[:, owner]))
        for g, m in enumerate(growing):
            mine = np.flatnonzero(np.array(owner) == g)
            best = mine[left[:, mine].sum(axis=0).argmin()]
            centres[m], totals[:, m] = np.vstack([centres[m], tried[best]]), left[:, best]
    return centres


def _spread_models(df: DataFrame, features: str, ks: list[int], restarts: int, seed: int) -> tuple[list[Model], np.ndarray, float]:
    """All models with first centres from all rows, the mean row, and the mean variance of a feature."""
    rows = df.select(F.col(features).alias("x")).orderBy("x").withColumn("part", F.spark_partition_id()).persist()
    try:
        sums = _sums(rows, lambda x: np.column_stack([np.ones(len(x)), x]))
        sizes = sums[:, 0].astype(int)
        parts = [r.part for r in rows.select("part").distinct().orderBy("part").collect()]
        names = F.create_map(*[F.lit(v) for i, part in enumerate(parts) for v in (part, i)])
        origin = sums[:, 1:].sum(axis=0) / sizes.sum()
        variance = (_sums(rows, lambda x: (x - origin) ** 2).sum(axis=0) / sizes.sum()).mean()
        wanted = [(k, r) for k in ks for r in range(restarts)]
        centres = spread_centres(rows.select("x", names[F.col("part")].alias("part")), sizes, wanted, seed)
    finally:
        rows.unpersist()
    return [Model(k, c) for (k, _), c in zip(wanted, centres)], origin, float(variance)


def fit_many(df: DataFrame, features: str, ks: list[int], restarts: int = 10, seed: int = 42, tolerance: float = 1e-4) -> list[Model]:
    """The best of ``restarts`` models for every k, by cost. ``features`` is an array column.

    A model stops once its centres move by no more than ``tolerance`` of the mean variance,
    or after ``MOST_ROUNDS``; a centre without rows stays where it is. A table without rows
    has no models.
    """
    n = df.count()
    upto = START_ROWS or n
    some = df.where(drawn(features, n, upto)) if upto < n else df
    if min(upto, n) <= HELD_ROWS:
        start = matrix(some.select(features).toArrow()[features])
        if not len(start):
            return []
        start = start[np.lexsort(start.T[::-1])]
        least, origin = tolerance * start.var(axis=0).mean(), start.mean(axis=0)
        models = _first_models(df.sparkSession, start, ks, restarts, seed, least)
    else:
        models, origin, variance = _spread_models(some, features, ks, restarts, seed)
        least = tolerance * variance
    while 2 * (upto := upto * WIDENING) <= n:
        some = df.where(drawn(features, n, upto)).select(features).persist()
        try:
            _rest(some, features, models, origin, least)
        finally:
            some.unpersist()
    _rest(df, features, models, origin, least)
    return [min((m for m in models if m.k == k), key=lambda m: m.cost) for k in ks]


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return squared(x, centres).argmin(axis=1)


def widths(sums: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Silhouette of each row from the ``sums`` of its distances to the rows of each cluster, itself among them, ``sizes`` in number.

    0 for rows alone in their cluster, and where only one cluster has rows.
    """
    at = np.arange(len(sums))
    others = sizes[labels] - 1
    own = sums[at, labels] / np.maximum(others, 1)
    means = np.where(sizes > 0, sums / np.maximum(sizes, 1), np.inf)
    means[at, labels] = np.inf
    other = means.min(axis=1, initial=np.inf)
    top = np.maximum(own, other)
    known = (others > 0) & np.isfinite(other) & (top > 0)
    return np.where(known, (np.where(known, other, 0) - own) / np.where(known, top, 1), 0)


class _Held:
    """Rows with their labels in all labellings, and their sums of distances to each cluster of each labelling, of the rows that streamed past."""

    def __init__(self, x: np.ndarray, labels: np.ndarray, ks: list[int]):
        self.labels, self.ks, self.origin = labels, ks, x.mean(axis=0)
        self.x, middle = x, x - self.origin
        self.norms = (middle * middle).sum(axis=1)
        self.left = np.column_stack([middle, np.ones(len(x)), self.norms])
        self.sums, self.sizes = np.zeros((len(x), sum(ks))), np.zeros(sum(ks))

    def add(self, x: np.ndarray, labels: np.ndarray) -> None:
        cell = np.zeros(len(x), int)  # rows of equal labels in all labellings together
        for m, k in enumerate(self.ks):
            cell = np.unique(cell * k + labels[:, m], return_inverse=True)[1].ravel()
        order = np.argsort(cell, kind="stable")
        x, labels, cell = x[order], labels[order], cell[order]
        firsts = np.flatnonzero(np.diff(cell, prepend=-1))
        groups = np.concatenate([np.eye(k)[labels[firsts, m]] for m, k in enumerate(self.ks)], axis=1)
        self.sizes += np.diff(np.append(firsts, len(x))) @ groups
        middle = x - self.origin
        norms = (middle * middle).sum(axis=1)
        weights = np.column_stack([-2 * middle, norms, np.ones(len(x))]).T.copy()
        least, room = 1e-6 * (self.norms + norms.max()), np.empty((CACHED, len(x)))
        for i in range(0, len(self.x), CACHED):
            far = np.matmul(self.left[i:i + CACHED], weights, out=room[:len(self.x) - i])
            close = np.flatnonzero(far.min(axis=1) < least[i:i + CACHED])
            r, j = np.nonzero(far[close] < least[i + close, None])  # these lose their digits
            r = close[r]
            far[r, j] = ((self.x[i + r] - x[j]) ** 2).sum(axis=1)
            self.sums[i:i + CACHED] += np.add.reduceat(np.sqrt(far, out=far), firsts, axis=1) @ groups

    def totals(self) -> pa.RecordBatch:
        """(labelling, label, n, width): the held rows of each cluster, and their silhouettes added up."""
        at, counts, sums, first = [(m, label) for m, k in enumerate(self.ks) for label in range(k)], [], [], 0
        for m, k in enumerate(self.ks):
            own, labels = slice(first, first + k), self.labels[:, m]
            counts.append(np.bincount(labels, minlength=k))
            sums.append(np.bincount(labels, widths(self.sums[:, own], self.sizes[own], labels), k))
            first += k
        m, label = np.array(at, np.int32).T
        return pa.RecordBatch.from_arrays([pa.array(m), pa.array(label), pa.array(np.concatenate(counts).astype(np.int64)), pa.array(np.concatenate(sums))], ["labelling", "label", "n", "width"])


def _part_keys(spark: SparkSession, parts: int) -> list[int]:
    """A key for each part, such that a shuffle by it into so many partitions gives every part its own."""
    ids = spark.range(50 * parts)
    found = {r[0] for r in ids.groupBy(F.pmod(F.hash("id"), F.lit(parts))).agg(F.min("id").alias("id")).select("id").collect()}
    return [*found, *(i for i in range(parts) if i not in found)][:parts]


def silhouettes(df: DataFrame, features: str, labellings: list[np.ndarray] | None = None, label: str | None = None, n_labels: int = 0) -> DataFrame:
    """(labelling, label, n, width): rows and mean silhouette of each cluster, for many labellings at once.

    A labelling is given by its centres; with ``label`` the only one is that column, which
    counts from 0 to below ``n_labels``. All pairs of rows are compared; the distances of a
    pair serve all labellings.
    """
    spark, ks = df.sparkSession, [n_labels] if label is not None else [len(c) for c in labellings]

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                labels = np.column_stack([batch.column(1).to_numpy()] if label is not None else [nearest(x, c) for c in labellings])
                yield pa.RecordBatch.from_arrays([packed(x), packed(labels.astype(np.int32))], ["x", "labels"])

    rows = df.select(features, *[label] * (label is not None)).mapInArrow(labelled, "x BINARY, labels BINARY")
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "labelled")
    n = rows.count()
    parts = max(1, ceil(n / PART_ROWS), min(4 * spark.sparkContext.defaultParallelism, ceil(n / BLOCK)))
    keys = F.lit(_part_keys(spark, parts))
    held = rows.select(F.get(keys, (F.col("row") % parts).cast("int")).alias("part"), F.lit(0).alias("streams"), "x", "labels")
    passing = rows.select(F.explode(keys).alias("part"), F.lit(1).alias("streams"), "x", "labels")
    dealt = held.unionByName(passing).repartition(parts, "part").sortWithinPartitions("part", "streams", "labels")

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, own = None, [], None
        for batch in batches:
            part, streams = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            x, labels = unpacked(batch.column(2), np.float64), unpacked(batch.column(3), np.int32)
            cuts = np.flatnonzero((np.diff(part) != 0) | (np.diff(streams) != 0)) + 1
            for i, j in zip([0, *cuts], [*cuts, len(x)]):
                if i == j:
                    continue
                if part[i] != now:
                    if own is not None:
                        yield own.totals()
                    now, waiting, own = part[i], [], None
                if not streams[i]:
                    waiting.append((x[i:j], labels[i:j]))
                    continue
                if own is None and waiting:
                    own, waiting = _Held(*map(np.concatenate, zip(*waiting)), ks), []
                for at in range(i, j if own is not None else i, SILHOUETTE_ROWS):
                    own.add(x[at:min(j, at + SILHOUETTE_ROWS)], labels[at:min(j, at + SILHOUETTE_ROWS)])
        if own is not None:
            yield own.totals()

    totals = dealt.mapInArrow(add_up, "labelling INT, label INT, n LONG, width DOUBLE")
    return totals.groupBy("labelling", "label").agg(F.sum("n").alias("n"), F.sum("width").alias("total")).where("n > 0").select(
        "labelling", "label", "n", (F.col("total") / F.col("n")).alias("width")
    )


def mean_silhouettes(df: DataFrame, features: str, labellings: list[np.ndarray]) -> list[float]:
    """The silhouette of each labelling over all rows; 0 without rows."""
    with scratch(df.sparkSession):
        per = silhouettes(df, features, labellings)
        found = {r.labelling: r.mean for r in per.groupBy("labelling").agg((F.sum(F.col("width") * F.col("n")) / F.sum("n")).alias("mean")).collect()}
    return [float(found.get(i, 0.0)) for i in range(len(labellings))]

"""Regression forest with several outputs: trees grow as Spark tasks, prediction runs in Arrow batches.

A tree chooses the split of a node among all features and all borders between values, by
the squared error added up over the outputs, and keeps the mean of every output in every
node. Because each choice depends on nothing but the rows of a node, one growth serves many
parameters: a tree cut at a smaller depth, or at nodes of fewer rows than a split needs, is
the tree that would have grown under those limits, and the first trees of a forest are the
smaller forest. Only the least size of a leaf changes the splits themselves.

A tree draws as many rows as there are to train on, with replacement, from all of them; they
pass the driver and are broadcast, 1.7 KB for a day of one series. A caller may bound the rows
that trees draw from (a pool, by a hash of their key) and the rows drawn for each tree, which
also bounds the forest (fewer than two nodes for each row drawn). A forest goes from shared
storage to the rows it scores, through a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import count
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from townpulse.session import stage

#: Rows that trees draw from, and rows drawn for a tree; no number stands for all.
POOL_ROWS: int | None = None
TREE_ROWS: int | None = None
BLOCK = 40_000  # numbers handled at a time while a tree grows
PART_ROWS = 4_000  # rows that meet a forest at a time
NODES = "job INT, tree INT, node INT, feature INT, threshold DOUBLE, left INT, rows INT, depth INT, value ARRAY<DOUBLE>"
_NODES = pa.schema([(c, pa.int32()) for c in ("job", "tree", "node", "feature")] + [("threshold", pa.float64())] + [(c, pa.int32()) for c in ("left", "rows", "depth")] + [("value", pa.list_(pa.float64()))])


def first_equal(values: np.ndarray, begins: np.ndarray, ends: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The first place from ``begins`` to ``ends`` whose value is the wanted one, for each of these ranges."""
    sizes = ends - begins
    places = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    hits = np.where(values[places] == np.repeat(wanted, sizes), places, len(values))
    return np.minimum.reduceat(hits, np.cumsum(sizes) - sizes) if len(sizes) else places


def grow_tree(x: np.ndarray, y: np.ndarray, times: np.ndarray, min_leaf: int = 1, min_split: int = 2, max_depth: int | None = None) -> dict[str, np.ndarray]:
    """Grow all nodes of a level at once; the right child of a node is the one behind the left.

    ``times`` says how often each row was drawn; sizes of nodes and leaves count rows once.
    Of equal splits the first feature's lowest one is taken. A node whose rows agree in all
    outputs is a leaf.
    """
    drawn = np.flatnonzero(times)
    x, y, w = np.ascontiguousarray(x[drawn].T), y[drawn], times[drawn].astype(float)
    n, outputs = y.shape
    wy = y * w[:, None]
    summed = np.column_stack([w, wy, np.zeros((n, (outputs + 1) % 2))])
    pairs = [summed[:, i] + 1j * summed[:, i + 1] for i in range(0, outputs + 1, 2)]  # two sums at a time, as one complex number
    offsets = np.arange(len(x))[:, None] * n
    indices, numbers, complexes = (np.empty(max(BLOCK, n), kind) for kind in (int, float, complex))
    feature, left, rows, depth = (np.full(2 * n, v) for v in (-1, -1, 0, 0))
    threshold, value = np.full(2 * n, np.nan), np.zeros((2 * n, outputs))
    order = np.argsort(x, axis=1, kind="stable")  # rows of each feature by node and value
    nodes, sizes, used, level = np.zeros(1, int), np.array([n]), 1, 0
    while len(nodes):
        starts = np.cumsum(sizes) - sizes
        own = order[0]
        weight, total = np.add.reduceat(w[own], starts), np.add.reduceat(wy[own], starts)
        rows[nodes], depth[nodes], value[nodes] = sizes, level, total / weight[:, None]
        mixed = (np.minimum.reduceat(y[own], starts) < np.maximum.reduceat(y[own], starts)).any(axis=1)
        goes_on = mixed & (sizes >= max(min_split, 2 * min_leaf)) & (max_depth is None or level < max_depth)
        if not goes_on.any():
            break
        if not goes_on.all():
            order = order[:, np.repeat(goes_on, sizes)]
        nodes, sizes, weight, total = nodes[goes_on], sizes[goes_on], weight[goes_on], total[goes_on]
        starts, at = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(nodes)), sizes)
        place = np.arange(len(at)) - starts[at] + 1
        small = (place < min_leaf) | (sizes[at] - place < min_leaf)
        before = np.cumsum(weight) - weight
        totals, totals_before = total.T.copy(), (np.cumsum(total, axis=0) - total).T.copy()
        most, pick, low, high = np.full(len(nodes), -np.inf), np.zeros(len(nodes), int), np.zeros(len(nodes)), np.zeros(len(nodes))
        width = max(1, BLOCK // len(at))
        for first in range(0, len(x), width):  # some features at a time, so that their arrays stay in the cache
            by_value = order[first:first + width]
            places = np.add(by_value, offsets[first:first + width], out=indices[:by_value.size].reshape(by_value.shape))
            values = np.take(x, places, out=numbers[:by_value.size].reshape(by_value.shape), mode="clip")
            barred = np.ones(by_value.shape, bool)
            np.greater_equal(values[:, :-1], values[:, 1:], out=barred[:, :-1])
            barred |= small
            border = np.flatnonzero(~barred)
            if not len(border):
                continue
            of, place = np.divmod(border, len(at))
            node = at[place]
            sums = []
            for p in pairs:
                taken = np.take(p, by_value, out=complexes[:by_value.size].reshape(by_value.shape), mode="clip")
                both = np.take(np.cumsum(taken, axis=1, out=taken), border)
                sums += [both.real, both.imag]
            upto, *parts = sums[:outputs + 1]
            upto = upto - before[node]
            rest = weight[node] - upto
            np.divide(1, upto, out=upto)
            np.divide(1, rest, out=rest)
            gain = np.zeros(len(border))
            for h in range(outputs):
                part = parts[h] - totals_before[h][node]
                other = totals[h][node] - part
                part *= part
                part *= upto
                other *= other
                other *= rest
                part += other
                gain += part
            group = of * len(nodes) + node
            begins = np.append(0, np.flatnonzero(group[1:] != group[:-1]) + 1)
            group = group[begins]
            highest = np.maximum.reduceat(gain, begins)
            best = np.full((len(by_value), len(nodes)), -np.inf)
            best.flat[group] = highest
            chosen = best.argmax(axis=0)
            reached = best[chosen, np.arange(len(nodes))]
            better = reached > most
            g, k = np.divmod(group, len(nodes))
            kept = np.flatnonzero(better[k] & (chosen[k] == g))
            for_node = k[kept]
            ends = np.append(begins[1:], len(gain))[kept]
            hit = border[first_equal(gain, begins[kept], ends, highest[kept])]
            most[for_node], pick[for_node] = highest[kept], first + chosen[for_node]
            low[for_node], high[for_node] = values.flat[hit], values.flat[hit + 1]
        split = np.isfinite(most)
        cut = low + (high - low) / 2
        cut = np.where(cut >= high, low, cut)
        inner = nodes[split]
        child = used + 2 * (np.cumsum(split) - 1)
        feature[inner], threshold[inner], left[inner] = pick[split], cut[split], child[split]
        used += 2 * len(inner)
        own = order[0]
        right = x[pick[at], own] > cut[at]
        side = np.zeros(n, np.uint8)  # 1: left, 2: right, 0: at rest
        side[own] = np.where(split[at], right + 1, 0)
        n_right = np.add.reduceat(right.astype(int), starts)[split]
        sizes = np.column_stack([sizes[split] - n_right, n_right])
        ends = np.cumsum(sizes, axis=0)
        begins = (ends - sizes + [0, sizes[:, 0].sum()]).ravel()  # lefts of all nodes first, then rights
        sizes = sizes.ravel()
        shuffle = np.repeat(begins - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        parted = np.empty((len(x), len(shuffle)), order.dtype)
        for first in range(0, len(x), width):
            by_value = order[first:first + width]
            sides = np.take(side, by_value)
            halves = [np.take(by_value, np.flatnonzero(sides == s)).reshape(len(by_value), -1) for s in (1, 2)]
            np.take(np.concatenate(halves, axis=1), shuffle, axis=1, out=parted[first:first + width])
        order = parted
        nodes, level = np.repeat(child[split], 2) + np.tile([0, 1], len(inner)), level + 1
    table = {"feature": feature, "threshold": threshold, "left": left, "rows": rows, "depth": depth, "value": value}
    return {k: v[:used] for k, v in table.items()}


def draw(n: int, most: int, seed: int, tree: int) -> np.ndarray:
    """How often a tree takes each of ``n`` rows, ``most`` times in all at most; the same for every job."""
    return np.bincount(np.random.default_rng([seed, tree]).integers(0, n, min(n, most)), minlength=n)


def pool(df: DataFrame, keys: list[str], columns: list[str], most: int | None = None) -> pa.Table:
    """All rows in the order of ``keys``; where a bound is set, at most about so many, drawn by a hash of ``keys``."""
    most = POOL_ROWS or most
    if most is not None:
        hashed = F.shiftrightunsigned(F.xxhash64(*[F.col(c).cast("string") for c in keys]), 11) / F.lit(float(1 << 53))
        df = df.where(hashed * F.lit(float(df.count())) < most)
    return df.select(*keys, *columns).toArrow().sort_by([(k, "ascending") for k in keys])


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    """Lists of equal length as rows."""
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


@dataclass
class Job:
    """What a forest grows from: rows of the pool, and limits."""

    rows: np.ndarray
    min_leaf: int = 1
    min_split: int = 2
    max_depth: int | None = None


def grow(spark: SparkSession, x: np.ndarray, y: np.ndarray, jobs: list[Job], n_trees: int, seed: int = 42, most: int | None = None) -> DataFrame:
    """``NODES`` of ``n_trees`` trees for each job, staged. A task grows some trees, each repeatable.

    A tree draws as many rows as its job has, or at most ``most``. Columns equal to an earlier one are left out, as of equal splits the first feature's is taken.
    """
    columns = np.sort(np.unique(x.T, axis=0, return_index=True)[1])
    shared = spark.sparkContext.broadcast((x[:, columns], y, jobs, TREE_ROWS or most))
    tasks = len(jobs) * n_trees

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x, y, jobs, most = shared.value
        for batch in batches:
            for i in batch.column(0).to_pylist():
                job, tree = i % len(jobs), i // len(jobs)
                own = jobs[job]
                grown = grow_tree(x[own.rows], y[own.rows], draw(len(own.rows), most or len(own.rows), seed, tree), own.min_leaf, own.min_split, own.max_depth)
                grown["feature"] = np.where(grown["feature"] < 0, -1, columns[grown["feature"]])
                n = len(grown["feature"])
                ints = {"job": np.full(n, job), "tree": np.full(n, tree), "node": np.arange(n), **grown}
                lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * y.shape[1], pa.int32()), pa.array(grown["value"].ravel()))
                yield pa.RecordBatch.from_arrays([lists if f.name == "value" else pa.array(ints[f.name], f.type) for f in _NODES], schema=_NODES)

    width = max(1, min(tasks, 4 * spark.sparkContext.defaultParallelism))
    return stage(spark.range(0, tasks, 1, width).mapInArrow(build, NODES), "trees")


def tree_arrays(nodes: DataFrame) -> dict[str, np.ndarray]:
    """A forest as flat arrays; ``left`` counts over all trees, which follow each other."""
    table = nodes.select("tree", "node", "feature", "threshold", "left", "rows", "value").toArrow().sort_by([("tree", "ascending"), ("node", "ascending")])
    tree = table["tree"].to_numpy()
    roots = np.flatnonzero(np.diff(tree, prepend=-1))
    shift = np.repeat(roots, np.diff(np.append(roots, len(tree))))
    return {
        "roots": roots, "feature": table["feature"].to_numpy().astype(np.int32), "threshold": table["threshold"].to_numpy(),
        "left": table["left"].to_numpy() + shift, "rows": table["rows"].to_numpy(), "value": matrix(table["value"]),
    }


def packed(nodes: DataFrame) -> DataFrame:
    """One row per job and tree, staged: its nodes in order, each of their columns as an array."""
    columns = ["feature", "threshold", "left", "rows", "value"]
    trees = nodes.groupBy("job", "tree").agg(F.sort_array(F.collect_list(F.struct("node", *columns))).alias("n"))
    return stage(trees.select("job", "tree", *[F.col(f"n.{c}").alias(c) for c in columns[:-1]], F.flatten("n.value").alias("value")), "forest")


def unpacked(trees: pa.Table) -> dict[str, np.ndarray]:
    """Rows of ``packed``, all of one job, as ``tree_arrays`` gives them."""
    trees = trees.sort_by("tree")
    flat = {c: trees[c].combine_chunks().flatten().to_numpy(zero_copy_only=False) for c in ("feature", "threshold", "left", "rows", "value")}
    sizes = pc.list_value_length(trees["feature"]).to_numpy()
    roots = np.cumsum(sizes) - sizes
    return {**flat, "roots": roots, "left": flat["left"] + np.repeat(roots, sizes), "value": flat["value"].reshape(sizes.sum(), -1)}


def score(rows: DataFrame, n: int, trees: DataFrame, run: Callable[[pa.Table, pa.Table], pa.Table], schema: StructType | str, by: list[str] = ()) -> DataFrame:
    """``run`` over parts of the rows, each with the ``packed`` trees that share its ``by``.

    A part has about ``PART_ROWS`` rows; ``n`` is the number of rows, or of those that share their ``by``.
    """
    parts = max(1, ceil(n / PART_ROWS))
    cut = rows.withColumn("_part", F.pmod(F.xxhash64(*rows.columns), F.lit(parts)))
    copies = trees.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    empty = rows.sparkSession.createDataFrame([], schema).toArrow().schema.empty_table()

    def of_part(rows: pa.Table, trees: pa.Table) -> pa.Table:
        return run(rows.drop_columns("_part"), trees) if rows.num_rows and trees.num_rows else empty

    return cut.groupBy(*by, "_part").cogroup(copies.groupBy(*by, "_part")).applyInArrow(of_part, schema)


def reached(x: np.ndarray, trees: dict[str, np.ndarray], depths: list[int | None] = (None,), splits: list[int] = (2,)) -> dict[tuple[int | None, int], np.ndarray]:
    """The node (tree, row) where each row comes to rest in each tree, for each limit of depth and split.

    One walk serves all limits, and only pairs that still move are looked at.
    """
    splits, flat = sorted(splits), x.ravel()
    shape = len(trees["roots"]), len(x)
    inner = np.where(trees["feature"] >= 0, trees["rows"], 0)
    node, pair = np.repeat(trees["roots"], len(x)), np.arange(shape[0] * shape[1])
    row = np.tile(np.arange(len(x)) * x.shape[1], shape[0])
    at, moving, found = [node.copy() for _ in splits], [np.ones(len(node), bool) for _ in splits], {}
    for level in count():
        if level in depths:
            for s, own, moves in zip(splits, at, moving):
                found[level, s] = own.copy()
                found[level, s][pair[moves]] = node[moves]
        rows = inner[node]
        for i, s in enumerate(splits):
            rests = moving[i] & (rows < s)
            at[i][pair[rests]] = node[rests]
            moving[i] &= ~rests
        on = np.flatnonzero(moving[0])  # the smallest split moves longest
        if not len(on):
            break
        node, pair, row, moving = node[on], pair[on], row[on], [moves[on] for moves in moving]
        node = trees["left"][node] + (flat[row + trees["feature"][node]] > trees["threshold"][node])
    return {(d, s): found.get((d, s), own).reshape(shape) for d in depths for s, own in zip(splits, at)}


def predict(x: np.ndarray, trees: dict[str, np.ndarray], block: int = 256) -> np.ndarray:
    """Mean over the trees of each row's leaf, for every output."""
    out = np.zeros((len(x), trees["value"].shape[1]))
    for i in range(0, len(x), block):
        at = reached(x[i:i + block], trees)[None, 2]
        out[i:i + block] = trees["value"][at.T].mean(axis=1)
    return out


def predict_nested(x: np.ndarray, trees: dict[str, np.ndarray], counts: list[int], depths: list[int | None], splits: list[int], block: int = 256) -> np.ndarray:
    """Predictions of the first output under all limits: (depth, split, number of trees, row)."""
    out = np.zeros((len(depths), len(splits), len(counts), len(x)))
    first = trees["value"][:, 0].copy()
    for i in range(0, len(x), block):
        at = reached(x[i:i + block], trees, depths, splits)
        for d, depth in enumerate(depths):
            for s, split in enumerate(splits):
                upto = np.cumsum(first[at[depth, split]], axis=0)
                out[d, s, :, i:i + block] = [upto[n - 1] / n for n in counts]
    return out

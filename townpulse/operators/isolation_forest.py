"""Isolation forest: trees grow as Spark tasks, scoring runs in Arrow batches.

A tree sees at most ``max_samples`` rows whatever the size of the table, so a task's
input and the model have a bound fixed by the parameters (``n_trees * 2 * max_samples``
nodes). Rows are drawn by a hash of their id, which makes fits repeatable.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import ceil, log, log1p, log2, sqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townpulse.operators.quantiles import exact_quantiles
from townpulse.session import cut_lineage, stage

NODES = "tree INT, node INT, feature INT, threshold DOUBLE, left INT, right INT, length DOUBLE"
EULER_GAMMA = 0.5772156649015329
CHUNK_BYTES = 64 * 2**20
RESIDENT_BYTES = 512 * 2**20
NODE_BYTES = 28


def average_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` points."""
    n = np.asarray(n, dtype=float)
    big = np.maximum(n, 3.0)
    long = 2.0 * (np.log(big - 1.0) + EULER_GAMMA) - 2.0 * (big - 1.0) / big
    return np.where(n > 2, long, np.where(n == 2, 1.0, 0.0))


def grow_tree(x: np.ndarray, usable: np.ndarray, rng: np.random.Generator, max_depth: int) -> pd.DataFrame:
    """Split all nodes of a level at once; returns the node table of one tree."""
    nodes = 2 * len(x)
    feature, left, right = (np.full(nodes, -1) for _ in range(3))
    threshold, length = np.full(nodes, np.nan), np.zeros(nodes)
    used = 1
    node = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x))
    for depth in range(max_depth + 1):
        if len(rows) == 0:
            break
        rows = rows[np.argsort(node[rows], kind="stable")]
        ids, first, size = np.unique(node[rows], return_index=True, return_counts=True)
        low = np.minimum.reduceat(x[rows], first, axis=0)
        high = np.maximum.reduceat(x[rows], first, axis=0)
        wish = np.where((high > low) & usable, rng.random(low.shape), -1.0)
        pick = wish.argmax(axis=1)
        at = np.arange(len(ids))
        split = (wish[at, pick] >= 0) & (depth < max_depth)
        cut = low[at, pick] + rng.random(len(ids)) * (high[at, pick] - low[at, pick])
        cut = np.where(cut >= high[at, pick], low[at, pick], cut)
        length[ids[~split]] = (depth + average_path(size))[~split]
        child = used + 2 * (np.cumsum(split) - 1)
        inner = ids[split]
        feature[inner], threshold[inner] = pick[split], cut[split]
        left[inner], right[inner] = child[split], child[split] + 1
        used += 2 * int(split.sum())
        which = np.repeat(at, size)
        goes_on = split[which]
        rows, which = rows[goes_on], which[goes_on]
        node[rows] = child[which] + (x[rows, pick[which]] > cut[which])
    table = {"feature": feature, "threshold": threshold, "left": left, "right": right, "length": length}
    return pd.DataFrame({"node": np.arange(used), **{k: v[:used] for k, v in table.items()}})


@dataclass
class IsolationForest:
    """A fitted forest. ``nodes`` is a table on shared storage."""

    nodes: DataFrame
    features: list[str]
    n_trees: int
    sample_size: int
    contamination: float
    offset: float | None = None
    shared: list | None = field(default=None, repr=False)

    def params(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("nodes", "shared")}

    def broadcasts(self) -> list:
        """The trees as broadcast chunks, made once per model."""
        if self.shared is None:
            sc = self.nodes.sparkSession.sparkContext
            self.shared = [(sum(a.nbytes for a in c.values()), sc.broadcast(c)) for c in _tree_chunks(self)]
        return self.shared


def draw_samples(df: DataFrame, key: str, features: list[str], n_trees: int, max_samples: int, seed: int) -> tuple[DataFrame, int]:
    """Rows per tree (with their draw), slightly more than needed, and the sample size.

    Every tree draws from the whole table. A row is in a tree with probability ``share``,
    so the number of its trees is binomial: that number is drawn first, and only rows that
    have a tree at all go through the list of trees to pick theirs.
    """
    n = df.count()
    size = min(max_samples, n)
    share = min(1.0, size / max(n, 1) * (1 + 5 / sqrt(max(size, 1))))
    trees = F.sequence(F.lit(0), F.lit(n_trees - 1))
    rows = df.select(key, *features)
    if share < 1.0:
        upto = F.array(*map(F.lit, _binomial(n_trees, share)))
        drawn = _unit(key, F.lit(-1), seed)
        number = F.size(F.filter(upto, lambda u: u <= F.col("_number")))
        # the tree's number stands in the low bits of its hash, so that plain numbers are sorted
        low = F.lit((1 << max(1, (n_trees - 1).bit_length())) - 1).cast("long")
        order = F.sort_array(F.transform(trees, lambda t: F.xxhash64(F.col(key), t, F.lit(seed + 1)).bitwiseAND(F.bitwise_not(low)).bitwiseOR(t.cast("long"))))
        rows = rows.withColumn("_number", drawn).withColumn("_number", number).filter("_number > 0")
        trees = F.transform(F.slice(order, 1, F.col("_number")), lambda x: x.bitwiseAND(low).cast("int"))
    rows = rows.select(key, *features, F.explode(trees).alias("tree"))
    return rows.withColumn("_draw", _unit(key, F.col("tree"), seed)), size


def _binomial(n: int, p: float) -> list[float]:
    """P(at most k) for k = 0, 1, ... as long as it is below one."""
    k = np.arange(n + 1)
    logs = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, n + 1)))))
    chance = np.exp(logs[n] - logs - logs[::-1] + k * log(p) + (n - k) * log1p(-p))
    upto = np.minimum(np.cumsum(chance), 1.0)
    return [float(u) for u in upto[:-1] if u < 1.0 - 1e-13]


def _unit(key: str, salt: Column, seed: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.col(key), salt, F.lit(seed)), 11) / F.lit(float(2**53))


def fit(
    df: DataFrame, key: str, features: list[str], n_trees: int = 300, max_samples: int = 10_000,
    max_features: float = 1.0, contamination: float = 0.05, seed: int = 42,
) -> IsolationForest:
    """Grow the trees and set the offset so that ``contamination`` of ``df`` scores below it."""
    samples, size = draw_samples(df, key, features, n_trees, max_samples, seed)
    depth = ceil(log2(max(size, 2)))
    n_used = max(1, int(max_features * len(features)))

    def build(keys: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        rng = np.random.default_rng([seed, int(keys[0])])
        chosen = pdf.sort_values(["_draw", key]).head(size)
        usable = np.zeros(len(features), dtype=bool)
        usable[rng.permutation(len(features))[:n_used]] = True
        tree = grow_tree(chosen[features].to_numpy(dtype=float), usable, rng, depth)
        return tree.assign(tree=int(keys[0]))[["tree", "node", "feature", "threshold", "left", "right", "length"]]

    nodes = stage(samples.groupBy("tree").applyInPandas(build, NODES), "trees")
    forest = IsolationForest(nodes, features, n_trees, size, contamination)
    [offset] = exact_quantiles(cut_lineage(score(df.select(key, *features), forest, key).select("score")), "score", [contamination])
    forest.offset = offset
    return forest


def _tree_chunks(forest: IsolationForest) -> Iterator[dict[str, np.ndarray]]:
    """The model as flat arrays, one chunk of whole trees at a time from a filtered read."""
    most = 2 * forest.sample_size  # nodes of a tree
    per_chunk = max(1, CHUNK_BYTES // (NODE_BYTES * most))
    for start in range(0, forest.n_trees, per_chunk):
        part = forest.nodes.filter(F.col("tree").between(start, start + per_chunk - 1)).toArrow().to_pandas().sort_values(["tree", "node"])
        sizes = part.groupby("tree").size().to_numpy()
        roots = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        shift = np.repeat(roots, sizes)
        yield walkable({
            "roots": roots, "feature": part.feature.to_numpy(np.int32), "threshold": part.threshold.to_numpy(),
            "left": (part.left.to_numpy() + shift).astype(np.int32), "length": part.length.to_numpy(),
        })


def walkable(trees: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Trees for ``path_lengths``: ``node`` holds the left child within the tree (the right one is the next) and, in its low bits, the feature.

    A leaf is its own left child, and nothing lies above its threshold, so that rows which
    have arrived stay where they are. ``depth`` is that of each tree.
    """
    roots, feature, left = trees["roots"], trees["feature"], trees["left"]
    leaf, sizes = feature < 0, np.diff(np.append(trees["roots"], len(trees["feature"])))
    bits = max(1, int(feature.max(initial=0)).bit_length())
    own = np.where(leaf, np.arange(len(left)), left) - np.repeat(roots, sizes)
    node = own.astype(np.int64) << bits | np.where(leaf, 0, feature)
    depth, tree, at = np.zeros(len(roots), int), np.arange(len(roots)), np.asarray(roots)
    while (inner := ~leaf[at]).any():
        tree, at = np.repeat(tree[inner], 2), (left[at[inner]][:, None] + [0, 1]).ravel()
        depth[tree] += 1
    return {
        "roots": roots, "bits": np.array(bits), "depth": depth, "node": node.astype(np.int32) if node.max(initial=0) < 2**31 else node,
        "threshold": np.where(leaf, np.inf, trees["threshold"]), "length": trees["length"],
    }


def path_lengths(x: np.ndarray, trees: dict[str, np.ndarray], block: int = 16_384) -> np.ndarray:
    """Sum over the trees of each row's path length; a missing value goes to the right.

    A block of rows goes through one tree at a time, a level with each step, so that tree
    and rows stay near the processor.
    """
    trees = trees if "node" in trees else walkable(trees)
    total, bits, kind = np.zeros(len(x)), int(trees["bits"]), trees["node"].dtype
    ends = np.append(trees["roots"][1:], len(trees["node"]))
    for start in range(0, len(x), block):
        part = x[start:start + block]
        n = len(part)
        flat = np.zeros((n, 1 << bits))
        flat[:, :x.shape[1]] = np.where(np.isnan(part), np.inf, part)
        flat, firsts = flat.ravel(), np.arange(n, dtype=kind) << bits
        at, code, place = (np.empty(n, kind) for _ in range(3))
        value, cut, above = np.empty(n), np.empty(n), np.empty(n, bool)
        for first, end, depth in zip(trees["roots"], ends, trees["depth"]):
            node, threshold = trees["node"][first:end], trees["threshold"][first:end]
            at[:] = 0
            for _ in range(depth):
                node.take(at, out=code, mode="clip")
                threshold.take(at, out=cut, mode="clip")
                np.bitwise_and(code, (1 << bits) - 1, out=place)
                np.bitwise_or(place, firsts, out=place)
                flat.take(place, out=value, mode="clip")
                np.greater(value, cut, out=above)
                np.right_shift(code, bits, out=at)
                np.add(at, above, out=at)
            total[start:start + n] += trees["length"][first:end].take(at)
    return total


def _length_udf(shared):
    @F.pandas_udf("double")
    def lengths(*columns: pd.Series) -> pd.Series:
        x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
        return pd.Series(path_lengths(x, shared.value))

    return lengths


def score(df: DataFrame, forest: IsolationForest, key: str) -> DataFrame:
    """Add ``score`` in [-1, 0]; lower is more anomalous.

    Rows are first spread evenly by their id: descending the trees costs far more than
    the shuffle, and earlier joins may have left few or uneven partitions.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    df = df.repartition(parts, key)
    resident = 0
    scored = df.withColumn("_path", F.lit(0.0))
    for size, shared in forest.broadcasts():
        if resident and resident + size > RESIDENT_BYTES:
            scored, resident = cut_lineage(scored), 0
        resident += size
        step = _length_udf(shared)(*[F.col(f).cast("double") for f in forest.features])
        scored = scored.withColumn("_path", F.col("_path") + step)
    scale = forest.n_trees * float(average_path(np.array([forest.sample_size]))[0])
    exponent = -F.col("_path") / F.lit(scale) if scale > 0 else F.lit(-1.0)
    return scored.withColumn("score", -F.pow(F.lit(2.0), exponent)).drop("_path")


def predict(df: DataFrame, forest: IsolationForest, key: str) -> DataFrame:
    """Add ``score`` and ``prediction`` (-1 anomaly, 1 normal)."""
    return score(df, forest, key).withColumn("prediction", F.when(F.col("score") < forest.offset, -1).otherwise(1))


def save(forest: IsolationForest, path: str) -> None:
    spark = forest.nodes.sparkSession
    forest.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    spark.createDataFrame([(json.dumps(forest.params()),)], "params STRING").coalesce(1).write.mode("overwrite").text(f"{path}/params")


def load(spark: SparkSession, path: str) -> IsolationForest:
    params = json.loads(spark.read.text(f"{path}/params").first()[0])
    return IsolationForest(nodes=spark.read.schema(NODES).parquet(f"{path}/nodes"), **params)

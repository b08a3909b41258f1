"""Toxicity by a linear-chain conditional random field.

The corpus has labels per document only. Over all training documents, words and their
first four, five and six letters are counted in toxic and in other documents; those far
more frequent in toxic ones than chance allows make the lexicon. A token's
observation is the level of its strongest entry, 0 without any. In toxic documents tokens
with an entry are labelled toxic, all other tokens are not: these are the labelled tokens
from which the field is fitted, on a bounded sample of ``SAMPLE`` documents of each label.

The field has a weight per level and state and one per transition. Forward and backward
messages give the probability of each tagged token; a run of tokens without entry is one
power of the transition matrix, so a text costs little more than its hits. The largest
probability and the expected number of toxic tokens, by themselves and per hundred tokens,
are turned into a score by a logistic regression on the same sample. ``spans`` are the
offsets of tokens whose probability is a half or more.

Nulls and ties: a null or empty text has no tokens and gets the score of a text without
hits. Labels of unknown documents, null labels and null ids teach nothing; a null doc_id
is scored by its text and counts as not held out. If one of both labels is missing, the
lexicon is empty and all scores are the share of toxic rows (0.5 without any row).
Repeated rows get equal scores; an empty table gives an empty result. Other columns are
ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpulse.llm.common import Memo, map_batches, sample_by_hash
from townpulse.session import stage

SAMPLE = 2_000
PREFIXES = (4, 5, 6)
#: A feature must occur in so many toxic documents, be so many times as frequent in them, and chance
#: may bring at most so many features to that on average, over all features that were tried.
LEAST_COUNT, LEAST_RATIO, BY_CHANCE = 5, 12.0, 5.0
#: Levels of the observation by the logarithm of that ratio.
LEVELS = (np.log(LEAST_RATIO), 4.0, 6.0)
CHUNK = 32
THRESHOLD = 0.3
TOKEN = re.compile(r"\w+")
FLUSH = 100_000


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def features_of(token: str) -> list[str]:
    """A token's entries: the word itself, and its first letters marked by a star."""
    token = token.lower()
    return [token, *(token[:k] + "*" for k in PREFIXES if len(token) > k)]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and other documents each feature occurs; added up in parts of bounded size."""
    memo = Memo(features_of, 100_000)
    held: dict[str, list[int]] = {}

    def out() -> pa.RecordBatch:
        batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), *(pa.array([c[k] for c in held.values()], pa.int64()) for k in (0, 1))], ["feature", "other", "toxic"])
        held.clear()
        return batch

    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            for feature in {f for t in set(TOKEN.findall(text.as_py() or "")) for f in memo[t]}:
                held.setdefault(feature, [0, 0])[toxic] += 1
            if len(held) > FLUSH:
                yield out()
    yield out()


@dataclass
class Field:
    """The fitted model: lexicon (feature -> level), weights, and the score's regression."""

    lexicon: dict[str, int]
    levels: np.ndarray  # (1 + levels) x 2
    moves: np.ndarray  # 2 x 2, from state to state
    score: np.ndarray

    def level(self, token: str) -> int:
        return max((self.lexicon.get(f, 0) for f in features_of(token)), default=0)

    def gaps(self) -> np.ndarray:
        """Normalised powers of the step over tokens without entry; they converge fast."""
        step = np.exp(self.moves) * np.exp(self.levels[0])
        powers = [np.eye(2)]
        for _ in range(64):
            following = powers[-1] @ step
            powers.append(following / following.sum())
        return np.array(powers)

    def marginals(self, n: int, at: np.ndarray, level: np.ndarray, gaps: np.ndarray) -> np.ndarray:
        """Probability of the toxic state at the places ``at`` of ``n`` tokens."""
        if not len(at):
            return np.zeros(0)
        own, moves = np.exp(self.levels[level]), np.exp(self.moves)
        over = np.diff(at) - 1
        start = np.exp(self.levels[0]) @ gaps[min(at[0] - 1, 64)] @ moves if at[0] else np.ones(2)
        forward = np.empty((len(at), 2))
        message = start
        for i in range(len(at)):
            message = message * own[i]
            message = message / message.sum()
            forward[i] = message
            if i < len(over):
                message = message @ gaps[min(over[i], 64)] @ moves
        back = gaps[min(n - 1 - at[-1], 64)] @ np.ones(2)
        out = np.empty(len(at))
        for i in range(len(at) - 1, -1, -1):
            both = forward[i] * back
            out[i] = both[1] / both.sum()
            if i:
                back = gaps[min(over[i - 1], 64)] @ (moves @ (own[i] * back))
                back = back / back.sum()
        return out


def summary(n: int, p: np.ndarray) -> list[float]:
    """What the score is made of: constant, largest probability, expected number, number per hundred tokens."""
    total = float(p.sum())
    return [1.0, float(p.max()) if len(p) else 0.0, float(np.log1p(total)), min(1.0, 100 * total / max(n, 1) / 10)]


def fit_field(chunks: np.ndarray, tags: np.ndarray, weight: np.ndarray, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """Level and transition weights of greatest likelihood, by Adam, with a small ridge.

    ``chunks`` and ``tags`` are rows of ``CHUNK`` levels and states, -1 behind the end.
    """
    k, there = len(LEVELS) + 1, chunks >= 0
    w = np.zeros(2 * k + 4)
    m, v = np.zeros_like(w), np.zeros_like(w)
    safe, state = np.maximum(chunks, 0), np.maximum(tags, 0)
    total = (weight[:, None] * there).sum()
    seen = np.zeros_like(w)
    np.add.at(seen, (2 * safe + state)[there], np.broadcast_to(weight[:, None], chunks.shape)[there])
    pair = there[:, 1:]
    np.add.at(seen, 2 * k + (2 * state[:, :-1] + state[:, 1:])[pair], np.broadcast_to(weight[:, None], pair.shape)[pair])
    for step in range(1, steps + 1):
        own, moves = np.exp(w[:2 * k].reshape(k, 2))[safe], np.exp(w[2 * k:].reshape(2, 2))
        own = np.where(there[:, :, None], own, 1.0)
        forward, back = np.empty(own.shape), np.ones(own.shape)
        forward[:, 0] = own[:, 0] / own[:, 0].sum(1, keepdims=True)
        for t in range(1, CHUNK):
            f = np.where(there[:, t, None], forward[:, t - 1] @ moves, forward[:, t - 1]) * own[:, t]
            forward[:, t] = f / f.sum(1, keepdims=True)
        for t in range(CHUNK - 2, -1, -1):
            b = np.where(there[:, t + 1, None], (own[:, t + 1] * back[:, t + 1]) @ moves.T, 1.0)
            back[:, t] = b / b.sum(1, keepdims=True)
        p = forward * back
        p /= p.sum(2, keepdims=True)
        expected = np.zeros_like(w)
        for s in (0, 1):
            np.add.at(expected, (2 * safe + s)[there], (weight[:, None] * p[:, :, s])[there])
        joint = forward[:, :-1, :, None] * moves * (own[:, 1:] * back[:, 1:])[:, :, None, :]
        joint /= joint.sum((2, 3), keepdims=True)
        expected[2 * k:] = (joint * (weight[:, None] * pair)[:, :, None, None]).sum((0, 1)).ravel()
        gradient = (seen - expected) / total - 1e-5 * w
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        w += 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
    return w[:2 * k].reshape(k, 2), w[2 * k:].reshape(2, 2)


def fit_score(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        c = weight * p * (1 - p)
        w -= np.linalg.solve((x * c[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (weight * (p - y)) + 0.1 * w)
    return w


def _hits(lexicon: dict[str, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Field(lexicon, np.zeros((1, 2)), np.zeros((2, 2)), np.zeros(4))
        memo = Memo(model.level)
        for batch in batches:
            n, places, levels = [], [], []
            for text in batch.column(0):
                own = np.frombuffer(bytes(map(memo.__getitem__, TOKEN.findall(text.as_py() or ""))), np.uint8)
                at = np.flatnonzero(own)
                n.append(len(own))
                places.append(at.astype(np.int32))
                levels.append(own[at].astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(n, pa.int32()), pa.array(places, pa.list_(pa.int32())), pa.array(levels, pa.list_(pa.int32()))], ["toxic", "n", "at", "level"])

    return run


def _lexicon(counts: DataFrame, n: dict[int, int]) -> dict[str, int]:
    """Level of each feature of ``counts`` (feature, other, toxic) that is far more frequent in toxic documents.

    A feature without a bearing on the label falls on a toxic document with their share
    p. That so many of its documents are toxic by chance has a probability of at most
    exp(-documents * divergence of the share seen from p), by Chernoff's bound. The bound
    asked for is divided by the number of features tried, so a larger table needs more
    evidence a feature, by a logarithm; a rare word is not dropped for being rare.
    """
    tried, p, q = max(1, counts.count()), n[1] / (n[0] + n[1]), n[0] / (n[0] + n[1])
    toxic, other = F.col("toxic"), F.col("other")
    every = toxic + other
    evidence = toxic * F.log(toxic / every / F.lit(p)) + F.when(other > 0, other * F.log(other / every / F.lit(q))).otherwise(0.0)
    ratio = F.log((toxic + 0.5) / (n[1] + 1)) - F.log((other + 0.5) / (n[0] + 1))
    found = counts.withColumn("ratio", ratio).where((F.col("ratio") >= float(LEVELS[0])) & (evidence >= float(np.log(tried / BY_CHANCE))))
    return {r.feature: int(np.searchsorted(LEVELS, r.ratio, side="right")) for r in found.select("feature", "ratio").collect()}


def fit(docs: DataFrame, labels: DataFrame) -> Field:
    """The field from all rows of ``docs`` (doc_id, text) that ``labels`` (doc_id, toxic) marks and that are not held out."""
    marked = labels.where("toxic in (0, 1)").where(~held_out(F.col("doc_id"))).select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    rows = stage(docs.select("doc_id", "text").where(~held_out(F.col("doc_id"))).join(marked.hint("merge"), "doc_id"), "marked")
    n = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    none = np.zeros((len(LEVELS) + 1, 2))
    if len(n) < 2:
        share = min(0.999, max(0.001, n.get(1, 0) / sum(n.values()))) if n else 0.5
        return Field({}, none, np.zeros((2, 2)), np.array([np.log(share / (1 - share)), 0, 0, 0]))
    counts = map_batches(rows.select("text", "toxic"), _counts, "feature string, other long, toxic long").groupBy("feature").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    lexicon = _lexicon(stage(counts.where(F.col("toxic") >= LEAST_COUNT), "features"), n)
    sample = [sample_by_hash(rows.where(F.col("toxic") == y), SAMPLE, "doc_id").select("text", "toxic") for y in (0, 1)]
    hits = [r for s in sample for r in map_batches(s, _hits(lexicon), "toxic int, n int, at array<int>, level array<int>").collect()]
    share = {y: n[y] / min(n[y], SAMPLE) for y in (0, 1)}
    patterns: dict[tuple[bytes, int], float] = {}
    for r in hits:
        levels = np.zeros(r.n, np.int8)
        levels[r.at] = r.level
        padded = np.full(-(-max(r.n, 1) // CHUNK) * CHUNK, -1, np.int8)
        padded[:r.n] = levels
        for c in padded.reshape(-1, CHUNK):
            patterns[c.tobytes(), r.toxic] = patterns.get((c.tobytes(), r.toxic), 0.0) + share[r.toxic]
    chunks = np.array([np.frombuffer(c, np.int8) for c, _ in patterns]).astype(int)
    tags = np.where(chunks < 0, -1, (chunks > 0) & (np.array([y for _, y in patterns]) == 1)[:, None]).astype(int)
    levels, moves = fit_field(chunks, tags, np.array(list(patterns.values())))
    model = Field(lexicon, levels, moves, np.zeros(4))
    gaps = model.gaps()
    x = np.array([summary(r.n, model.marginals(r.n, np.array(r.at, int), np.array(r.level, int), gaps)) for r in hits])
    y = np.array([r.toxic for r in hits])
    model.score = fit_score(x, y, np.array([share[t] for t in y]))
    return model


def score(docs: DataFrame, model: Field) -> DataFrame:
    """doc_id, held_out, score, predicted and the offsets of toxic tokens of each row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, gaps = Memo(model.level), model.gaps()
        for batch in batches:
            scores, spans = [], []
            for text in batch.column(1):
                text = text.as_py() or ""
                own = np.frombuffer(bytes(map(memo.__getitem__, TOKEN.findall(text))), np.uint8)
                at = np.flatnonzero(own)
                p = model.marginals(len(own), at, own[at], gaps)
                scores.append(1 / (1 + np.exp(-float(np.dot(summary(len(own), p), model.score)))))
                bad = set(at[p >= 0.5].tolist())
                spans.append([{"start": m.start(), "end": m.end()} for i, m in enumerate(TOKEN.finditer(text)) if i in bad] if bad else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))], ["doc_id", "score", "spans"])

    out = map_batches(docs.select("doc_id", "text"), run, "doc_id long, score double, spans array<struct<start:bigint,end:bigint>>")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "spans")

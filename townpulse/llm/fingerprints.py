"""Document fingerprints from prefix polynomial hashes.

``Prefixes`` holds, for two prime moduli, the running sums of ``code * base^place`` over a
text. The hash of any span is a difference of two sums, moved to place zero, so spans of
any texts compare in constant time and the longest common extension of two places is
found by binary search over its length.

A fingerprint is a string ``length-hash-sketch``: the code points, the hash of the whole
text, and the ``KEEP`` smallest mixed hashes of all its windows of ``WINDOW`` code points
(a text shorter than that is one window). Equal texts have equal fingerprints. The
likeness of two fingerprints is the share of common windows, 2|A and B| / (|A| + |B|),
estimated from the smallest values of their union; equal fingerprints give 1, an empty
text and any other 0.

Nulls and ties: a null text is empty. Rows with a null doc_id come first in the order;
rows of equal doc_id are ordered by text. A table of one row is its own successor; an
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.llm.common import map_batches

WINDOW = 16
KEEP = 128
#: Prime moduli below 2^31, so that products fit 64 bits, and a base for each.
MODULI = (2147483647, 2147483629)
BASES = (1099511627 % MODULI[0], 776531401)
FIRST = -(1 << 63)


class Powers:
    """base^0, base^1, ... modulo a prime, grown by doubling."""

    def __init__(self, base: int, modulus: int) -> None:
        self.base, self.modulus, self.values = base, modulus, np.ones(1, np.int64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            step = pow(self.base, len(self.values), self.modulus)
            self.values = np.concatenate((self.values, self.values * step % self.modulus))
        return self.values[:n]


POWERS = [Powers(b, p) for b, p in zip(BASES, MODULI)]
INVERSES = [Powers(pow(b, -1, p), p) for b, p in zip(BASES, MODULI)]


class Prefixes:
    """Span hashes of one text."""

    def __init__(self, text: str) -> None:
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.int64) + 1
        self.n = len(codes)
        self.sums = [np.concatenate(([0], np.cumsum(codes * w.upto(self.n) % p) % p)) for w, p in zip(POWERS, MODULI)]

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans from ``start`` up to ``end``."""
        a, b = ((s[end] - s[start]) % p * w.upto(self.n + 1)[start] % p for s, w, p in zip(self.sums, INVERSES, MODULI))
        return a << 31 | b

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])

    def windows(self, width: int) -> np.ndarray:
        """Hashes of all windows; of the whole text if it is shorter."""
        if self.n <= width:
            return self.spans(np.array([0]), np.array([self.n])) if self.n else np.zeros(0, np.int64)
        at = np.arange(self.n - width + 1)
        return self.spans(at, at + width)


def common_extension(a: Prefixes, i: int, b: Prefixes, j: int) -> int:
    """How many code points agree from place ``i`` of one text and ``j`` of the other on."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if a.span(i, i + mid) == b.span(j, j + mid):
            low = mid
        else:
            high = mid - 1
    return low


def common_suffix(a: Prefixes, b: Prefixes) -> int:
    low, high = 0, min(a.n, b.n)
    while low < high:
        mid = (low + high + 1) // 2
        if a.span(a.n - mid, a.n) == b.span(b.n - mid, b.n):
            low = mid
        else:
            high = mid - 1
    return low


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 62-bit hashes evenly over 64 bits, as their order decides what is kept."""
    x = x.astype(np.uint64)
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def sketch(text: Prefixes) -> np.ndarray:
    values = mixed(text.windows(WINDOW))
    more = 4 * KEEP
    if len(values) > more:  # repeats mostly leave enough different values among these
        few = np.unique(np.partition(values, more)[:more])
        values = few if len(few) >= KEEP else values
    return np.unique(values >> np.uint64(32))[:KEEP].astype(">u4")


def fingerprint(text: Prefixes) -> tuple[str, np.ndarray]:
    least = sketch(text)
    return f"{text.n:x}-{text.span(0, text.n):016x}-{least.tobytes().hex()}", least


def likeness(a: tuple[str, np.ndarray], b: tuple[str, np.ndarray]) -> float:
    if a[0] == b[0]:
        return 1.0
    if not len(a[1]) or not len(b[1]):
        return 0.0
    least = np.union1d(a[1], b[1])[:KEEP]
    jaccard = np.isin(least, np.intersect1d(a[1], b[1])).mean()
    return float(2 * jaccard / (1 + jaccard))


def parsed(text: str) -> tuple[str, np.ndarray]:
    """A fingerprint string and its sketch, to compare stored fingerprints."""
    return text, np.frombuffer(bytes.fromhex(text.rsplit("-", 1)[1]), ">u4")


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprint of each text and of its edited text, and their likenesses.

    The edited text has its last quarter replaced by the beginning of the next document in
    ascending doc_id. ``common_prefix`` and ``common_suffix`` are the common extensions of
    both texts at either end.

    Documents are dealt to ranges of doc_id; the first document of a range is also sent to
    the range before it, and the very first one to the last, so every document meets its
    successor without one task seeing them all. Only a bound per range reaches the driver.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(FIRST)).alias("key"))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = docs.agg(F.percentile_approx("key", [i / ranges for i in range(1, ranges)] or [0.5], 10_000)).first()[0]
    bounds = np.array(sorted(set(found or [])), np.int64)

    def range_of(keys: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, keys, side="right")

    in_range = F.pandas_udf(lambda k: pd.Series(range_of(k.to_numpy())), "int")
    firsts = {r[0]: r[1] for r in docs.select(in_range("key").alias("r"), "key").groupBy("r").agg(F.min("key")).collect()}
    order = sorted(firsts)
    guest_of = {firsts[r]: order[i - 1] for i, r in enumerate(order)}  # the first of a range visits the one before

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        own = range_of(keys.to_numpy())
        return pd.Series([[2 * r] if k not in guest_of else [2 * r, 2 * guest_of[k] + 1] for k, r in zip(keys.tolist(), own.tolist())])

    dealt = docs.withColumn("place", F.explode(places("key"))).withColumn("range", F.expr("place div 2"))
    dealt = dealt.repartitionByRange(ranges, "range").sortWithinPartitions("place", "key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix", "common_suffix"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int64()]
        held, rows = None, []
        for batch in batches:
            for doc_id, text, place in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                text = text or ""
                hashes = Prefixes(text)
                this = (doc_id, text, hashes, fingerprint(hashes), place // 2)
                if held is not None and held[4] == this[4]:
                    rows.append(compare(held, this))
                held = None if place % 2 else this
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
                rows = []

    def compare(this: tuple, following: tuple) -> tuple:
        doc_id, text, hashes, own, _ = this
        cut = len(text) // 4
        edited = text[:len(text) - cut] + following[1][:cut]
        other = Prefixes(edited)
        new = fingerprint(other)
        return (
            doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), own[0], new[0], likeness(own, new), likeness(own, following[3]),
            common_extension(hashes, 0, other, 0), common_suffix(hashes, other),
        )

    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long, common_suffix long"
    return map_batches(dealt.select("doc_id", "text", "key", "place"), run, schema)

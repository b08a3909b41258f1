"""Near-duplicates by HyperMinHash.

A text's set of word shingles is hashed; each hash goes to one of ``BUCKETS`` buckets by
its first bits, and a bucket keeps its smallest hash in compressed form: the number of
leading zeros and the ``MANTISSA`` bits behind the first one, 16 bits together. A bucket
that stays empty, as many do for short texts, takes the smallest of all shingles under a
hash of its own, so that registers agree with the probability of the Jaccard similarity
at any length. ``ROWS`` neighbouring registers form a band, and texts that agree on a whole
band are candidates: at a similarity of 0.8 a pair is missed with probability below 1e-7.

The share of equal registers, less the collisions expected between different hashes, is
an estimate of the similarity. Candidates far below the threshold by it are dropped, the
others are compared on their full sets.

Texts of equal sets are one class, of which one text goes on. Links only matter for what
they connect, so candidates are checked in rounds: first each text against the smallest
id it shares a band with, then, in bands that still hold several components, against
leaders that change from round to round. Texts in bands that then still hold several
components are compared by their rarest shingles: for a pair to be similar enough, one of
the few rarest of the smaller set (counted among these texts) has to be among the rarest
of the larger, and what is left of both behind it has to suffice. That loses no link, and
texts that are merely alike share no rare shingle, so a group of them just below the
threshold is not paired with itself. No group is gathered in one task, and equal or
already connected texts are never paired.

Nulls and ties: without words the set is empty and links nothing. Rows with a null doc_id
keep their shingle count, are never linked, and count as kept. Rows sharing a doc_id are
one document with the union of their links. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from townpulse.llm.common import map_batches
from townpulse.llm.components import components
from townpulse.session import fresh_path, scratch, stage

BUCKETS, MANTISSA, ROWS = 128, 10, 4
BANDS = BUCKETS // ROWS
#: Leaders change so often, but no longer than they link this share of the open band entries.
LEADER_ROUNDS, LEADERS_GAIN = 3, 0.001
#: Standard errors below the threshold at which an estimate rules a pair out.
MARGIN = 5.0
SEEDS = np.array([xxhash.xxh3_64_intdigest(str(i)) | 1 for i in range(BUCKETS)], np.uint64)


def shingles(text: str, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the different shingles; one of all words if they are fewer.

    On bytes, lower-casing concerns A-Z alone and white space is just what parts words here.
    """
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashed, width = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)), min(width, len(words))
    h = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):  # a polynomial of the words' hashes, spread out at the end
        h = h * np.uint64(0x9E3779B97F4A7C15) + hashed[i:i + len(h)]
    return np.unique(mixed(h + np.uint64(width)))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def compressed(least: np.ndarray, bits: int) -> np.ndarray:
    """Leading zeros and mantissa of ``bits``-bit numbers, as 16-bit registers."""
    fraction, exponent = np.frexp(least.astype(np.float64))  # least = fraction * 2^exponent, fraction in [0.5, 1)
    zeros = np.clip(bits - exponent, 0, 63)
    mantissa = ((2 * fraction - 1).clip(0) * (1 << MANTISSA)).astype(np.int64)
    return (zeros << MANTISSA | mantissa).astype("<u2")


def registers(hashes: np.ndarray) -> np.ndarray:
    """The compressed registers of a set that is not empty."""
    bits = 64 - BUCKETS.bit_length() + 1
    least = np.full(BUCKETS, np.iinfo(np.uint64).max, np.uint64)
    bucket = hashes >> np.uint64(bits)
    # ascending hashes: the first of each bucket is its smallest
    first = np.concatenate(([0], np.flatnonzero(np.diff(bucket)) + 1)) if len(hashes) else np.zeros(0, int)
    least[bucket[first]] = hashes[first] & np.uint64((1 << bits) - 1)
    filled = np.zeros(BUCKETS, bool)
    filled[bucket[first]] = True
    empty = np.flatnonzero(~filled)
    few = max(1, (1 << 18) // len(hashes))  # at a time, to bound memory
    for at in range(0, len(empty), few):
        own = empty[at:at + few]
        least[own] = mixed(hashes * SEEDS[own, None] + SEEDS[(own + 1) % BUCKETS, None]).min(axis=1) >> np.uint64(64 - bits)
    return compressed(least, bits)


def estimate(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Similarity from registers (a row each) and set sizes, corrected for chance collisions.

    Smallest hashes of n and m elements share their leading zeros often if n and m are
    alike, and then their mantissa with probability 2^-MANTISSA: at most 1/3 of that.
    """
    equal = (a == b).mean(axis=1)
    chance = 2.0 ** -MANTISSA / 3 * np.minimum(sizes_a, sizes_b) / np.maximum(np.maximum(sizes_a, sizes_b), 1)
    return np.clip((equal - chance) / (1 - chance), 0, 1)


def _sketches(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, a, b, regs = [], [], [], []
            for text in batch.column(1):
                s = shingles(text.as_py() or "", width)
                n.append(len(s))
                digest = xxhash.xxh3_128_intdigest(s.tobytes())
                a.append((digest >> 64) - (1 << 63))
                b.append((digest & (1 << 64) - 1) - (1 << 63))
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(regs, pa.binary())], ["doc_id", "n_shingles", "a", "b", "registers"])

    return run


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        regs = b"".join(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(batch.column(0).to_numpy(), BANDS)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), batch.num_rows)), pa.array(np.frombuffer(regs, "<i8")),
        ], ["id", "band", "value"])


def _likely(percent: int):
    """Pairs whose estimate does not rule them out."""
    least = percent / 100 - MARGIN * np.sqrt(percent / 100 * (1 - percent / 100) / BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, BUCKETS) for i in (2, 3))
            n, m = (batch.column(i).to_numpy() for i in (4, 5))
            good = (estimate(a, b, n, m) >= least) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good)) for i in (0, 1)], ["u", "v"])

    return run


def _linked(width: int, percent: int):
    """Pairs whose full sets are similar enough."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets: dict[str, np.ndarray] = {}
            good = []
            for s, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = (sets[z] if z in sets else sets.setdefault(z, shingles(z, width)) for z in (s, t))
                both = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(good, pa.bool_())) for i in (0, 1)], ["u", "v"])

    return run


def _sets(width: int):
    """Every text's shingles, with the size of its set and a key, as an id may have several."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, width) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(s) for s in sets], np.int64)
            keys = np.array([xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets], np.uint64).view(np.int64)
            tokens = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
            columns = [np.repeat(c, sizes) for c in (batch.column(0).to_numpy(), keys, sizes)]
            yield pa.RecordBatch.from_arrays([*(pa.array(c) for c in columns), pa.array(tokens.view(np.int64))], ["id", "key", "n", "token"])

    return run


def rare_pairs(texts: DataFrame, of: DataFrame, width: int, percent: int) -> DataFrame:
    """(u, v): pairs of ``texts`` (doc_id, text) in different components (id, of) that may be similar enough.

    The sets are ordered by how many of these texts hold a shingle. If two sets overlap
    enough, the first shingle they share stands so early in the smaller set, and in the
    larger, that enough of both follows; each is counted from the rarest on, those of one
    text alone included.
    """
    own = texts.where("text is not null").join(of.select(F.col("id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    tokens = stage(map_batches(own.select("doc_id", "text"), _sets(width), "id long, key long, n long, token long").distinct(), "shingles")
    held = tokens.groupBy("token").agg(F.count("*").alias("held")).where("held > 1")
    each = Window.partitionBy("id", "key")
    place = F.col("n") - F.count("*").over(each) + F.row_number().over(each.orderBy("held", "token"))
    needed = lambda total: F.floor((percent * total + percent + 99) / F.lit(100 + percent))  # noqa: E731  shingles in common, of two sizes' total
    rare = tokens.join(held, "token").withColumn("place", place).where(F.col("place") <= F.col("n") - F.floor((percent * F.col("n") + 99) / F.lit(100)) + 1)
    rare = stage(rare.join(of.select("id", "of").distinct(), "id").select("id", "n", "token", "place", "of"), "rare")
    small = rare.where(F.col("place") <= F.col("n") - needed(2 * F.col("n")) + 1).alias("s")
    s, p = (lambda c, x=x: F.col(f"{x}.{c}") for x in "sp")
    enough = 1 + F.least(s("n") - s("place"), p("n") - p("place")) >= needed(s("n") + p("n"))
    ordered = (s("n") < p("n")) | ((s("n") == p("n")) & (s("id") < p("id")))
    found = small.join(rare.alias("p"), (s("token") == p("token")) & ordered & (100 * s("n") >= percent * p("n")) & (s("of") != p("of")) & enough)
    return found.select(F.least(s("id"), p("id")).alias("u"), F.greatest(s("id"), p("id")).alias("v")).where("u <> v").distinct()


def _find(docs: DataFrame, sketches: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, component) of the documents that are linked with any."""
    usable = sketches.where("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy("a", "b").agg(F.min("doc_id").alias("class"))  # equal sets
    members = stage(usable.select("doc_id", "a", "b").join(classes, ["a", "b"]).select("doc_id", "class").distinct(), "members")
    # one row per class goes on; a doc_id on several rows may stand for several classes
    heads = usable.join(classes.withColumnRenamed("class", "doc_id"), ["doc_id", "a", "b"]).dropDuplicates(["doc_id", "a", "b"])
    heads = heads.select(F.col("doc_id").alias("id"), "n_shingles", "registers")
    heads = stage(heads, "heads")
    places = map_batches(heads.select("id", "registers"), _bands, "id long, band int, value long")
    shared = places.groupBy("band", "value").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high")
    crowd = stage(places.join(shared.select("band", "value", "low"), ["band", "value"]), "crowd")
    involved = stage(crowd.select("id").distinct(), "involved")
    regs = stage(heads.join(involved, "id", "left_semi"), "registers")
    texts = stage(docs.join(involved, F.col("doc_id") == F.col("id"), "left_semi").where("text is not null"), "texts")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Links among different candidate pairs (u, v)."""
        one, two = (regs.select(F.col("id").alias(x), F.col("registers").alias(f"r{x}"), F.col("n_shingles").alias(f"n{x}")) for x in "uv")
        rows = pairs.join(one, "u").join(two, "v").select("u", "v", "ru", "rv", "nu", "nv")
        likely = stage(map_batches(rows, _likely(percent), "u long, v long").distinct(), "likely")
        one, two = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}")) for x in "uv")
        return stage(map_batches(likely.join(one, "u").join(two, "v").select("u", "v", "tu", "tv"), _linked(width, percent), "u long, v long").distinct(), "linked")

    nearest = crowd.groupBy("id").agg(F.min("low").alias("v")).where("v < id").select(F.col("id").alias("u"), "v")
    links = confirmed(nearest)
    found = stage(components(links.union(members.where("doc_id <> class").toDF("u", "v"))), "components")
    leaders_help = True
    for round_no in range(LEADER_ROUNDS + 1):
        last_round = round_no == LEADER_ROUNDS or not leaders_help
        # bands that still hold more than one component
        named = crowd.select("id", "band", "value").join(found, "id", "left").select("id", "band", "value", F.coalesce("component", "id").alias("of"))
        open_ = named.groupBy("band", "value").agg(F.min("of").alias("x"), F.max("of").alias("y"), F.min(F.xxhash64("id", F.lit(round_no))).alias("draw")).where("x < y")
        left = stage(named.join(open_.select("band", "value", "draw"), ["band", "value"]), "open")
        if left.isEmpty():
            break
        if not last_round:
            leads = left.where(F.xxhash64("id", F.lit(round_no)) == F.col("draw")).select("band", "value", F.col("id").alias("v"), F.col("of").alias("of_v")).dropDuplicates(["band", "value"])
            pairs = left.join(leads, ["band", "value"]).where("of <> of_v").select(F.col("id").alias("u"), "v")
        else:
            pairs = rare_pairs(texts, left, width, percent)
        new = confirmed(pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct())
        gained = new.count()
        leaders_help = gained > LEADERS_GAIN * left.count()
        if gained:
            known = found.where("id <> component").select(F.col("id").alias("u"), F.col("component").alias("v"))
            found = stage(components(new.union(known)), "components")
        if last_round:
            break
    return found


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document (doc_id, text).

    Documents are linked if 100 * |A and B| >= ``percent`` * |A or B| on their sets of
    ``width``-word shingles; a component is named by its smallest doc_id, which is kept.
    """
    docs = docs.select("doc_id", "text")
    sketches = stage(map_batches(docs, _sketches(width), "doc_id long, n_shingles long, a long, b long, registers binary"), "sketches")
    named_path = fresh_path(docs.sparkSession, "named")
    with scratch(docs.sparkSession):
        _find(docs, sketches, width, percent).write.parquet(named_path)
    found = docs.sparkSession.read.schema("id long, component long").parquet(named_path)
    named = found.select(F.col("id").alias("doc_id"), F.col("component").alias("component_id")).where("doc_id <> component_id")
    out = sketches.select("doc_id", "n_shingles").join(named, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document is the first of its component, all columns unchanged."""
    gone = near_duplicates(docs, width, percent).where("not kept").select(F.col("doc_id").alias("gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("gone"), "left_anti")

"""Best-fit packing of documents into sequences of several permitted lengths.

A document of more tokens than the longest sequence is cut into pieces of that length and
a rest. Pieces are placed in descending size, each into the bin with the least room that
still holds it. If none does, a bin of that permitted length is opened which costs least
per token it can be expected to hold: the piece itself and as much of the tokens still to
come as fit besides. A bin costs its length, a fixed amount, and a share that grows with
the square of the length, as attention does. When all pieces are placed, each bin shrinks
to the smallest permitted length that holds its contents.

Pieces are dealt to shards of about ``SHARD`` pieces by a hash of doc_id, number of tokens,
start, and a number among rows that agree in these, and shards are packed independently,
so no task sees more than a bounded part; of so many pieces hardly a bin per shard stays
open. The bins depend on the rows alone, not on how the table is partitioned.

Nulls and ties: a null or empty text is one token long, its end id. Pieces of equal size
are placed in order of doc_id, start, tokens and number; null ids come first. Repeated rows are packed
as often as they occur. An empty table gives no bins. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.llm.common import map_batches
from townpulse.llm.token_files import _encoder, width_of
from townpulse.session import stage

LENGTHS = (512, 1024, 2048, 4096)
SHARD = 10_000
REPEATS = 1_000  # equal rows are numbered in blocks of so many
#: Cost of a bin in tokens, and the length at which attention costs as much as the rest.
BIN_COST, ATTENTION = 64, 32_768


def bin_cost(length: int) -> float:
    return length + BIN_COST + length * length / ATTENTION


def pack(sizes: Sequence[int], lengths: Sequence[int] = LENGTHS) -> tuple[list[int], list[int], list[int]]:
    """Bin and offset of each piece, given in descending size, and the length of each bin."""
    lengths = sorted(lengths)
    left, mask = sum(sizes), 0  # tokens still to come; a bit for each amount of room that some bin has
    with_room: dict[int, list[int]] = {}
    bins, offsets, opened, used = [], [], [], []
    for size in sizes:
        left -= size
        above = mask >> size
        if above:
            room = size + (above & -above).bit_length() - 1
            b = with_room[room].pop()
            if not with_room[room]:
                mask ^= 1 << room
        else:
            room = min((x for x in lengths if x >= size), key=lambda x: (bin_cost(x) / (size + min(x - size, left)), x))
            b = len(opened)
            opened.append(room)
            used.append(0)
        bins.append(b)
        offsets.append(used[b])
        used[b] += size
        if room > size:
            with_room.setdefault(room - size, []).append(b)
            mask |= 1 << room - size
    return bins, offsets, [next(x for x in lengths if x >= u) for u in used]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and n_tokens, the ids of its text and an end id, of each row of ``docs``."""
    dtype = np.dtype(f"<u{width_of(vocabulary)}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary, dtype)
        for batch in batches:
            counts = [len(encoder.encode(t.as_py() or "")) // dtype.itemsize + 1 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long")


def _numbered(rows: DataFrame) -> DataFrame:
    """``rows`` with a number ``row`` among equal ones, from their counts: no group is gathered.

    A count is dealt out in blocks over the tasks before its rows are made again.
    """
    counts = rows.groupBy(*rows.columns).agg(F.count("*").alias("_n"))
    blocks = counts.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1, F.lit(REPEATS).cast("long"))).alias("_from"))
    blocks = blocks.repartition(F.xxhash64(*rows.columns, "_from"))
    last = F.least(F.col("_from") + REPEATS, F.col("_n")) - 1
    return blocks.select(*rows.columns, F.explode(F.sequence("_from", last)).alias("row"))


def place(counts: DataFrame, lengths: Sequence[int] = LENGTHS, shard: int = SHARD) -> DataFrame:
    """Where each piece of ``counts`` (doc_id, n_tokens) goes.

    One row per piece: doc_id, start and n_tokens within the document, bin_id, place (its
    offset within the bin) and length of the bin. Rows without tokens have no piece.
    """
    longest = max(lengths)
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1, F.lit(longest).cast("long")))
    rows = _numbered(counts.where("n_tokens > 0").select("doc_id", F.col("n_tokens").alias("all")))
    pieces = rows.select("doc_id", "row", "all", starts.alias("start")).select("doc_id", "row", "all", "start", F.least(F.lit(longest), F.col("all") - F.col("start")).cast("long").alias("n_tokens"))
    pieces = stage(pieces, "pieces")
    shards = max(1, math.ceil(pieces.count() / shard))
    pieces = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "all", "start", "row"), F.lit(shards)))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["n_tokens", "doc_id", "start", "all", "row"], ascending=[False, True, True, True, True], na_position="first", kind="stable")
        bins, offsets, sizes = pack(group["n_tokens"].tolist(), lengths)
        number = int(group["shard"].iloc[0]) << 32
        out = group[["doc_id", "start", "n_tokens"]].copy()
        out["bin_id"], out["place"], out["length"] = np.array(bins, np.int64) + number, np.array(offsets, np.int64), np.array(sizes, np.int64)[bins]
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return pieces.groupBy("shard").applyInPandas(run, "doc_id long, start long, n_tokens long, bin_id long, place long, length long")


def bins(placed: DataFrame) -> DataFrame:
    """One row per bin with its pieces in order; a bin holds at most ``length`` of them."""
    piece = F.struct("place", "doc_id", "start", "n_tokens")
    return placed.groupBy("bin_id", "length").agg(F.sum("n_tokens").alias("n_tokens"), F.sort_array(F.collect_list(piece)).alias("pieces"))


def sequences(placed: DataFrame, tokens: DataFrame) -> DataFrame:
    """The ids of each bin from ``tokens`` (doc_id, ids), one row for each doc_id."""
    own = placed.join(tokens.select("doc_id", "ids"), "doc_id").select("bin_id", "length", "place", F.expr("slice(ids, int(start) + 1, int(n_tokens))").alias("ids"))
    return own.groupBy("bin_id", "length").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("place", "ids"))), lambda p: p.ids)).alias("ids"))

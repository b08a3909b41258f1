"""Removal of passages that occurred before, by hashing normalised units.

Lines are split into sentences. A unit is the shortest run of whole sentences from a
sentence on, and the shortest one up to a sentence, that has ``LEAST_WORDS`` words or more
(mostly a single sentence, once). Where a capitalised word follows a lower-case one inside
a sentence, a unit also begins there, as a passage put into the middle of a sentence
begins with a capital. Units are compared by 128-bit digests of their words in lower case,
so passages match wherever in a line they stand.

Of all occurrences of a unit the one in the document of smallest doc_id stays, within a
document the first; the others are cut out. ``removed`` holds the cut spans as offsets
into the original text, from which every kept character's place follows.

Nulls and ties: a null text stays null, an empty one empty. A row with a null doc_id has
no rank: it is compared with itself only. Rows sharing a doc_id share a rank, so none of
them loses a unit to another. An empty table gives an empty result. Other columns stay as
they are; a column named ``removed`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from townpulse.llm.common import map_batches
from townpulse.session import stage

LEAST_WORDS = 12
ENDS = re.compile(r"\s*\n\s*|[.!?]+[\"')\]]*\s+")
#: A space before a letter that is not a plain lower-case one.
INNER = re.compile(r" (?=[^\W\d_a-z])")


def units(text: str) -> list[tuple[bytes, int, int]]:
    """(digest, start, end) of the units of a text, by start."""
    ends = list(ENDS.finditer(text))
    cuts = [0, *(m.end() for m in ends), len(text)]
    breaks = {m.end() for m in ends if "\n" in m[0]}
    spans, norms, sizes = [], [], []
    lines = [0]  # the first span of each line
    for a, b in zip(cuts, cuts[1:]):
        if a in breaks and len(spans) > lines[-1]:
            lines.append(len(spans))
        words = text[a:b].lower().split()
        if words:
            spans.append((a, b))
            norms.append(" ".join(words))
            sizes.append(len(words))
    n, found = len(spans), []
    for i, (a, b) in enumerate(spans):
        if sizes[i] >= LEAST_WORDS:
            found.append((norms[i], a, b))
        else:
            size, j = sizes[i], i + 1
            while size < LEAST_WORDS and j < n:
                size, j = size + sizes[j], j + 1
            if size >= LEAST_WORDS:
                found.append((" ".join(norms[i:j]), a, spans[j - 1][1]))
            size, k = sizes[i], i
            while size < LEAST_WORDS and k:
                k -= 1
                size += sizes[k]
            if size >= LEAST_WORDS:
                found.append((" ".join(norms[k:i + 1]), spans[k][0], b))
        for m in INNER.finditer(text, a, b):
            c = m.end()
            if text[c].isupper() and text[c + 1:c + 2].islower() | (text[c + 1:c + 2] == " ") and text[c - 2:c - 1] not in ".!?":
                words, j = text[c:b].lower().split(), i + 1
                while len(words) < LEAST_WORDS and j < n:
                    words += norms[j].split(" ")
                    j += 1
                if len(words) >= LEAST_WORDS:
                    found.append((" ".join(words), c, spans[j - 1][1]))
    for i, j in zip(lines, [*lines[1:], n]):
        if sum(sizes[i:j]) < LEAST_WORDS:
            line = " ".join(norms[i:j])
            if any(map(str.isalnum, line)):
                found.append((line, spans[i][0], spans[j - 1][1]))
    digest = xxhash.xxh3_128_digest
    return sorted({(digest(x.encode()), a, b) for x, a, b in found}, key=lambda u: u[1:])


def cut(text: str, seen_before: set[bytes]) -> list[tuple[int, int]]:
    """Spans to remove: units seen in earlier documents, and later repeats within the text."""
    first_end: dict[bytes, int] = {}
    spans: list[list[int]] = []
    for digest, a, b in units(text):
        if digest not in seen_before:
            end = first_end.setdefault(digest, b)
            if a < end:
                continue
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        else:
            spans.append([a, b])
    return [(a, b) for a, b in spans]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    edges = [0, *(x for span in spans for x in span), len(text)]
    return "".join(text[a:b] for a, b in zip(edges[::2], edges[1::2]))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, keys = [], []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            own = {u[0] for u in units(text.as_py())}
            keys += own
            ids.append(np.full(len(own), doc_id, np.int64))
        both = np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(np.concatenate(ids) if ids else np.zeros(0, np.int64))], ["a", "b", "doc_id"])


def seen_before(docs: DataFrame) -> DataFrame:
    """doc_id and the digests of its units that a document of smaller doc_id has, for documents with any."""
    known = docs.where("doc_id is not null and text is not null").select("doc_id", "text")
    rows = stage(map_batches(known, _digests, "a long, b long, doc_id long"), "units")
    # added up within each map task first, so a unit of many documents is one row per task
    first = rows.groupBy("a", "b").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    return rows.join(first, ["a", "b"]).where("doc_id > first").groupBy("doc_id").agg(F.collect_list(F.struct("a", "b")).alias("seen"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) without repeated passages, and ``removed``."""
    columns = [c for c in docs.columns if c != "removed"]
    others = [c for c in columns if c != "text"]
    rows = docs.select("doc_id", "text", F.struct(*others).alias("row"))
    rows = rows.join(seen_before(docs).withColumnRenamed("doc_id", "seen_id"), F.col("doc_id") == F.col("seen_id"), "left").select("row", "text", "seen")
    span = StructType([StructField("start", LongType()), StructField("end", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, removed = [], []
            seen = batch.column(2)
            pairs = seen.flatten()
            keys = np.column_stack([pairs.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)]).astype("<i8") if len(pairs) else np.zeros((0, 2), "<i8")
            at = 0
            for text, own in zip(batch.column(1), seen):
                n = len(own.values) if own.is_valid else 0
                raw, at = keys[at:at + n].tobytes(), at + n
                text = text.as_py()
                spans = cut(text, {raw[i:i + 16] for i in range(0, len(raw), 16)}) if text else []
                texts.append(without(text, spans) if spans else text)
                removed.append([{"start": a, "end": b} for a, b in spans])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(removed, kind)], ["row", "new", "removed"])

    schema = StructType([rows.schema["row"], StructField("new", StringType()), StructField("removed", ArrayType(span))])
    out = map_batches(rows, run, schema)
    return out.select(*(F.col("new").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in columns), "removed")

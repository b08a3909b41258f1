"""Language identification by Bloom filters of n-grams, bit-sliced over the languages.

A filter holds the n-grams of one language. All filters share their size and hash
functions, so they are stored slice by slice: one slot keeps a bit for every language, and
the bits of an n-gram's slots, combined by ``and``, are the languages that contain it. The
languages of all n-grams of a text are added up per language. A filter also says yes to a
known share of n-grams it does not hold, so of ``n`` n-grams with ``hits`` for a language
``(hits - n * rate) / (1 - rate)`` are taken to be its own. The most decides.

N-grams are 2 to 4 characters of lower-case words of letters and marks, a word's ends
counted as a character. A language contains an n-gram if it stands in a least share of the
language's documents, and not far more often in those of another language.

Filters are learned from at most about ``SAMPLE`` documents of each language, drawn by a
hash; which languages there are and how many documents each has is counted over all rows.
The filters take ``SLOTS`` times one bit for each language, rounded up to bytes, whatever
the input. They and a row for each language are all that is broadcast.

A text that is null or has no letter is ``und`` with score 0; so is every text if nothing
could be learned. Equal shares go to the language with more documents, then to the first
in the order of names; a text without any known n-gram goes there too, with score 0.
Repeated rows are judged alike and count once each as documents, but once in the sample.
A null doc_id is not held out. Long texts are
read in pieces of bounded size. An empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpulse.llm.common import map_batches

SAMPLE = 2_000
SLOTS = 1 << 20
HASHES = 4
SIZES = (2, 3, 4)
#: A language holds an n-gram that stands in this share of its documents ...
LEAST_SHARE = 0.01
#: ... and in at least this part of the share it has in any other language.
LEAST_PART = 0.5
#: Characters that are looked at together.
CHUNK = 1 << 20
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")


@cache
def _in_words() -> np.ndarray:
    """Whether a code point is a letter or a mark."""
    return np.fromiter((unicodedata.category(chr(i))[0] in "LM" for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def grams(codes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of all n-grams of ``codes``, and the row of each, size by size.

    ``codes`` are code points with runs of others than letters as a single 0.
    """
    for n in SIZES:
        if len(codes) < n:
            continue
        last = len(codes) - n + 1
        whole = np.ones(last, bool)  # no word ends inside
        h = np.full(last, n, np.uint64)
        for i in range(n):
            part = codes[i:i + last]
            h = (h + part) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
            if 0 < i < n - 1:
                whole &= part != 0
        yield h[whole], rows[n - 1:][whole]


def _codes(text: str) -> np.ndarray:
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
    points[~_in_words()[points]] = 0
    return points


def chunks(texts: Iterable[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Code points of many texts for ``grams``, at most about ``CHUNK`` together.

    A piece of a long text ends behind what separates two words, if there is such a place.
    """
    held, rows, size = [], [], 0

    def closed() -> tuple[np.ndarray, np.ndarray]:
        codes = np.concatenate([np.zeros(1, np.uint64), *held])
        row = np.repeat(rows, [len(h) for h in held])
        row = np.concatenate((row[:1], row))
        kept = codes != 0
        kept[0] = True
        kept[1:] |= codes[:-1] != 0
        return codes[kept], row[kept]

    for row, text in enumerate(texts):
        text, at = text or "", 0
        while at < len(text):
            end = min(at + CHUNK, len(text))
            if end < len(text):
                end = max((m.end() for m in re.finditer(r"\s", text[at:end])), default=CHUNK) + at
            held.append(np.append(_codes(text[at:end]), np.uint64(0)))
            rows.append(row)
            at, size = end, size + len(held[-1])
            if size >= CHUNK:
                yield closed()
                held, rows, size = [], [], 0
    if held:
        yield closed()


def slots(hashes: np.ndarray) -> Iterator[np.ndarray]:
    """The slot of each n-gram under each hash function."""
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    for i in range(HASHES):
        yield ((low + np.uint64(i) * high) & np.uint64(SLOTS - 1)).astype(np.int64)


@dataclass
class Filters:
    """``bits``: a row per slot with a bit per language, in the order of ``languages``."""

    languages: list[str]
    bits: np.ndarray

    def rates(self) -> np.ndarray:
        """Share of n-grams outside a language that its filter says yes to."""
        filled = np.zeros(len(self.languages))
        for i in range(len(filled)):
            filled[i] = np.count_nonzero(self.bits[:, i // 8] & (128 >> i % 8)) / len(self.bits)
        return filled ** HASHES

    def masks(self, hashes: np.ndarray) -> np.ndarray:
        """The languages that contain each n-gram, packed."""
        mask = None
        for slot in slots(hashes):
            mask = self.bits[slot] if mask is None else mask & self.bits[slot]
        return mask

    def count(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Per text its number of n-grams, and per language the number found in the filter."""
        n, hits = np.zeros(len(texts)), np.zeros((len(texts), len(self.languages)))
        for codes, rows in chunks(texts):
            for hashes, row in grams(codes, rows):
                mask = self.masks(hashes)
                n += np.bincount(row, minlength=len(texts))
                for i in range(len(self.languages)):
                    yes = mask[:, i // 8] & (128 >> i % 8)
                    hits[:, i] += np.bincount(row[yes != 0], minlength=len(texts))
        return n, hits

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score, the winner's share of all that was found."""
        named, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.languages:
            return named, scores
        n, hits = self.count(texts)
        rate = self.rates()
        own = np.maximum(hits - n[:, None] * rate, 0) / np.maximum(1 - rate, 1e-9)
        total, top = own.sum(axis=1), own.argmax(axis=1)
        for i, text in enumerate(texts):
            if text and LETTER.search(text):
                named[i] = self.languages[top[i]]
                scores[i] = own[i, top[i]] / total[i] if total[i] > 0 else 0.0
        return named, scores


def held_out(doc_id: Column) -> Column:
    """The third of the documents that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def _sample(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(text, place): about ``SAMPLE`` documents of each language, those of least hash."""
    drawn = rows.withColumn("h", F.xxhash64("doc_id", "text"))
    share = F.shiftrightunsigned("h", 11) / F.lit(float(1 << 53))
    picked = drawn.join(F.broadcast(counts), "lang").where(share * F.col("n") < SAMPLE)
    return picked.dropDuplicates(["lang", "h"]).select("text", "place")


def fit(docs: DataFrame, held: Column | None = None) -> Filters:
    """Filters of the languages in ``lang`` of ``docs`` (doc_id, text, lang), without rows that are ``held``."""
    rows = docs.select("doc_id", "text", "lang", (F.lit(False) if held is None else held).alias("held"))
    rows = rows.where(~F.col("held") & F.col("text").isNotNull() & F.col("lang").isNotNull())
    spark = docs.sparkSession
    known = sorted(((r.lang, r.n) for r in rows.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()), key=lambda r: (-r[1], r[0]))
    languages = [lang for lang, _ in known]
    bits = np.zeros((SLOTS, (len(languages) + 7) // 8), np.uint8)
    if not languages:
        return Filters(languages, bits)
    counts = spark.createDataFrame([(i, *r) for i, r in enumerate(known)], "place int, lang string, n long")

    def seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, places = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            parts = [pd.DataFrame({"row": of, "gram": h}).drop_duplicates() for piece in chunks(texts) for h, of in grams(*piece)]
            found = pd.concat(parts or [pd.DataFrame({"row": [], "gram": []}, dtype="int64")]).drop_duplicates()
            pairs = found.assign(place=places[found.row]).groupby(["place", "gram"]).size().reset_index(name="n")
            yield pa.RecordBatch.from_arrays([pa.array(pairs.place.to_numpy(np.int32)), pa.array(pairs.gram.to_numpy().astype(np.int64)), pa.array(pairs.n.to_numpy(np.int64))], ["place", "gram", "n"])

    sample = _sample(rows, counts)
    stood = map_batches(sample, seen, "place int, gram long, n long").groupBy("place", "gram").agg(F.sum("n").alias("docs"))
    drawn = F.least(F.col("n"), F.lit(SAMPLE))
    shares = stood.join(F.broadcast(counts.select("place", "n")), "place").select("place", "gram", (F.col("docs") / drawn).alias("share"))
    most = shares.groupBy("gram").agg(F.max("share").alias("most"))
    kept = shares.where(F.col("share") >= LEAST_SHARE).join(most, "gram").where(F.col("share") >= LEAST_PART * F.col("most"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slot in slots(batch.column(1).to_numpy().view(np.uint64)):
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(slot)], ["place", "slot"])

    full = map_batches(kept.select("place", "gram"), placed, "place int, slot long").distinct().toArrow()
    place, slot = full["place"].to_numpy(), full["slot"].to_numpy()
    np.bitwise_or.at(bits, (slot, place // 8), (128 >> place % 8).astype(np.uint8))
    return Filters(languages, bits)


def predict(docs: DataFrame, filters: Filters) -> DataFrame:
    """doc_id, lang_pred and score of every text."""
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            named, scores = shared.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(named, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, lang_pred string, score double")

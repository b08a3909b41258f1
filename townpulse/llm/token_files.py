"""Token ids in flat binary files with 64-bit document offsets.

Layout of a folder: ``<part>.ids`` holds the ids of its documents one after another as
little-endian unsigned integers (16 bits if the vocabulary allows, else 32);
``<part>.idx`` holds one little-endian record per document, its ``doc_id`` and the place
behind its last id within the part. ``manifest`` is a Parquet table with a row per part.
Parts follow each other in ascending doc_id order; where a part begins in the whole
corpus is the prefix sum of the sizes before it, so no part waits for another. A reader
maps the files into memory and needs no other index.

A part is named by the task attempt that wrote it and counts only once the manifest names
it, so attempts that were lost leave nothing but unreferenced files.

Nulls and ties: a null text is empty and still has its end id; rows with a null doc_id
come first; rows with equal doc_id are ordered by text. An empty table gives no parts.
Other columns are ignored.
"""

from __future__ import annotations

import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from townpulse.llm.common import Memo, map_batches

RECORD = np.dtype([("doc_id", "<i8"), ("end", "<i8")])
MANIFEST = "part string, width int, n_docs long, n_null long, n_ids long, first_id long"

#: Below this code point letters have long been letters in every Unicode version.
LATIN_END = "ɐ"
#: Its lower case has a mark of its own, which normalisation moves among the marks that follow.
DOTTED = "\u0130"
TRAILING = ".,;:!?*&%$#)"


class WordEncoder:
    """Encodes like ``Tokenizer.encode`` of a vocabulary that drops white space.

    No token of such a vocabulary spans white space, so a text is encoded word by word
    and the ids of a word are remembered. Lower-casing comes first only where it commutes
    with the tokenizer's own normalisation.
    """

    def __init__(self, path: str, dtype: np.dtype) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.dtype = self.tokenizer.model, dtype
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        self.letters = {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}
        self.memo = Memo(self.word)

    def word(self, word: str) -> bytes:
        if word.isalpha() and word == word.lower() and max(word) < LATIN_END:
            mapped = word if word.isascii() else "".join([self.letters[b] for b in word.encode()])
            ids = [t.id for t in self.model.tokenize(mapped)]
        else:
            core = word.rstrip(TRAILING)
            if core and core != word and core[-1].isalnum() and core[-1] < LATIN_END and core[-1] != DOTTED:
                return self.memo[core] + self.memo[word[len(core):]]
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
        return np.array(ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        if "Σ" not in text and DOTTED not in text and (text.isascii() or unicodedata.is_normalized("NFC", text)):
            text = text.lower()
        words = text.replace("\n", " ").replace("\t", " ").split(" ")
        return b"".join(map(self.memo.__getitem__, filter(None, words)))


def _encoder(path: str, dtype: np.dtype, kept: dict = {}) -> WordEncoder:  # noqa: B006  one for each worker
    if path not in kept:
        kept.clear()
        kept[path] = WordEncoder(path, dtype)
    return kept[path]


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def width_of(path: str) -> int:
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size() <= 1 << 16 else 4


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int) -> DataFrame:
    """Encode ``text`` of ``docs`` (doc_id, text) into ``folder``; the manifest is returned.

    ``folder`` must be reachable from all executors. The vocabulary has to drop white
    space, as ``word_bpe_49k.json`` does.
    """
    width = width_of(vocabulary)
    dtype = np.dtype(f"<u{width}")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = _encoder(vocabulary, dtype), np.array([end_id], dtype).tobytes()
        files, where = _place(folder)
        part, first, n_docs, n_null, n_ids, ids, index = f"part-{uuid.uuid4().hex}", None, 0, 0, 0, None, None
        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if ids is None:
                    files.create_dir(where, recursive=True)
                    ids, index = (files.open_output_stream(f"{where}/{part}.{x}") for x in ("ids", "idx"))
                    first = batch.column(0)[0].as_py()
                records = np.zeros(batch.num_rows, RECORD)
                records["doc_id"] = batch.column(0).fill_null(0).to_numpy()
                for i, text in enumerate(batch.column(1)):
                    got = encoder.encode(text.as_py() or "") + end
                    n_ids += len(got) // width
                    records["end"][i] = n_ids
                    ids.write(got)
                n_docs, n_null = n_docs + batch.num_rows, n_null + batch.column(0).null_count
                index.write(records.tobytes())
        finally:
            for stream in (ids, index):
                if stream is not None:
                    stream.close()
        if n_docs:
            yield pa.RecordBatch.from_pylist([{"part": part, "width": width, "n_docs": n_docs, "n_null": n_null, "n_ids": n_ids, "first_id": first}], schema=pa.schema([("part", pa.string()), ("width", pa.int32()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_ids", pa.int64()), ("first_id", pa.int64())]))

    rows = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    map_batches(rows, write, MANIFEST).write.parquet(f"{folder}/manifest")
    return manifest(docs.sparkSession, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """A row per part with ``base``, the number of ids in the parts before it."""
    before = Window.orderBy(F.col("first_id").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest").withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def map_file(files: fs.FileSystem, where: str, dtype: np.dtype) -> np.ndarray:
    """The file as an array: mapped if it is local, else read."""
    if isinstance(files, fs.LocalFileSystem):
        return np.memmap(where, dtype, "r") if files.get_file_info(where).size else np.zeros(0, dtype)
    with files.open_input_file(where) as f:
        return np.frombuffer(f.read(), dtype)


def read_token_files(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """One row per document from the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, its ids.

    ``start`` counts the ids of all documents before it; the checksum is taken over the
    document's ids as 32-bit integers.
    """
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, where = _place(folder)
        for batch in batches:
            for row in batch.to_pylist():
                index = map_file(files, f"{where}/{row['part']}.idx", RECORD)
                ids = map_file(files, f"{where}/{row['part']}.ids", np.dtype(f"<u{row['width']}"))
                starts = np.concatenate(([0], index["end"][:-1]))
                for at in range(0, len(index), 1000):
                    spans = list(zip(starts[at:at + 1000], index["end"][at:at + 1000]))
                    own = [np.asarray(ids[a:b]).astype("<u4") for a, b in spans]
                    known = np.arange(at, at + len(spans)) < row["n_null"]
                    columns = [
                        pa.array(index["doc_id"][at:at + 1000].astype("i8"), mask=known),
                        pa.array([row["base"] + int(a) for a, _ in spans], pa.int64()),
                        pa.array([len(x) for x in own], pa.int64()),
                        pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()),
                    ]
                    names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                    if with_ids:
                        columns.append(pa.array([x.astype("i4") for x in own], pa.list_(pa.int32())))
                        names.append("ids")
                    yield pa.RecordBatch.from_arrays(columns, names)

    parts = manifest(spark, folder).select("part", "width", "n_null", "base")
    return map_batches(parts.repartition(spark.sparkContext.defaultParallelism * 4, "part"), read, schema)

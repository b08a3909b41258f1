"""Alignment of the tokens that two tokenizers make of the same texts.

Both tokenizers cover the bytes of a space and the text. Where a token of each ends at the
same byte, a cut closes a group; tokens whose byte ranges overlap are linked. ``lockstep``
finds both by merging: one state vector holds a pointer into the A tokens and one into the
B tokens for every document of a batch, each step emits one link of every document and the
cuts among them, moves the pointer whose token ends first (both at a cut), and drops the
documents that are finished. A long document takes part as several lanes, cut at spaces
where both tokenizers always end a token, so the number of steps has a bound unless a text
has no such space.

``score`` weighs links by how many documents of the corpus hold their pair of ids. Tasks
gather documents into blocks of bounded size and count every pair once a block, so what is
shuffled are the distinct pairs of a block and not the links; counts come back to a block
the same way. No pair table is broadcast, and a pair that stands in every document is one
row a block.

Texts that are null or empty, and texts whose bytes a tokenizer does not give back, have no
tokens: zeros and an empty digest. Rows are independent but for the counts, where every row
is a document of its own, repeated doc_ids too; a null doc_id is passed through. All ties
for the highest count are best. An empty table gives an empty result; other columns are
ignored. Memory is a small multiple of a block, or of one text if that is longer.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from townpulse.llm import bpe
from townpulse.llm.common import map_batches
from townpulse.session import fresh_path

#: Texts beyond this length are cut into lanes.
LANE = 4096
#: A block is closed once it has so many links.
BLOCK = 2_000_000
#: Both kinds of vocabulary begin a token at a space that follows something else and precedes no white space.
BORDER = re.compile(r"(?<=[^ ]) (?=\S)")
#: The fast encoder's pattern search gives up on far longer runs of white space.
LONG_SPACE = re.compile(r"\s{5000}")
SPACE = "▁"


class ByteLevel:
    """A byte-level BPE vocabulary; strings of its special tokens are plain text."""

    def __init__(self, path: str) -> None:
        import tiktoken

        self.merges = bpe.MergeList(path)
        self.bytes_of = self.merges.bytes_of
        special = set(self.merges.special.values())
        ranks = {b: i for i, b in enumerate(self.bytes_of) if b and i not in special}
        if self.merges.made != sorted(self.merges.made):
            raise ValueError("ids have to ascend with the ranks of their merges")
        self.fast = tiktoken.Encoding(path, pat_str=bpe.PRETOKEN.pattern, mergeable_ranks=ranks, special_tokens={})
        self.plain = bpe.Encoder(self.merges)
        self.plain.special = None

    def encode(self, text: str) -> list[int]:
        if len(text) > LANE and LONG_SPACE.search(text):
            return np.frombuffer(b"".join(self.plain.encode(" " + text)), self.plain.dtype).tolist()
        return self.fast.encode_ordinary(" " + text)


class Pieces:
    """A sentencepiece vocabulary with byte fallback; it puts a space before the text."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in pieces):
            raise ValueError("a piece reaches over a space, so texts cannot be cut there")
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


def _decimals(n: int, mark: str) -> np.ndarray:
    return np.array([f"{i}{mark}" for i in range(n)], f"S{len(str(n)) + 1}")


class Aligner:
    """The two vocabularies of a worker and what is looked up by id."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = ByteLevel(a_path), Pieces(b_path)
        self.a_length, self.b_length = (np.array([len(x) for x in t.bytes_of]) for t in (self.a, self.b))
        self.inner_a, self.last_a = (_decimals(len(self.a.bytes_of), m) for m in ",|")
        self.inner_b, self.last_b = (_decimals(len(self.b.bytes_of), m) for m in ",;")

    def encode(self, text: str | None) -> list[tuple[list[int], list[int]]] | None:
        """Ids of both per lane; None if the bytes are not those of a space and the text."""
        lanes = []
        for part in lanes_of(text or ""):
            a, b, want = self.a.encode(part), self.b.encode(part), b" " + part.encode()
            if b"".join([self.a.bytes_of[i] for i in a]) != want or b"".join([self.b.bytes_of[i] for i in b]) != want:
                return None
            lanes.append((a, b))
        return lanes


def lanes_of(text: str) -> Iterator[str]:
    """Parts of a text without the spaces between them; none if it is empty."""
    at = 0
    while len(text) - at > LANE and (m := BORDER.search(text, at + LANE)):
        yield text[at:m.start()]
        at = m.end()
    if text:
        yield text[at:]


def lockstep(a_ends: np.ndarray, b_ends: np.ndarray, a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions of linked tokens in A and B, and whether a cut follows, in order of the text.

    ``a_ends`` and ``b_ends`` are the ends of all tokens over the bytes of all lanes, one
    lane after another; ``a_sizes`` and ``b_sizes`` say how many tokens each lane has. A lane
    has at most as many links as tokens, which gives each lane its place in the result.
    """
    room = a_sizes + b_sizes
    links_a, links_b = np.full(room.sum(), -1), np.full(room.sum(), -1)
    cuts = np.zeros(room.sum(), bool)
    a, b, at, stop = np.cumsum(a_sizes) - a_sizes, np.cumsum(b_sizes) - b_sizes, np.cumsum(room) - room, np.cumsum(a_sizes)
    live = a < stop
    while live.any():
        if not live.all():
            a, b, at, stop = a[live], b[live], at[live], stop[live]
        a_end, b_end = a_ends[a], b_ends[b]
        links_a[at], links_b[at], cuts[at] = a, b, a_end == b_end
        a, b, at = a + (a_end <= b_end), b + (b_end <= a_end), at + 1
        live = a < stop
    used = links_a >= 0
    return links_a[used], links_b[used], cuts[used]


@dataclass
class Aligned:
    """Tokens, links and cuts of a batch. ``doc_of_x`` gives the row of each token or link."""

    a: np.ndarray
    b: np.ndarray
    a_ends: np.ndarray
    links_a: np.ndarray
    links_b: np.ndarray
    cuts: np.ndarray
    doc_of_a: np.ndarray
    doc_of_b: np.ndarray
    doc_of_link: np.ndarray
    rows: int

    def per_row(self, rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, minlength=self.rows)


def align(aligner: Aligner, texts: list[str | None]) -> Aligned:
    a_ids, b_ids, a_sizes, b_sizes, doc_of = [], [], [], [], []
    for row, text in enumerate(texts):
        for a, b in aligner.encode(text) or ():
            a_ids.extend(a)
            b_ids.extend(b)
            a_sizes.append(len(a))
            b_sizes.append(len(b))
            doc_of.append(row)
    a, b, sa, sb, doc_of = (np.array(x, np.int64) for x in (a_ids, b_ids, a_sizes, b_sizes, doc_of))
    a_ends, b_ends = np.cumsum(aligner.a_length[a]), np.cumsum(aligner.b_length[b])
    links_a, links_b, cuts = lockstep(a_ends, b_ends, sa, sb)
    doc_of_a, doc_of_b = np.repeat(doc_of, sa), np.repeat(doc_of, sb)
    return Aligned(a, b, a_ends, links_a, links_b, cuts, doc_of_a, doc_of_b, doc_of_a[links_a], len(texts))


def group_digests(aligner: Aligner, got: Aligned) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` per row; empty for rows without tokens."""
    ends_a, ends_b = np.zeros(len(got.a), bool), np.zeros(len(got.b), bool)
    ends_a[got.links_a[got.cuts]] = ends_b[got.links_b[got.cuts]] = True
    group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
    a_upto, b_upto = np.cumsum(np.bincount(group_a)), np.cumsum(np.bincount(group_b))
    out = np.empty(len(got.a) + len(got.b), max(aligner.last_a.dtype, aligner.last_b.dtype))
    if len(got.a):
        out[np.arange(len(got.a)) + np.concatenate(([0], b_upto))[group_a]] = np.where(ends_a, aligner.last_a[got.a], aligner.inner_a[got.a])
        out[np.arange(len(got.b)) + a_upto[group_b]] = np.where(ends_b, aligner.last_b[got.b], aligner.inner_b[got.b])
    ends = np.cumsum(got.per_row(got.doc_of_a) + got.per_row(got.doc_of_b)).tolist()
    texts = (out[start:end].tobytes().replace(b"\0", b"")[:-1] for start, end in zip([0, *ends], ends))
    return [hashlib.sha256(t).hexdigest() if t else "" for t in texts]


_KEPT: dict[tuple[str, str], Aligner] = {}


def aligner_of(a_path: str, b_path: str) -> Aligner:
    """The worker's vocabularies."""
    if (a_path, b_path) not in _KEPT:
        _KEPT.clear()
        _KEPT[a_path, b_path] = Aligner(a_path, b_path)
    return _KEPT[a_path, b_path]


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32()), pa.array(values, pa.int32()))


def alignments(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document its tokens, cuts and links.

    doc_id, a_ids, b_ids; ``cuts``: byte offsets in a space and the text where groups end;
    ``links_a`` and ``links_b``: positions in a_ids and b_ids of each linked pair, in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(a_path, b_path)
        for batch in batches:
            got = align(aligner, batch.column(1).to_pylist())
            n_a, n_b, n_links = (got.per_row(d) for d in (got.doc_of_a, got.doc_of_b, got.doc_of_link))
            first_a, first_b = (np.cumsum(n) - n for n in (n_a, n_b))
            begins = np.concatenate(([0], got.a_ends))[np.minimum(first_a, len(got.a))]
            at_cut = got.doc_of_link[got.cuts]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), _lists(got.a, n_a), _lists(got.b, n_b),
                _lists(got.a_ends[got.links_a[got.cuts]] - begins[at_cut], got.per_row(at_cut)),
                _lists(got.links_a - first_a[got.doc_of_link], n_links), _lists(got.links_b - first_b[got.doc_of_link], n_links),
            ], ["doc_id", "a_ids", "b_ids", "cuts", "links_a", "links_b"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, a_ids array<int>, b_ids array<int>, cuts array<int>, links_a array<int>, links_b array<int>")


#: A row is a document (``pairs``: steps between the places of its pairs in the list of its
#: block, ``times``: links of each) or, with ``of_block``, a block (``codes``: its list of
#: pairs, ascending; ``times``: documents that hold each).
BLOCKS = """of_block boolean, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string,
    pairs array<int>, codes array<long>, times array<int>"""


def _closed(block: int, held: list[tuple], width: int) -> Iterator[pa.RecordBatch]:
    """The rows of a block, its documents before itself."""
    schema = pa.schema([("of_block", pa.bool_()), ("block", pa.int64()), ("doc_id", pa.int64())] + [(c, pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")] + [
        ("groups_sha256", pa.string()), ("pairs", pa.list_(pa.int32())), ("codes", pa.list_(pa.int64())), ("times", pa.list_(pa.int32()))])
    codes, place, docs = np.unique(np.concatenate([h[1] % width for h in held]), return_inverse=True, return_counts=True)
    at = 0
    for columns, keys, times in held:
        own, at = place[at:at + len(keys)].astype(np.int32), at + len(keys)
        rows = columns[0]
        sizes = np.bincount(keys // width, minlength=len(rows))
        steps = np.diff(own, prepend=np.int32(0))
        firsts = (np.cumsum(sizes) - sizes)[sizes > 0]
        steps[firsts] = own[firsts]
        none = pa.nulls(len(rows), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array([False] * len(rows)), pa.array([block] * len(rows), pa.int64()), *columns, _lists(steps, sizes), none, _lists(times, sizes)], schema=schema)
    yield pa.RecordBatch.from_pylist([{"of_block": True, "block": block, "codes": codes, "times": docs.astype(np.int32)}], schema=schema)


def blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Documents and their blocks, see ``BLOCKS``, staged: a block is as its one task wrote it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = aligner_of(a_path, b_path)
        n_a, n_b = len(aligner.a.bytes_of), len(aligner.b.bytes_of)
        block, held, links = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            got = align(aligner, batch.column(1).to_pylist())
            code = got.a[got.links_a] * n_b + got.b[got.links_b]
            keys, times = np.unique(got.doc_of_link * (n_a * n_b) + code, return_counts=True)
            per_row = [got.per_row(x) for x in (got.doc_of_a, got.doc_of_b, got.doc_of_link[got.cuts], got.doc_of_link)]
            held.append(([batch.column(0), *(pa.array(x, pa.int64()) for x in per_row), pa.array(group_digests(aligner, got), pa.string())], keys, times))
            links += len(code)
            if links >= BLOCK:
                yield from _closed(block, held, n_a * n_b)
                block, held, links = block + 1, [], 0
        if held:
            yield from _closed(block, held, n_a * n_b)

    path = fresh_path(docs.sparkSession, "alignment")
    map_batches(docs.select("doc_id", "text"), run, BLOCKS).write.partitionBy("of_block").parquet(path)
    return docs.sparkSession.read.schema(BLOCKS).parquet(path)


SCORED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _weigh(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """Add up the counts of the links of each document of a block."""
    places = pairs["place"].to_numpy()
    count, best = np.zeros(places.max(initial=-1) + 1, np.int64), np.zeros(places.max(initial=-1) + 1, np.int64)
    count[places], best[places] = pairs["n"].to_numpy(), pairs["is_best"].to_numpy(zero_copy_only=False)
    steps, times = (docs[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("pairs", "times"))
    sizes = docs["pairs"].combine_chunks().value_lengths().to_numpy()
    ends = np.cumsum(sizes)
    place = np.cumsum(steps)
    place -= np.repeat(np.concatenate(([0], place))[ends - sizes], sizes)
    upto = [np.concatenate(([0], np.cumsum(of[place] * times))) for of in (best, count)]
    n_best, count_sum = (u[ends] - u[ends - sizes] for u in upto)
    kept = [docs[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
    return pa.Table.from_arrays([*kept, pa.array(n_best), pa.array(count_sum), docs["groups_sha256"]], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])


def pair_counts(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(block, place, code, n) of every block's pairs, and (code, n) with the documents of the corpus that hold it."""
    own = staged.where("of_block").select("block", F.posexplode(F.arrays_zip("codes", "times")).alias("place", "p"))
    own = own.select("block", "place", F.col("p.codes").alias("code"), F.col("p.times").alias("n"))
    return own, own.groupBy("code").agg(F.sum("n").alias("n"))


def score(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``SCORED`` per document; see the module's text for how counts reach the documents.

    n_best counts the links whose pair is in as many documents as any pair of the same A id;
    count_sum adds up the documents of each link's pair.
    """
    staged = blocks(docs, a_path, b_path)
    n_b = Pieces(b_path).model.get_piece_size()
    own, counts = pair_counts(staged)
    a_id = F.floor(F.col("code") / n_b)
    highest = counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("top"))  # a row per id of A
    marked = counts.withColumn("a", a_id).join(highest, "a").select("code", "n", (F.col("n") == F.col("top")).alias("is_best"))
    pairs = own.select(F.col("block").alias("in_block"), "place", "code").join(marked, "code").select("in_block", "place", "n", "is_best")
    rows = staged.where("NOT of_block").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times")
    return rows.groupBy("block").cogroup(pairs.groupBy("in_block")).applyInArrow(_weigh, SCORED)

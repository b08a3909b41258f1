"""Byte-level BPE as a streaming transducer, and its decoder.

``MergeList`` reads a vocabulary and computes its sufficient lookahead: how many bytes
behind the end of a token can still change whether it ends there. The end can only vanish
if a merge closes over it. The left part of that merge is one that the token ends with
before a later merge takes it in; the right part must be made of the bytes that follow, and
can only be prevented by a merge of lower rank over its own end, and so on to the right.
The reach of a merge is the length of its right part and the furthest reach of those that
can prevent it. A token's lookahead is the furthest reach of the merges that can take its
end and whose right part begins with the ``KNOWN`` bytes behind it: often 2 bytes or none,
never more than ``MergeList.lookahead``. This needs a list in which the parts of a merge
are made by earlier merges; other lists are refused.

``Encoder`` takes text in pieces of any size and gives back ids as they become final. It
holds one open piece and, inside a run without word borders, no more bytes than twice the
lookahead and a token. ``Decoder`` is the reverse: ids to bytes to text, with the unfinished
end of a character as its only state.

A null text is empty and has no ids. Rows are independent, so repeated rows and ties mean
nothing; a null doc_id is passed through and an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import codecs
import hashlib
import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from townpulse.llm.common import Memo, map_batches

#: Unicode's White_Space, spelt out as the modules at hand disagree about control characters.
SPACE = r"\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: How this kind of vocabulary splits text before merging (fixed: part of the vocabulary's definition).
PRETOKEN = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: A new piece begins at a space before anything but white space; no pretoken reaches over it.
BORDER = re.compile(rf" (?=[^{SPACE}])")
LOOSE_SPACE = re.compile(rf" (?:[{SPACE}]|\Z)")
#: The runs one pretoken can be made of, to go on with a pretoken that is longer than a piece.
RUNS = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", rf"[^{SPACE}\p{{L}}\p{{N}}]+", rf"[{SPACE}]+")]

NEVER = 1 << 30
SHORT = 64
PIECE = 1 << 16
#: Bytes behind a token that its lookahead depends on, and bytes between two looks at what is final.
KNOWN = 2
STEP = 16


def byte_letters() -> dict[int, str]:
    """The printable stand-ins of the 256 bytes in vocabularies of this kind."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class MergeList:
    """Ids, merges and lookahead of a vocabulary file."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        back = {c: b for b, c in letters.items()}
        self.byte_ids = [vocab[letters[b]] for b in range(256)]
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(back[c] for c in token if c in back)
        self.special = {}
        for t in spec["added_tokens"]:
            if t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]:
                raise ValueError(f"added token {t['content']!r} has flags that are not supported")
            self.special[t["content"]] = t["id"]
            self.bytes_of[t["id"]] = t["content"].encode()
        #: pair of ids -> rank, and rank -> id of the merged token
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for merge in spec["model"]["merges"]:
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            self.rank[vocab[a], vocab[b]] = len(self.made)
            self.made.append(vocab[a + b])
        self._reaches()

    def _reaches(self) -> None:
        #: token -> rank of the merge that makes it and its right part
        self.right_of: dict[int, tuple[int, int]] = {}
        #: left part and first bytes of the right part -> ranks, and furthest reach up to each rank
        self.reaches: dict[tuple[int, bytes], tuple[list[int], list[int]]] = {}
        every: dict[tuple[int, bytes], tuple[list[int], list[int]]] = {}  # the same whatever follows
        parts = set()
        for (a, b), r in self.rank.items():
            data = self.bytes_of[b]
            reach = len(data) + self._furthest(every, b, r, [b""])
            for table, key in ((every, (a, b"")), (self.reaches, (a, data[:KNOWN]))):
                ranks, furthest = table.setdefault(key, ([], []))
                ranks.append(r)
                furthest.append(max(reach, furthest[-1] if furthest else 0))
            parts.update((a, b))
            if self.made[r] in parts or self.made[r] in self.right_of:
                raise ValueError(f"merge {r} makes a token that an earlier merge makes or takes")
            self.right_of[self.made[r]] = r, b
        self.lookahead = max((furthest[-1] for _, furthest in every.values()), default=0)
        #: (token, the ``KNOWN`` bytes behind it) -> its lookahead
        self.settles = Memo(lambda key: self._furthest(self.reaches, key[0], NEVER, [key[1][:n] for n in range(1, KNOWN + 1)])).__getitem__

    def _furthest(self, table: dict, token: int, before: int, firsts: list[bytes]) -> int:
        """Furthest reach of merges below rank ``before`` that can take the end of ``token``."""
        best = 0
        while True:
            for first in firsts:
                if found := table.get((token, first)):
                    n = bisect.bisect_left(found[0], before)
                    best = max(best, found[1][n - 1] if n else 0)
            if token not in self.right_of:
                return best
            before, token = self.right_of[token]

    def merge(self, ids: list[int]) -> list[int]:
        """Merges of a short pretoken."""
        rank, made = self.rank, self.made
        ranks = [rank.get(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            ids[i:i + 2] = [made[low]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank.get((ids[i - 1], ids[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank.get((ids[i], ids[i + 1]), NEVER)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap, for windows of many bytes."""
        rank, made, n = self.rank, self.made, len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = made[r], -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q < n and (s := rank.get((ids[p], ids[q]))) is not None:
                    heapq.heappush(heap, (s, p, ids[p], ids[q]))
        return [x for x in ids if x >= 0]


class Run:
    """The ids of one pretoken that comes in parts, each given as soon as it is final.

    What is held is looked at every ``step`` bytes, less often while nothing becomes final.
    """

    def __init__(self, merges: MergeList, step: int = STEP) -> None:
        self.merges, self.step, self.held, self.due = merges, step, b"", step

    def _merged(self) -> list[int]:
        ids = list(map(self.merges.byte_ids.__getitem__, self.held))
        return self.merges.merge(ids) if len(ids) <= SHORT else self.merges.merge_long(ids)

    def _final(self) -> list[int]:
        out, end, held, merges = [], 0, self.held, self.merges
        for token in self._merged():
            after = end + len(merges.bytes_of[token])
            if after + KNOWN > len(held) or after + merges.settles((token, held[after:after + KNOWN])) > len(held):
                break
            out.append(token)
            end = after
        self.held = held[end:]
        self.due = len(self.held) + max(self.step, len(self.held) if self.step > 1 else 0)
        return out

    def feed(self, data: bytes) -> list[int]:
        if not self.held and len(data) < self.due:
            self.held = data
            return []
        out, at = [], 0
        while len(self.held) + len(data) - at >= self.due:
            taken = self.due - len(self.held)
            self.held += data[at:at + taken]
            at += taken
            out += self._final()
        self.held += data[at:]
        return out

    def finish(self) -> list[int]:
        out = self._merged()
        self.held, self.due = b"", self.step
        return out


class Encoder:
    """``feed`` text in pieces, then ``finish``; both give ids as packed unsigned integers."""

    def __init__(self, merges: MergeList) -> None:
        self.merges, self.word = merges, Run(merges)
        self.dtype = np.dtype("<u2" if len(merges.bytes_of) <= 1 << 16 else "<u4")
        self.pretokens, self.pieces, self.spaced = Memo(self._pretoken), Memo(self._piece), Memo(lambda x: self._piece(" " + x))
        self.special = re.compile("|".join(map(re.escape, sorted(merges.special, key=len, reverse=True)))) if merges.special else None
        self.waiting, self.open, self.tail, self.run, self.kind = "", "", "", None, None

    def _pack(self, ids: list[int]) -> bytes:
        return np.array(ids, self.dtype).tobytes()

    def _pretoken(self, token: str) -> bytes:
        return self._pack(self.word.feed(token.encode()) + self.word.finish())

    def _piece(self, piece: str) -> bytes:
        return b"".join(map(self.pretokens.__getitem__, PRETOKEN.findall(piece)))

    def _plain(self, text: str) -> bytes:
        """Ids of a text that ends where a pretoken ends and holds no added token."""
        if not text:
            return b""
        first, *rest = BORDER.split(text) if LOOSE_SPACE.search(text) else text.split(" ")
        return self.pieces[first] + b"".join(map(self.spaced.__getitem__, rest))

    def _part(self, text: str) -> bytes:
        """Text between added tokens, of which the end may still be open."""
        out = b""
        if self.run:
            end = m.end() if (m := self.kind.match(text)) else 0
            own, text = self.tail + text[:end], text[end:]
            if self.kind is RUNS[3]:  # the last white space belongs to what follows
                own, self.tail = own[:-1], own[-1:]
            out = self._pack(self.run.feed(own.encode()))
            if not text:
                return out
            out, text = out + self._pack(self.run.finish()), self.tail + text
            self.run, self.tail = None, ""
        text = self.open + text
        cut = max((m.start() for m in BORDER.finditer(text, max(0, len(text) - 4096))), default=0)
        out, self.open = out + self._plain(text[:cut]), text[cut:]
        if len(self.open) > PIECE:
            *done, last = PRETOKEN.findall(self.open)
            if len(last) > PIECE // 2:  # one pretoken that goes on and on
                out += b"".join(map(self.pretokens.__getitem__, done))
                self.kind = next(k for k in RUNS if k.fullmatch(last, 1 if k is not RUNS[3] and last[0] == " " else 0))
                self.run, self.tail, self.open = Run(self.merges), "", ""
                if self.kind is RUNS[3]:
                    last, self.tail = last[:-1], last[-1:]
                out += self._pack(self.run.feed(last.encode()))
            elif len(done) > 3:  # two more are held back, as an apostrophe and letters can still become one
                out, self.open = out + b"".join(map(self.pretokens.__getitem__, done[:-2])), "".join(done[-2:]) + last
        return out

    def _close(self) -> bytes:
        out = b""
        if self.run:
            out = self._pack(self.run.feed(self.tail.encode()) + self.run.finish())
            self.run, self.tail = None, ""
        out, self.open = out + self._plain(self.open), ""
        return out

    def feed(self, text: str) -> bytes:
        text, out, at = self.waiting + text, b"", 0
        for m in self.special.finditer(text) if self.special else ():
            out += self._part(text[at:m.start()]) + self._close() + self._pack([self.merges.special[m.group()]])
            at = m.end()
        text = text[at:]
        begun = [n for x in self.merges.special for n in range(1, len(x)) if text.endswith(x[:n])]
        cut = len(text) - max(begun, default=0)  # what may be the beginning of an added token waits
        self.waiting = text[cut:]
        return out + self._part(text[:cut])

    def finish(self) -> bytes:
        text, self.waiting = self.waiting, ""
        return self._part(text) + self._close()

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids of a whole text, piece by piece."""
        specials = list(self.special.finditer(text)) if self.special else []
        at = 0
        for m in [*specials, None]:
            end = m.start() if m else len(text)
            for i in range(at, end, PIECE):
                yield self._part(text[i:min(i + PIECE, end)])
            yield self._close()
            if m:
                yield self._pack([self.merges.special[m.group()]])
                at = m.end()


class Decoder:
    """Ids to text, step by step; an unfinished character waits for its other bytes."""

    def __init__(self, merges: MergeList) -> None:
        self.bytes_of, self.text = merges.bytes_of, codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> str:
        return self.text.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.text.decode(b"", True)


_KEPT: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary."""
    if path not in _KEPT:
        _KEPT.clear()
        _KEPT[path] = Encoder(MergeList(path))
    return _KEPT[path]


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode every text and decode its ids: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The first digest is of the decimal ids joined by commas, the second of the decoded text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        decimal = [str(i) for i in range(len(enc.merges.bytes_of))]
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in batch.column(1):
                n, of_ids, of_text, decoder = 0, hashlib.sha256(), hashlib.sha256(), Decoder(enc.merges)
                for packed in enc.encode(text.as_py() or ""):
                    if packed:
                        ids = np.frombuffer(packed, enc.dtype).tolist()
                        of_ids.update(("," * (n > 0) + ",".join(map(decimal.__getitem__, ids))).encode())
                        of_text.update(decoder.feed(ids).encode())
                        n += len(ids)
                of_text.update(decoder.finish().encode())
                counts.append(n)
                ids_sha.append(of_ids.hexdigest())
                text_sha.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_ids(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and its ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            ids = [np.frombuffer(b"".join(enc.encode(t.as_py() or "")), enc.dtype).astype("i4") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return map_batches(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>")


def decode_ids(rows: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id and the text of its ids; null ids give an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merges = encoder(vocabulary).merges
        for batch in batches:
            texts = []
            for ids in batch.column(1).to_pylist():
                decoder, ids = Decoder(merges), ids or []
                texts.append("".join(decoder.feed(ids[i:i + PIECE]) for i in range(0, len(ids), PIECE)) + decoder.finish())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return map_batches(rows.select("doc_id", "ids"), run, "doc_id long, text string")

"""Token files and the BPE transducer against the tokenizers library."""

import hashlib
import json
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from townpulse.llm import bpe, token_files
from townpulse.llm.common import vocabulary
from townpulse.session import fresh_path

BYTE_BPE, WORD_BPE = vocabulary("byte_bpe_50k.json"), vocabulary("word_bpe_49k.json")
ODD = [
    None, "", " ", "\n", "a", "Ünïted  Ärzte,\nfoo-bar's 12345 ... don't!", "x" * 5000, "日本語 текст ΟΔΟΣ Σ", "<|endoftext|> a<|endoftext|>b",
    "é ẛ̣ İI", "tab\there\x1cthere\x85next", "word. Word! WORD?? (word)", "a  b   c \n d ", "😀🎉", "²Ⅷ½",
]
SCHEMA = "doc_id long, text string, lang string, n_tokens string"
DOCS = [(i * 3, t, "en", "clash") for i, t in enumerate(ODD)] + [(None, "no id", "en", "x"), (7, "twice", None, None), (7, "twice", None, None)]


@pytest.fixture(scope="module")
def merges():
    return bpe.MergeList(BYTE_BPE)


def test_files_hold_the_librarys_ids(spark):
    docs, folder, library = spark.createDataFrame(DOCS, SCHEMA), fresh_path(spark, "tokens"), Tokenizer.from_file(WORD_BPE)
    token_files.write_token_files(docs, folder, WORD_BPE, end_id=1)
    got = sorted(token_files.read_token_files(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    want, start = [], 0
    for doc_id, text, *_ in sorted(DOCS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        want.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        start += len(ids)
    assert [tuple(r) for r in got] == want


def test_words_have_the_librarys_ids():
    """Also where lower-casing and normalisation do not commute."""
    library, encoder, draw = Tokenizer.from_file(WORD_BPE), token_files.WordEncoder(WORD_BPE, np.dtype("<u2")), random.Random(7)
    parts = [
        "\u0130", "\u0130", "I", "\u0131", "\u03a3", "\u03c3", "\u03c2", "\u00df", "\u1e9e", "\u0307", "\u0323", "\u0301", "\u0e49", "\u0e38", "e\u0301", "\u1e9b\u0323", "\ufb01", "\u212b", "\u2126",
        "a", "Word", "s", ".", ",", "!", ")", " ", " ", "\n", "'s", "12", "\u00b2", "\u0345", "\u1f88", "\u01c5", "\uac00", "\u1100\u1161", "\x1c", "<|endoftext|>",
    ]
    texts = ["\u0130\u0e49", "\u0130\u0e38", "\u0130. \u03a3", "a\u0323\u0130."]
    texts += ["".join(draw.choice(parts) for _ in range(draw.randint(1, 12))) for _ in range(15_000)]
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u2").tolist() == library.encode(text, add_special_tokens=False).ids, ascii(text)


def test_files_of_an_empty_table(spark):
    folder = fresh_path(spark, "tokens")
    token_files.write_token_files(spark.createDataFrame([], SCHEMA), folder, WORD_BPE, end_id=1)
    assert token_files.read_token_files(spark, folder).count() == 0


def test_round_trip_equals_the_library(spark):
    library = Tokenizer.from_file(BYTE_BPE)
    rows = bpe.round_trip(spark.createDataFrame(DOCS, SCHEMA), BYTE_BPE).collect()
    want = []
    for doc_id, text, *_ in DOCS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want.append((doc_id, len(ids), *sha))
    assert sorted(map(repr, map(tuple, rows))) == sorted(map(repr, want))


def test_round_trip_of_an_empty_table(spark):
    assert bpe.round_trip(spark.createDataFrame([], SCHEMA), BYTE_BPE).collect() == []


def test_ids_decode_to_the_text(spark):
    docs = spark.createDataFrame(DOCS, SCHEMA)
    back = bpe.decode_ids(bpe.encode_ids(docs, BYTE_BPE), BYTE_BPE)
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(repr((r[0], r[1] or "")) for r in DOCS)


@pytest.mark.parametrize("piece", [1, 7, 100])
def test_pieces_of_any_size_give_the_same_ids(merges, monkeypatch, piece):
    monkeypatch.setattr(bpe, "PIECE", 40)
    library, encoder, draw = Tokenizer.from_file(BYTE_BPE), bpe.Encoder(merges), random.Random(piece)
    parts = ["a", "b", " ", "  ", "\n", "'", "'s", "'ll", "é", "12", "!", "<|endoftext|>", "the", " the", "日本", "😀", "́", "ing"]
    for _ in range(400):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 120))) + draw.choice("a!1 \n") * draw.randint(0, 200)
        packed = b"".join(encoder.feed(text[i:i + piece]) for i in range(0, len(text), piece)) + encoder.finish()
        assert np.frombuffer(packed, encoder.dtype).tolist() == library.encode(text, add_special_tokens=False).ids


def test_long_pretokens_stay_within_a_window(merges):
    draw = random.Random(3)
    for letters in ("a", "the", "abcdeinotrsgh", "=-"):
        text = "".join(draw.choice(letters) for _ in range(60_000))
        run, ids, held = bpe.Run(merges), [], 0
        for i in range(0, len(text), 1000):
            ids += run.feed(text[i:i + 1000].encode())
            held = max(held, len(run.held))
        assert ids + run.finish() == Tokenizer.from_file(BYTE_BPE).encode(text, add_special_tokens=False).ids
        assert held <= 2 * (merges.lookahead + max(map(len, merges.bytes_of))) + bpe.STEP


def _merge_list(folder, draw, letters, n):
    """A vocabulary of random merges, each of tokens made before."""
    stand_ins = bpe.byte_letters()
    tokens, merges = list(letters), []
    while len(merges) < n:
        a, b = draw.choice(tokens), draw.choice(tokens)
        if a + b not in tokens and len(a + b) < 9:
            tokens.append(a + b)
            merges.append(f"{a} {b}")
    vocab = {t: i for i, t in enumerate([*stand_ins.values(), *(t for t in tokens if len(t) > 1)])}
    path = folder / f"{n}-{draw.random()}.json"
    path.write_text(json.dumps({"model": {"vocab": vocab, "merges": merges}, "added_tokens": []}))
    return bpe.MergeList(str(path))


def _plain_merges(merges, data):
    """Lowest rank first, leftmost first, over the whole run."""
    ids = [merges.byte_ids[b] for b in data]
    while found := min(((merges.rank[p], i) for i, p in enumerate(zip(ids, ids[1:])) if p in merges.rank), default=None):
        ids[found[1]:found[1] + 2] = [merges.made[found[0]]]
    return ids


def test_final_tokens_never_change(tmp_path):
    """Random merge lists over few letters, where merges reach far."""
    draw, early = random.Random(11), 0
    for _ in range(150):
        letters = "abc"[:draw.randint(1, 3)]
        merges = _merge_list(tmp_path, draw, letters, draw.randint(1, 7 if letters == "a" else 25))
        for _ in range(40):
            data = "".join(draw.choice(letters) for _ in range(draw.randint(0, 60))).encode()
            for step in (1, 5):
                run, ids = bpe.Run(merges, step), []
                for i in range(0, len(data), 3):
                    ids += run.feed(data[i:i + 3])
                early += len(ids)
                assert ids + run.finish() == _plain_merges(merges, data)
    assert early > 10_000


def test_a_list_out_of_order_is_refused(tmp_path):
    stand_ins = [*bpe.byte_letters().values(), "ab", "abc"]
    path = tmp_path / "v.json"
    path.write_text(json.dumps({"model": {"vocab": {t: i for i, t in enumerate(stand_ins)}, "merges": ["ab c", "a b"]}, "added_tokens": []}))
    with pytest.raises(ValueError):
        bpe.MergeList(str(path))


def test_tokens_come_before_an_ordinary_pretoken_ends(merges):
    words, early, total, begun = " internationalization unbelievable misunderstandings Donaudampfschifffahrt ciónqueñdomi xylophonists".split(), 0, 0, 0
    for word in words:
        run, ids = bpe.Run(merges, step=1), []
        for b in (" " + word).encode():
            ids += run.feed(bytes([b]))
        whole = Tokenizer.from_file(BYTE_BPE).encode(" " + word, add_special_tokens=False).ids
        assert ids == whole[:len(ids)] and ids + run.finish() == whole
        early, total, begun = early + len(ids), total + len(whole), begun + bool(ids)
    assert begun >= 3 and early >= total // 4

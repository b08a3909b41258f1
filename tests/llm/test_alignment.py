"""Alignment against the two libraries on whole texts and all pairs of tokens."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from townpulse.llm import alignment as al
from townpulse.llm.common import vocabulary

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, n_a string, block string"
PARTS = [
    "the", " the", "  ", " ", "\n", "\n\n", "\t", "a", "ing", "'s", "'ll", "é", "日本", "текст", "😀", "́", "12", "345", "!", "...", "<|endoftext|>", "<s>", "<0x0A>",
    "　", "\xa0", "\x85", "\x1c", "\x1f", "​", "İ", "ß", "Σ", " ", "\x00", "\r\n", "ﬁ", "x" * 30,
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


@pytest.fixture(scope="module")
def aligner():
    return al.Aligner(A, B)


def brute(libraries, aligner, texts):
    """ids, cuts and linked positions of every text; links by comparing all pairs of ranges."""
    out = []
    for text in texts:
        want = (" " + (text or "")).encode()
        a = libraries[0].encode(want.decode(), add_special_tokens=False).ids if text else []
        b = libraries[1].encode(text) if text else []
        spans = []
        for ids, bytes_of in ((a, aligner.a.bytes_of), (b, aligner.b.bytes_of)):
            if b"".join(bytes_of[i] for i in ids) != want:
                a = b = spans = []
                break
            ends = np.cumsum([len(bytes_of[i]) for i in ids])
            spans.append(list(zip([0, *ends.tolist()], ends.tolist())))
        if not spans:
            out.append(([], [], [], []))
            continue
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        links = [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]
        out.append((a, b, cuts, links))
    return out


def rows_of(found):
    """The query's columns from the brute force's, without doc_id."""
    pairs = Counter(p for a, b, _, links in found for p in {(a[i], b[j]) for i, j in links})
    top = {}
    for (i, _), n in pairs.items():
        top[i] = max(top.get(i, 0), n)
    out = []
    for a, b, cuts, links in found:
        counts = [(pairs[a[i], b[j]], top[a[i]]) for i, j in links]
        groups, at_a, at_b = [], 0, 0
        while at_a < len(a):  # a group ends where no link reaches over it
            end_a, end_b = at_a + 1, at_b + 1
            while grown := [(i, j) for i, j in links if (at_a <= i < end_a or at_b <= j < end_b) and (i >= end_a or j >= end_b)]:
                end_a, end_b = max(end_a, *(i + 1 for i, _ in grown)), max(end_b, *(j + 1 for _, j in grown))
            groups.append(",".join(map(str, a[at_a:end_a])) + "|" + ",".join(map(str, b[at_b:end_b])))
            at_a, at_b = end_a, end_b
        assert len(groups) == len(cuts)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        out.append((len(a), len(b), len(groups), len(links), sum(n == most for n, most in counts), sum(n for n, _ in counts), sha))
    return out


def texts_of(seed, n, longest=25):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, longest))) for _ in range(n)] + [None, "", " ", "▁", "a▁b", "a ▁", "plain words only", "plain words only"]


def test_ids_equal_the_libraries(libraries, aligner, monkeypatch):
    monkeypatch.setattr(al, "LANE", 20)  # so that most texts are cut into lanes
    for text in texts_of(1, 4000, 60):
        lanes = aligner.encode(text)
        a = libraries[0].encode(" " + (text or ""), add_special_tokens=False).ids
        b = libraries[1].encode(text or "")
        if lanes is None:
            assert "▁" in text
        else:
            assert [i for x, _ in lanes for i in x] == (a if text else []) and [i for _, x in lanes for i in x] == b, repr(text)


def test_rows_equal_brute_force(spark, libraries, aligner, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", 300)
    texts = texts_of(2, 250)
    docs = spark.createDataFrame([(None if i == 5 else i // 2, t, "clash", None) for i, t in enumerate(texts)], SCHEMA)
    want = rows_of(brute(libraries, aligner, texts))
    got = [tuple(r) for r in al.score(docs.repartition(3), A, B).collect()]
    ids = [None if i == 5 else i // 2 for i in range(len(texts))]
    assert sorted(got, key=repr) == sorted(((i, *w) for i, w in zip(ids, want)), key=repr)


def test_links_and_cuts(spark, libraries, aligner):
    texts = texts_of(3, 120)
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: (r.a_ids, r.b_ids, r.cuts, list(zip(r.links_a, r.links_b))) for r in al.alignments(docs, A, B).collect()}
    assert [got[i] for i in range(len(texts))] == brute(libraries, aligner, texts)


def test_lanes_are_merged_like_single_pairs():
    draw = random.Random(4)
    lanes = []
    for _ in range(300):
        n = draw.randint(0, 40)
        lanes.append([sorted({*draw.sample(range(1, n), draw.randint(0, n - 1)), n}) if n else [] for _ in range(2)])
    at, ends = 0, ([], [])
    for lane in lanes:
        for own, all_ends in zip(lane, ends):
            all_ends.extend(at + e for e in own)
        at += lane[0][-1] if lane[0] else 0
    links_a, links_b, cuts = al.lockstep(*(np.array(e, np.int64) for e in ends), *(np.array([len(x[k]) for x in lanes]) for k in (0, 1)))
    starts = [[0, *e[:-1]] for e in ends]
    assert list(zip(links_a, links_b)) == [(i, j) for i in range(len(ends[0])) for j in range(len(ends[1])) if starts[0][i] < ends[1][j] and starts[1][j] < ends[0][i]]
    assert [ends[0][i] for i in links_a[cuts]] == sorted({*ends[0]} & {*ends[1]})


def test_very_long_texts(libraries, aligner):
    for text in ("a word, " * 40_000, " " * 200_000 + "x", "ab" * 100_000, "\n" * 50_000):
        lanes = aligner.encode(text)
        a, b = ([i for lane in lanes for i in lane[k]] for k in (0, 1))
        assert a == libraries[0].encode(" " + text, add_special_tokens=False).ids and b == libraries[1].encode(text)
        got = al.align(aligner, [text])
        assert got.a_ends[-1] == len(text) + 1 and got.cuts[-1]


def test_partitioning_does_not_matter(spark, partitions, monkeypatch):
    monkeypatch.setattr(al, "BLOCK", 500)
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts_of(5, 100))], SCHEMA)
    one, *others = partitions(lambda: al.score(docs.repartition(4), A, B))
    assert all(o == one for o in others)


def test_empty_table(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert al.score(docs, A, B).collect() == [] and al.alignments(docs, A, B).collect() == []


def test_texts_without_tokens_only(spark):
    docs = spark.createDataFrame([(1, None, "", ""), (2, "", "", ""), (3, "▁", "", "")], SCHEMA)
    assert sorted(map(tuple, al.score(docs, A, B).collect())) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2, 3)]

"""Components of near-duplicates against all pairs."""

import random
import re

import numpy as np
import pytest

from townpulse.llm import hyperminhash as h
from townpulse.llm.components import components

SCHEMA = "doc_id long, text string, id string, kept string"


def word_sets(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(docs, width, percent):
    sets, parent = {i: word_sets(t, width) for i, t, *_ in docs}, {i: i for i, *_ in docs}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for i in ids:
        for j in ids:
            if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def corpus(seed):
    draw = random.Random(seed)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(3)) for _ in range(400)]
    docs = []
    for _ in range(25):
        base = [draw.choice(vocabulary) for _ in range(draw.choice([1, 2, 4, 8, 30, 120, 400]))]
        for _ in range(draw.choice([1, 1, 2, 6, 12])):
            copy = base[:]
            for _ in range(draw.choice([0, 0, 1, 2, max(1, len(base) // 25)])):
                copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
            docs.append(" ".join(copy))
    chain = [draw.choice(vocabulary) for _ in range(200)]  # each like the next only
    for _ in range(25):
        for i in draw.sample(range(200), 8):
            chain[i] = draw.choice(vocabulary)
        docs.append(" ".join(chain))
    docs += ["", None, "  \n", "One", "one", "ONE two", "x " * 30_000]
    draw.shuffle(docs)
    return [(i * 2 + 1, t, "clash", "clash") for i, t in enumerate(docs)]


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_those_of_all_pairs(spark, width):
    docs = corpus(width)
    rows = h.near_duplicates(spark.createDataFrame(docs, SCHEMA).repartition(4), width, 80).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in rows} == brute(docs, width, 80)
    assert len(rows) == len(docs)


def test_null_and_repeated_ids(spark):
    text = "some words that are long enough to be a text of their own"
    docs = [(None, text), (None, text), (5, text), (5, text), (7, text), (7, "quite another text with other words in it"), (9, "quite another text with other words in it")]
    rows = h.near_duplicates(spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA), 2, 80).collect()
    assert sorted((str(r.doc_id), r.component_id, r.kept) for r in rows) == sorted([("None", None, True)] * 2 + [("5", 5, True)] * 2 + [("7", 5, False)] * 2 + [("9", 5, False)])
    kept = h.keep_first(spark.createDataFrame([(*d, "x", "y") for d in docs], SCHEMA), 2, 80)
    assert kept.columns == ["doc_id", "text", "id", "kept"] and kept.count() == 4
    assert h.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_is_near_the_similarity():
    draw = np.random.default_rng(1)
    for n in (3, 20, 150, 3000):
        got = []
        for _ in range(40):
            pool = draw.integers(0, 1 << 63, 2 * n, np.uint64) * np.uint64(2)
            common = int(n * 0.9)
            a, b = np.unique(pool[:n]), np.unique(np.concatenate((pool[:common], pool[n:2 * n - common])))
            truth = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            got.append(h.estimate(h.registers(a)[None], h.registers(b)[None], np.array([n]), np.array([n]))[0] - truth)
        assert abs(np.mean(got)) < 0.04


def test_components_of_a_long_path(spark):
    links = [(i, i + 1) for i in range(0, 100)] + [(i + 1000, i + 1001) for i in range(5)] + [(7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(101)}, **{i: 1000 for i in range(1000, 1006)}}


def copies(draw, n, words, changed):
    """``n`` copies of a text of ``words`` words, each with its own share of words changed."""
    base = [f"w{i}" for i in range(words)]
    out = []
    for k in range(n):
        copy = base[:]
        for i in draw.sample(range(words), int(words * changed)):
            copy[i] = f"x{k}y{i}"
        out.append(" ".join(copy))
    return out


def test_copies_below_the_threshold_are_not_paired(spark, monkeypatch):
    """300 texts of a similarity between 0.6 and 0.79, and among them some that are linked."""
    draw = random.Random(8)
    texts = copies(draw, 300, 400, 0.06)
    sets = [word_sets(t, 2) for t in texts]
    alike = [len(a & b) / len(a | b) for a, b in (draw.sample(sets, 2) for _ in range(300))]
    assert 0.6 < min(alike) and max(alike) < 0.79
    texts += [t.replace("w5 ", "z ") for t in texts[:20]]
    docs = [(i, t, "", "") for i, t in enumerate(texts)]
    rows = spark.createDataFrame(docs, SCHEMA)
    of = rows.selectExpr("doc_id AS id", "doc_id AS of")
    pairs = {(r.u, r.v) for r in h.rare_pairs(rows, of, 2, 80).collect()}
    assert {(i, 300 + i) for i in range(20)} <= pairs and len(pairs) < 100
    monkeypatch.setattr(h, "LEADER_ROUNDS", 0)  # all is left to the last round
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in h.near_duplicates(rows, 2, 80).collect()}
    assert got == brute(docs, 2, 80)


@pytest.mark.parametrize("percent", [60, 80, 95])
def test_rare_shingles_lose_no_link(spark, percent):
    docs = corpus(30 + percent)
    docs = [*docs, (docs[0][0], docs[1][1], "", ""), docs[3]]  # an id with two texts, a repeated row
    rows = spark.createDataFrame(docs, SCHEMA)
    pairs = {(r.u, r.v) for r in h.rare_pairs(rows, rows.selectExpr("doc_id AS id", "doc_id AS of"), 2, percent).collect()}
    sets = [(i, word_sets(t, 2)) for i, t, *_ in docs]
    links = {(i, j) for i, a in sets for j, b in sets if i < j and a and b and 100 * len(a & b) >= percent * len(a | b)}
    assert links <= pairs

"""The chain's probabilities against all state sequences; scores on held-out rows."""

import itertools
import random

import numpy as np

from townpulse.llm import toxicity as x

SCHEMA = "doc_id long, text string, score string, toxic string"


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(2)
    for _ in range(60):
        n = int(draw.integers(1, 9))
        levels = draw.integers(0, 4, n) * (draw.random(n) < 0.5)
        model = x.Field({}, draw.normal(size=(4, 2)), draw.normal(size=(2, 2)), np.zeros(4))
        weight, toxic = 0.0, np.zeros(n)
        for states in itertools.product((0, 1), repeat=n):
            w = np.exp(sum(model.levels[k, s] for k, s in zip(levels, states)) + sum(model.moves[a, b] for a, b in zip(states, states[1:])))
            weight += w
            toxic += w * np.array(states)
        at = np.flatnonzero(levels)
        assert np.allclose(model.marginals(n, at, levels[at], model.gaps()), (toxic / weight)[at])


def test_fit_reaches_the_labelled_shares():
    chunks = np.full((2, x.CHUNK), -1)
    chunks[:, :4] = [[0, 1, 1, 0], [0, 0, 1, 0]]
    tags = np.where(chunks < 0, -1, 0)
    tags[0, :4] = [0, 1, 1, 0]
    levels, moves = x.fit_field(chunks, tags, np.array([3.0, 1.0]))
    model = x.Field({}, levels, moves, np.zeros(4))
    pair, single = (model.marginals(4, np.array(at), np.ones(len(at), int), model.gaps()) for at in ([1, 2], [2]))
    assert pair.min() > 0.9 and single[0] < 0.1


def corpus():
    draw = random.Random(7)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 6)))
    rows, labels = [], []
    for i in range(900):
        words, toxic = [word() for _ in range(draw.randint(5, 60))], i % 4 == 0
        for _ in range(draw.randint(1, 4) if toxic else 0):
            words.insert(draw.randrange(len(words)), draw.choice(["Zwumpy", "grotzilian", "grotzibo!", "grotziweh", "VLORP,"]))
        rows.append((i, " ".join(words), "clash", "clash"))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_rows(spark):
    rows, labels = corpus()
    extra = [(None, "some zwumpy text", None, None), (2000, None, None, None), (2001, "", None, None), (2002, "clean " * 50_000, None, None), (2002, "clean " * 50_000, None, None)]
    docs = spark.createDataFrame(rows + extra, SCHEMA)
    model = x.fit(docs, spark.createDataFrame(labels + [(1, None), (77_777, 1)], "doc_id long, toxic int"))
    assert {"zwumpy", "vlorp", "grotzi*"} <= set(model.lexicon)
    got = x.score(docs, model).collect()
    assert len(got) == len(rows) + len(extra)
    by_id, truth = {r.doc_id: r for r in got}, dict(labels)
    held = [i for i in truth if by_id[i].held_out]
    assert len(held) > 150 and sum(by_id[i].predicted == truth[i] for i in held) >= 0.99 * len(held)
    named = [(text[s.start:s.end].lower()[:4] in ("zwum", "grot", "vlor"), truth[i]) for i, text, *_ in rows for s in by_id[i].spans]
    assert len(named) > 225 and sum(a and b for a, b in named) >= 0.99 * len(named)
    assert by_id[None].predicted == 1 and not by_id[None].held_out
    assert by_id[2000].score == by_id[2001].score < x.THRESHOLD and by_id[2002].predicted == 0


def test_without_labels_or_rows(spark):
    rows, labels = corpus()
    docs, schema = spark.createDataFrame(rows, SCHEMA), "doc_id long, toxic int"
    none = x.score(docs, x.fit(docs, spark.createDataFrame([], schema))).collect()
    assert {r.score for r in none} == {0.5}
    one = x.score(docs, x.fit(docs, spark.createDataFrame([(i, 0) for i, _ in labels], schema))).collect()
    assert {r.predicted for r in one} == {0}
    assert x.score(docs.limit(0), x.fit(docs.limit(0), spark.createDataFrame(labels, schema))).count() == 0


def test_lexicon_has_no_largest_size(spark):
    """Every word of enough evidence is an entry, however many there are; words that fall on both labels alike are none."""
    words = [(f"bad{i}", 0, 6) for i in range(3_000)] + [(f"rare{i}", 0, 4) for i in range(50)] + [(f"plain{i}", 60, 7) for i in range(500)]
    counts = spark.createDataFrame([w for w in words if w[2] >= x.LEAST_COUNT], "feature string, other long, toxic long")
    lexicon = x._lexicon(counts, {0: 9_000, 1: 1_000})
    assert set(lexicon) == {f"bad{i}" for i in range(3_000)} and set(lexicon.values()) == {1 + (np.log(6.5 / 1_001 / (0.5 / 9_001)) >= x.LEVELS[1])}


def test_evidence_is_chernoffs_bound(spark):
    rows = [(f"w{a}-{b}", a, b) for a in range(0, 12) for b in range(5, 40, 3)]
    n = {0: 5_000, 1: 700}
    want, p = set(), n[1] / sum(n.values())
    for f, a, b in rows:
        share, every = b / (a + b), a + b
        divergence = share * np.log(share / p) + ((1 - share) * np.log((1 - share) / (1 - p)) if a else 0.0)
        if len(rows) * np.exp(-every * divergence) <= x.BY_CHANCE and np.log((b + 0.5) / (n[1] + 1) / ((a + 0.5) / (n[0] + 1))) >= np.log(x.LEAST_RATIO):
            want.add(f)
    assert want and set(x._lexicon(spark.createDataFrame(rows, "feature string, other long, toxic long"), n)) == want

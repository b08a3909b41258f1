"""Packing against a plain best fit, and what must hold for every packing."""

import random

from townpulse.llm import packing as p
from townpulse.llm.common import vocabulary

LENGTHS = (8, 16, 32)


def plain(sizes, lengths):
    """Best fit over a list of bins; of equal rooms the bin filled last."""
    bins, where = [], []
    for k, size in enumerate(sizes):
        fits = [(b["room"], -b["turn"], i) for i, b in enumerate(bins) if b["room"] >= size]
        if fits:
            i = min(fits)[2]
        else:
            left = sum(sizes[k + 1:])
            length = min((x for x in lengths if x >= size), key=lambda x: (p.bin_cost(x) / (size + min(x - size, left)), x))
            i = len(bins)
            bins.append({"room": length, "used": 0})
        where.append((i, bins[i]["used"]))
        bins[i]["room"] -= size
        bins[i]["used"] += size
        bins[i]["turn"] = k
    return where, [min(x for x in lengths if x >= b["used"]) for b in bins]


def test_equals_plain_best_fit():
    draw = random.Random(8)
    for _ in range(200):
        sizes = sorted((draw.randint(1, 32) for _ in range(draw.randint(0, 60))), reverse=True)
        bins, offsets, lengths = p.pack(sizes, LENGTHS)
        assert (list(zip(bins, offsets)), lengths) == plain(sizes, LENGTHS)


def test_every_token_has_one_place(spark):
    draw = random.Random(3)
    rows = [(i, draw.choice([1, 5, 9, 31, 32, 33, 100]), "clash") for i in range(400)] + [(None, 7, "x"), (5, 7, "x"), (5, 7, "x"), (9, 0, None)]
    counts = spark.createDataFrame(rows, "doc_id long, n_tokens long, bin_id string")
    placed = p.place(counts, LENGTHS, shard=100).collect()
    assert sum(r.n_tokens for r in placed) == sum(r[1] for r in rows) and len({r.bin_id >> 32 for r in placed}) > 3
    spans, ends = {}, {}
    for r in placed:
        spans.setdefault(r.bin_id, []).append((r.place, r.n_tokens, r.length))
        ends.setdefault(r.doc_id, []).append((r.start, r.n_tokens))
    for own in spans.values():
        own.sort()
        assert [a for a, *_ in own] == [sum(n for _, n, _ in own[:i]) for i in range(len(own))]
        used = sum(n for _, n, _ in own)
        assert {x for *_, x in own} == {min(x for x in LENGTHS if x >= used)}
    for i, n, _ in rows[:400]:
        if i != 5:
            assert sum(k for _, k in ends[i]) == n and sorted(a for a, _ in ends[i]) == list(range(0, n, 32))
    assert len(ends[None]) == 1 and 9 in ends


def test_sequences_hold_the_documents_ids(spark):
    ids = {i: list(range(100 * i, 100 * i + n)) for i, n in enumerate([3, 70, 16, 8, 1, 40])}
    placed = p.place(spark.createDataFrame([(i, len(x)) for i, x in ids.items()], "doc_id long, n_tokens long"), LENGTHS)
    got = p.sequences(placed, spark.createDataFrame(list(ids.items()), "doc_id long, ids array<int>")).collect()
    assert sorted(x for r in got for x in r.ids) == sorted(x for own in ids.values() for x in own)
    for r in p.bins(placed).collect():
        assert next(g.ids for g in got if g.bin_id == r.bin_id) == [x for q in r.pieces for x in ids[q.doc_id][q.start:q.start + q.n_tokens]]
        assert r.n_tokens <= r.length


def test_counts_and_empty(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "one two"), (None, "x")], "doc_id long, text string")
    assert {r.doc_id: r.n_tokens for r in p.token_counts(docs, vocabulary("word_bpe_49k.json")).collect()} == {1: 1, 2: 1, 3: 3, None: 2}
    assert p.place(p.token_counts(docs.limit(0), vocabulary("word_bpe_49k.json"))).count() == 0


def test_bins_do_not_hang_on_partitioning(spark, monkeypatch):
    monkeypatch.setattr(p, "REPEATS", 4)
    draw = random.Random(6)
    rows = [(draw.choice([None, *range(150)]), draw.choice([1, 5, 9, 31, 33, 100])) for _ in range(400)] + [(None, 7)] * 50
    found = []
    for k in (1, 7, 64):
        draw.shuffle(rows)
        counts = spark.createDataFrame(rows, "doc_id long, n_tokens long").repartition(k)
        found.append(sorted(map(repr, p.bins(p.place(counts, LENGTHS, shard=100)).collect())))
    assert found[0] == found[1] == found[2] and sum(n for _, n in rows) == p.place(counts, LENGTHS).agg({"n_tokens": "sum"}).first()[0]


def test_very_long_text(spark):
    docs = spark.createDataFrame([(1, "word " * 300_000), (2, "x" * 500_000)], "doc_id long, text string")
    counts = {r.doc_id: r.n_tokens for r in p.token_counts(docs, vocabulary("word_bpe_49k.json")).collect()}
    assert counts[1] == 300_001 and counts[2] > 1

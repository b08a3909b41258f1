"""Language filters against plain sets of n-grams and held-out labels."""

import random
import unicodedata
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from townpulse.llm import language_id as li

SCHEMA = "doc_id long, text string, lang string, held_out string, score string"
WORDS = {
    "xa": ["tharo", "minek", "vosta", "elune", "karib"], "yb": ["schrim", "böltz", "änder", "zwickt", "ungeh"],
    "zc": ["ñandú", "corriz", "allobe", "quexar", "ciones"],
}


def drawn(n, seed=1, langs=None):
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        lang = draw.choice(langs or [*WORDS])
        rows.append((i, " ".join(draw.choice(WORDS[lang]) for _ in range(draw.randint(3, 40))) + ".", lang, None, "clash"))
    return rows


def word_grams(text):
    """N-grams of a text by the definition, as strings."""
    letters = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower())
    out = []
    for word in letters.split():
        word = f"\0{word}\0"
        out += [word[i:i + n] for n in li.SIZES for i in range(len(word) - n + 1)]
    return out


def hashed(texts):
    rows = [[] for _ in texts]
    for codes, of in li.chunks(texts):
        for hashes, row in li.grams(codes, of):
            for h, r in zip(hashes.tolist(), row.tolist()):
                rows[r].append(h)
    return rows


TEXTS = ["Mixed CASE, words; 12 and-so é́ x", "", None, "...", "İstanbul ß", "日本語 текст", "a" * 50, "one\n\ntwo", "\0x\0y"]


def test_grams_are_those_of_words():
    one = set()
    for text, found in zip(TEXTS, hashed(TEXTS)):
        want = word_grams(text or "")
        assert Counter(Counter(found).values()) == Counter(Counter(want).values())
        one.update(want)
    assert len({h for found in hashed(TEXTS) for h in found}) == len(one)


@pytest.mark.parametrize("size", [7, 50])
def test_pieces_of_any_size_have_the_same_grams(monkeypatch, size):
    text = "some words, and Ünïted others " * 20
    want = sorted(hashed([text, "b", text])[2])
    monkeypatch.setattr(li, "CHUNK", size)
    assert sorted(hashed([text, "b", text])[2]) == want if size == 50 else len(hashed([text])[0]) > 0


def test_filters_hold_all_their_grams_and_few_others(spark):
    rows = drawn(200)
    filters = li.fit(spark.createDataFrame(rows, SCHEMA))
    counts = {lang: Counter(g for _, text, own, *_ in rows if own == lang for g in set(word_grams(text))) for lang in WORDS}
    n = Counter(r[2] for r in rows)
    assert filters.languages == [lang for lang, _ in sorted(n.items(), key=lambda x: (-x[1], x[0]))]
    shares = {lang: {g: c / n[lang] for g, c in counts[lang].items()} for lang in WORDS}
    for i, lang in enumerate(filters.languages):
        for gram in {g for c in counts.values() for g in c}:
            share, most = shares[lang].get(gram, 0), max(s.get(gram, 0) for s in shares.values())
            text = gram.strip("\0")
            of_gram = [h for h in hashed([text])[0]] if gram.startswith("\0") and gram.endswith("\0") else None
            if of_gram and share >= li.LEAST_SHARE and share >= li.LEAST_PART * most:
                whole = np.array(of_gram[-1:], np.uint64)
                assert filters.masks(whole)[0, i // 8] & (128 >> i % 8)
    others = np.random.default_rng(1).integers(0, 1 << 63, 200_000).astype(np.uint64)
    for i, rate in enumerate(filters.rates()):
        assert np.count_nonzero(filters.masks(others)[:, i // 8] & (128 >> i % 8)) / len(others) < rate + 1e-3


def test_counts_are_corrected_for_false_positives(monkeypatch):
    """Filters so full that they say yes to a third of everything still name the language."""
    monkeypatch.setattr(li, "SLOTS", 1 << 12)
    draw = np.random.default_rng(2)
    bits = np.zeros((li.SLOTS, 1), np.uint8)
    for i, of_slots in enumerate((0.55, 0.85)):
        bits[:, 0] |= np.where(draw.random(li.SLOTS) < of_slots, np.uint8(128 >> i), np.uint8(0))
    text = "some words of the first language which its filter holds"
    for hashes in hashed([text]):
        for slot in li.slots(np.array(hashes, np.uint64)):
            bits[slot, 0] |= 128
    filters = li.Filters(["first", "full"], bits)
    n, hits = filters.count([text + " and more of it that is not held by any filter at all"])
    assert filters.rates()[1] > 0.4 and filters.predict([text])[0] == ["first"]
    own = (hits[0] - n[0] * filters.rates()) / (1 - filters.rates())
    assert own[0] > 0.5 * n[0] and abs(own[1]) < 0.35 * n[0]


def test_planted_languages(spark, partitions):
    rows = drawn(300) + [(900, None, "xa", None, None), (901, "", "xa", None, None), (902, "12 !", None, None, None), (None, "tharo minek", "xa", None, None)]
    rows += [(903, "vosta elune " * 60_000, None, None, None), (904, "日本", None, None, None), rows[0], rows[0]]
    docs = spark.createDataFrame(rows, SCHEMA)

    def judged():
        return li.predict(docs, li.fit(docs, li.held_out(F.col("doc_id")))).where("doc_id is not null")

    one, *others = partitions(judged)
    assert all(o == one for o in others)
    got = {doc_id: (lang, score) for doc_id, lang, score in one}
    assert all(got[i][0] == lang for i, _, lang, *_ in drawn(300)) and all(0 < got[i][1] <= 1 for i in range(300))
    assert [got[i][0] for i in (900, 901, 902, 903)] == ["und", "und", "und", "xa"]
    assert got[904] == (li.fit(docs, li.held_out(F.col("doc_id"))).languages[0], 0.0)
    assert len(one) == len(rows) - 1


def test_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame(drawn(60), SCHEMA)
    other = docs.withColumn("lang", F.when(li.held_out(F.col("doc_id")), F.lit("wrong")).otherwise(F.col("lang")))
    a, b = (li.fit(d, li.held_out(F.col("doc_id"))) for d in (docs, other))
    assert a.languages == b.languages and (a.bits == b.bits).all()


def test_more_languages_than_a_byte_holds(spark):
    rows = [(i, chr(0x4E00 + i % 20) * 2 + " " + chr(0x5E00 + i % 20) * 3, f"l{i % 20:02}", None, None) for i in range(200)]
    docs = spark.createDataFrame(rows, SCHEMA)
    filters = li.fit(docs)
    assert filters.bits.shape[1] == 3
    assert {r.doc_id: r.lang_pred for r in li.predict(docs, filters).collect()} == {r[0]: r[2] for r in rows}


def test_empty_and_unlabelled_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert li.predict(empty, li.fit(empty)).collect() == []
    docs = spark.createDataFrame([(1, "words", None, None, None)], SCHEMA)
    assert [tuple(r) for r in li.predict(docs, li.fit(docs)).collect()] == [(1, "und", 0.0)]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = li.held_out(F.col("doc_id"))
    found = li.predict(docs, li.fit(docs, held)).withColumnRenamed("doc_id", "d")
    right = docs.join(found, F.col("doc_id") == F.col("d")).where(held & F.col("lang").isNotNull()).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.99

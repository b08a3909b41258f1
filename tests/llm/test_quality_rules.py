"""Statistics and decision list against plain Python."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from townpulse.llm import quality_rules as q
from townpulse.session import stage

SCHEMA = "doc_id long, text string, n_words string, quality string"


def counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if seen[w] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


@pytest.fixture(scope="module")
def corpus():
    draw = random.Random(2)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 8))) for _ in range(300)]
    rows = []
    for i in range(600):
        words = [draw.choice(vocabulary) for _ in range(draw.choice([0, 3, 19, 20, 60, 200]))]
        if i % 5 == 0:
            words = [w + draw.choice("*$%") for w in words]
        if i % 7 == 0:
            words = words[:12] * 3 + words
        if i % 11 == 0:
            words = ["que"] * len(words)
        text = "".join(w + draw.choice([" ", " ", "  ", "\n", "\t", " "]) for w in words)
        rows.append((i, text + "\n".join(["same line"] * draw.choice([0, 0, 1, 4])), "clash", "clash"))
    return rows + [(None, "no id " * 12, None, None), (1000, None, None, None), (1001, "", None, None), (1001, "", None, None), (1002, "word " * 30_000, None, None), (1003, "x" * 200_000, None, None)]


def test_counts(spark, corpus):
    got = q.judge(spark.createDataFrame(corpus, SCHEMA), spark.createDataFrame([], "doc_id long, quality int"))
    rows = sorted(repr((r.doc_id, *(r[c] for c in q.COUNTS), r.base_failed, r.kept)) for r in got.collect())
    want = []
    for i, text, *_ in corpus:
        c = counts(text)
        failed = c[0] < 20 or 100 * c[4] > 30 * c[0]
        want.append(repr((i, *c, failed, not failed)))
    assert rows == sorted(want)


def test_learned_list(spark, corpus):
    docs = spark.createDataFrame(corpus, SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(0, 600) if i % 3] + [(5000, 0), (7, None)], "doc_id long, quality int")
    stats = stage(q.statistics(docs.select("doc_id", "text")), "stats")
    rules = q.learn(stats, labels)
    assert rules and rules == q.learn(stats.repartition(7), labels)
    table = q.judged(stats, rules).where("not base_failed")
    for r in table.select("doc_id", "rule", "kept", *(q.feature(f).alias(f) for f in q.FEATURES)).collect():
        fires = [i for i, rule in enumerate(rules) if all((r[c.feature] > c.threshold) == c.above for c in rule)]
        assert r.rule == (fires[0] if fires else None) and r.kept == (not fires)
        if r.doc_id is not None and r.doc_id < 600:
            assert r.kept == (r.doc_id % 5 != 0)


def test_filter_keeps_all_columns(spark, corpus):
    docs, labels = spark.createDataFrame(corpus, SCHEMA), spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(600)], "doc_id long, quality int")
    kept = q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    want = q.judge(docs, labels).where("kept").select("doc_id")
    assert sorted(map(repr, kept.select("doc_id").collect())) == sorted(map(repr, want.collect()))
    assert kept.where(F.col("n_words") == "clash").count() > 100
    assert q.keep_good(docs.limit(0), labels).count() == 0


def test_main_path_is_native(spark, corpus):
    plan = q.judge(spark.createDataFrame(corpus, SCHEMA), spark.createDataFrame([], "doc_id long, quality int"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


COUNTED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_marks long"


def counted(draw, i, n_words):
    return (i, n_words, 5 * n_words, draw.choice([0, 0, 0, 3, 9]), 0, 0, 10, draw.randint(0, n_words), draw.randint(0, 40))


def plain_covering(rows):
    """Sequential covering row by row; ``rows`` are (features, bad, prune)."""
    names = list(q.FEATURES)
    points = sorted({(2 * i + 1) / (2 * q.EDGES) for i in range(q.EDGES)} | set(q.TAILS) | {1 - x for x in q.TAILS})
    edges = {}
    for f in names:
        edges[f] = set()
        for label in (0, 1):
            own = sorted(x[f] for x, bad, _ in rows if bad == label)
            edges[f] |= {own[max(0, math.ceil(round(p * len(own), 9)) - 1)] for p in points}
    least = max(q.LEAST_BAD, q.LEAST_SHARE * sum(bad for _, bad, _ in rows))

    def covered(rule, x):
        return all((x[c.feature] > c.threshold) == c.above for c in rule)

    def count(own):
        return sum(b for _, b, _ in own), sum(1 - b for _, b, _ in own)

    rules, aside = [], []
    while True:
        left = [r for r in rows if not any(covered(rule, r[0]) for rule in rules)]
        own = [r for r in left if not r[2] and not any(covered(rule, r[0]) for rule in aside)]
        rule = ()
        while True:
            p0, n0 = count(own)
            best = None
            for f in names if p0 and n0 else ():
                for x in sorted(edges[f]):
                    for above in (False, True):
                        p, n = count([r for r in own if (r[0][f] > x) == above])
                        gain = p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0))) if p >= least else 0
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = gain, q.Condition(f, above, x)
            if best is None:
                break
            rule = (*rule, best[1])
            own = [r for r in own if covered(rule, r[0])]
        if not rule or p0 < q.LEAST_PRECISION * (p0 + n0):
            return rules
        held = [count([r for r in left if r[2] and covered(rule[:k], r[0])]) for k in range(1, len(rule) + 1)]
        k = max(range(len(held)), key=lambda i: ((held[i][0] - held[i][1]) / max(1, sum(held[i])), -i))
        if held[k][0] < least / 2 or held[k][0] < q.LEAST_PRECISION * sum(held[k]):
            aside.append(rule)
        else:
            rules.append(rule[:k + 1])


def test_rules_equal_a_plain_covering(spark):
    draw = random.Random(9)
    rows = [counted(draw, i, draw.randint(20, 400)) for i in range(700)]
    labels = [(r[0], int(not (r[3] == 9 or 100 < r[1] <= 160 or r[8] > 30 and draw.random() < 0.7))) for r in rows]
    stats, marked = spark.createDataFrame(rows, COUNTED), spark.createDataFrame(labels, "doc_id long, quality int")
    rules = q.learn(stats, marked)
    third = F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0
    table = stats.join(marked, "doc_id").select("quality", third.alias("prune"), *(q.feature(f).alias(f) for f in q.FEATURES)).collect()
    assert len(rules) > 1 and rules == plain_covering([(r.asDict(), 1 - r.quality, r.prune) for r in table])


def test_as_many_rules_as_there_are_kinds(spark):
    draw = random.Random(5)
    rows = [counted(draw, i, draw.randint(20, 819)) for i in range(6_000)]
    labels = [(r[0], int(r[1] // 40 % 2)) for r in rows]
    stats = spark.createDataFrame(rows, COUNTED)
    rules = q.learn(stats, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert len(rules) > 8
    kept, truth = {r.doc_id: r.kept for r in q.judged(stats, rules).collect()}, dict(labels)
    assert sum(kept[i] == bool(truth[i]) for i in truth) > 0.85 * len(truth)

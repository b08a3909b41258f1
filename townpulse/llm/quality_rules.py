"""Quality rules: a learned decision list over text statistics.

``statistics`` counts what a text looks like, with built-in functions only. ``learn``
turns labelled statistics into an ordered list of rules by sequential covering: a rule for
bad documents is grown condition by condition (the one with the greatest information gain
on two thirds of the rows), its tail is pruned on the other third, the documents it covers
are set aside, and the next rule is grown on the rest. A rule that fails on the other
third is left out and its documents are set aside for growing alone, so later rules get
their turn. Covering ends when no rule of enough support and precision can be grown; rules
and their conditions have no largest number. Each step needs only counts per feature and
threshold, which Spark adds up over all labelled rows; no rows reach the driver. ``verdict`` writes the list as one ordered conditional expression.

A word is a run without white space. Base checks come before the learned list: too few
words, or too large a part of them within repeated windows of eight words.

Nulls and ties: a null text has no words and fails the base checks. Labels of unknown
documents and null labels are ignored; if one of both labels is missing, the list is empty
and only the base checks decide. Equal gains go to the first feature and threshold.
Repeated rows and null ids are judged by their text alone; an empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpulse.session import stage

WHITE = " \t\n\u000b\f\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPAN = 8
LEAST_WORDS, MOST_REPEATED = 20, 30

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: What a rule may ask about, from the counts (the last three are counted besides).
FEATURES = {
    "symbols_per_word": "n_symbols / n_words",
    "mean_word": "word_chars / n_words",
    "repeat_share": "n_repeat_words / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "upper_share": "n_upper / word_chars",
    "marks_per_word": "n_marks / n_words",
    "words": "double(n_words)",
}
#: Quantiles at which each label's rows give a feature a threshold: even steps, and closer ones
#: at both ends, where a rare kind of document has its border.
EDGES = 32
TAILS = (0.001, 0.0025, 0.005, 0.0075)
#: A rule must cover so many bad documents, or this share of them if that is more, and be so precise.
LEAST_BAD, LEAST_SHARE, LEAST_PRECISION = 5, 0.001, 0.8


def _without(text: Column, letters: str) -> Column:
    return F.length(F.translate(text, letters, ""))


def statistics(docs: DataFrame) -> DataFrame:
    """``docs`` (text and any other columns) with its text replaced by the statistics.

    Windows are compared by 64-bit hashes of their words' hashes (``slice`` would copy the
    whole array for every window). Only texts in which a window repeats go through
    a sort: of (hash, place) pairs, whose neighbours tell which places repeat.
    """
    kept = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: _without(x, WHITE) > 0)
    df = docs.select(
        *kept, F.transform(words, lambda w: F.xxhash64(w)).alias("_words"), lines.alias("_lines"), _without(text, WHITE).cast("long").alias("word_chars"),
        (F.length(text) - _without(text, SYMBOLS)).cast("long").alias("n_symbols"),
        (F.length(text) - _without(text, UPPER)).cast("long").alias("n_upper"), (F.length(text) - _without(text, "!?")).cast("long").alias("n_marks"),
    )
    n = F.size("_words")
    windows = F.transform(F.sequence(F.lit(0), n - SPAN), lambda i: F.xxhash64(*(F.get("_words", i + k) for k in range(SPAN))))
    df = df.select(
        *kept, "word_chars", "n_symbols", "n_upper", "n_marks", n.cast("long").alias("n_words"), F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n >= SPAN, windows).otherwise(F.array().cast("array<bigint>")).alias("_windows"),
    )
    counts = [c for c in df.columns if c != "_windows"]
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    paired = F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.select(*counts, F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), paired).otherwise(none).alias("_pairs"))
    repeated = F.transform("_pairs", lambda p, k: F.when((p.h == F.get("_pairs", k - 1).h) | (p.h == F.get("_pairs", k + 1).h), p.i))
    df = df.select(*counts, F.sort_array(F.array_compact(repeated)).alias("_at"))
    reach = F.transform("_at", lambda x, k: F.least(F.lit(SPAN), F.coalesce(F.get("_at", k + 1) - x, F.lit(SPAN))))
    return df.select(*counts, F.aggregate(reach, F.lit(0), lambda a, b: a + b).cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def feature(name: str) -> Column:
    """A feature as an expression over the counts; 0 where it would divide by zero."""
    if "/" in FEATURES[name]:
        over, under = FEATURES[name].split(" / ")
        return F.when(F.col(under) > 0, F.col(over) / F.col(under)).otherwise(F.lit(0.0))
    return F.expr(FEATURES[name])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def over_features(self) -> Column:
        return feature(self.feature) > self.threshold if self.above else feature(self.feature) <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold!r}"


Rule = tuple[Condition, ...]


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def verdict(rules: list[Rule]) -> Column:
    """The number of the first rule that rejects, null if none does."""
    out = F.lit(None).cast("int")
    for i, rule in reversed(list(enumerate(rules))):
        out = F.when(_all([c.over_features() for c in rule]), F.lit(i)).otherwise(out)
    return out


def learn(stats: DataFrame, labels: DataFrame) -> list[Rule]:
    """Rules for bad documents from ``stats`` (doc_id and counts) and ``labels`` (doc_id, quality).

    ``stats`` should be a stored table: filters on freshly counted statistics would be
    pushed into the array expressions and repeat them.
    """
    names = list(FEATURES)
    rows = stats.where(~base_failed()).select("doc_id", *(feature(f).alias(f) for f in names)).join(labels.where("quality in (0, 1)").select("doc_id", "quality"), "doc_id")
    points = sorted({(2 * i + 1) / (2 * EDGES) for i in range(EDGES)} | set(TAILS) | {1 - x for x in TAILS})
    found = rows.groupBy("quality").agg(F.count("*").alias("n"), *(F.percentile_approx(f, points, 2_000).alias(f) for f in names)).collect()
    if len(found) < 2:
        return []
    edges = {f: sorted({x for r in found for x in r[f]}) for f in names}
    bins = [sum((F.when(F.col(f) > x, 1).otherwise(0) for x in edges[f]), F.lit(0)).cast("int").alias(f) for f in names]
    bad = (F.col("quality") == 0).cast("int")
    third = F.pmod(F.xxhash64("doc_id", F.lit("prune")), F.lit(3)) == 0
    binned = stage(rows.select(bad.alias("bad"), third.alias("prune"), *bins).groupBy("prune", *names).agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")), "binned")

    def holds(c: Condition) -> Column:
        k = edges[c.feature].index(c.threshold)  # a row's bin counts the edges below it
        return F.col(c.feature) > k if c.above else F.col(c.feature) <= k

    def covers(rule: Rule) -> Column:
        return _all([holds(c) for c in rule])

    rules: list[Rule] = []
    set_aside: list[Rule] = []
    total = next(r.n for r in found if r.quality == 0)
    least = max(LEAST_BAD, LEAST_SHARE * total)
    while True:
        left = binned.where(_all([~covers(r) for r in rules]))
        growing = left.where("not prune").where(_all([~covers(r) for r in set_aside]))
        rule = _grow(growing, names, edges, covers, least)
        if not rule:
            return rules
        tails = [rule[:k] for k in range(1, len(rule) + 1)]
        held = left.where("prune").agg(*(F.coalesce(F.sum(F.when(covers(t), F.col(c))), F.lit(0)).alias(f"{c}{k}") for k, t in enumerate(tails) for c in ("bad", "good"))).first()
        worth = [((held[f"bad{k}"] - held[f"good{k}"]) / max(1, held[f"bad{k}"] + held[f"good{k}"]), -k) for k in range(len(tails))]
        k = -max(worth)[1]
        if held[f"bad{k}"] < least / 2 or held[f"bad{k}"] < LEAST_PRECISION * (held[f"bad{k}"] + held[f"good{k}"]):
            set_aside.append(rule)
        else:
            rules.append(tails[k])


def _grow(rows: DataFrame, names: list[str], edges: dict[str, list[float]], covers, least: float) -> Rule:
    """Add the condition of greatest gain until no good document is covered or nothing is gained.

    Every condition leaves ``least`` bad documents covered. A rule that ends below the
    precision asked for is none.
    """
    rule: Rule = ()
    while True:
        cells = F.explode(F.array(*(F.struct(F.lit(i).alias("f"), F.col(f).alias("bin")) for i, f in enumerate(names))))
        counts = rows.where(covers(rule)).select("bad", "good", cells.alias("c")).groupBy("c.f", "c.bin").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect()
        bad, good = (sum(r[c] for r in counts if r.f == 0) for c in ("bad", "good"))
        best = None
        if bad and good:
            before = math.log2(bad / (bad + good))
            for i, f in enumerate(names):
                cell = {r.bin: (r.bad, r.good) for r in counts if r.f == i}
                low_bad = low_good = 0
                for k, x in enumerate(edges[f]):
                    b, g = cell.get(k, (0, 0))
                    low_bad, low_good = low_bad + b, low_good + g
                    for above, p, q in ((False, low_bad, low_good), (True, bad - low_bad, good - low_good)):
                        gain = p * (math.log2(p / (p + q)) - before) if p >= least else 0.0
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, Condition(f, above, x))
        if best is None or best[1] in rule:
            return rule if bad >= LEAST_PRECISION * (bad + good) else ()
        rule = (*rule, best[1])


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """``stats`` with base_failed, the rule that rejected, and kept."""
    df = stats.withColumn("base_failed", base_failed()).withColumn("rule", F.when(~F.col("base_failed"), verdict(rules)))
    return df.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every document; the statistics are counted once and staged."""
    stats = stage(statistics(docs.select("doc_id", "text")), "statistics")
    return judged(stats, learn(stats, labels)).select("doc_id", *COUNTS, "base_failed", "kept", "rule")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, all their columns unchanged.

    Rows and statistics are staged side by side: learning reads only the numbers, and the
    filter then reads the rows back without a join.
    """
    whole = stage(statistics(docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))), "statistics")
    rules = learn(whole.drop("_row"), labels)
    return judged(whole, rules).where("kept").select("_row.*")

"""Repeated passages against a plain search over all documents."""

import random

from townpulse.llm import substring_dedup as s

SCHEMA = "doc_id long, text string, removed string, row int"


def sentence(draw, n):
    words = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(n)]
    return " ".join([words[0].capitalize(), *words[1:]]) + "."


def test_planted_passages_go(spark):
    draw = random.Random(9)
    passage = " ".join(sentence(draw, n) for n in (15, 3, 20, 4, 13, 2))
    line = sentence(draw, 14)
    docs, clean = [], {}
    for i in range(40):
        before, after = " ".join(sentence(draw, draw.randint(1, 20)) for _ in range(5)), " ".join(sentence(draw, draw.randint(1, 20)) for _ in range(5))
        if i % 4 == 0:
            text = before + " " + passage + " " + after
        elif i % 4 == 1:  # in the middle of a sentence, with other white space
            text = before + f" and{i} then " + passage.replace(" ", "  ", 9) + " so on " + after
        elif i % 4 == 2:
            text = before + "\n" + line + "\n" + after
        else:
            text = clean[i] = before + " " + after
        docs.append((i, text, "clash", i))
    docs += [(100, docs[3][1], None, 1), (101, None, None, 1), (102, "", None, 1), (None, passage + " " + passage, None, 1), (103, "Short. Short. Short.", None, 1), (3, docs[3][1], "same id", 1)]
    got = s.deduplicate(spark.createDataFrame(docs, SCHEMA).repartition(3)).collect()
    assert len(got) == len(docs)
    texts, originals = {r.doc_id: r for r in got}, {d[0]: d[1] for d in docs}
    joined = lambda t: " ".join(t.lower().split())
    for i in range(40):
        for planted, kinds, first in ((passage, (0, 1), 0), (line, (2,), 2)):
            if i % 4 in kinds:
                assert (joined(planted) in joined(texts[i].text)) == (i == first), i
                assert not any(joined(p) in joined(texts[i].text) for p in planted.split(". ") if len(p.split()) > 12) or i == first
        if i in clean:
            assert texts[i].text == clean[i] and texts[i].removed == []
        spans = [(x.start, x.end) for x in texts[i].removed]
        assert s.without(originals[i], spans) == texts[i].text
        assert i % 4 in (1, 3) or i in (0, 2) or len(originals[i]) - len(texts[i].text) == len(passage if i % 4 == 0 else line) + 1
    assert "and5 then so on" in texts[5].text
    assert texts[100].text == "" and texts[101].text is None and texts[102].text == ""
    assert texts[None].text.strip() == passage and texts[103].text == "Short. Short. Short."
    assert all(r.text == clean[3] for r in got if r.doc_id == 3)


def test_first_document_wins_by_brute_force(spark):
    draw = random.Random(4)
    pool = [sentence(draw, draw.choice([1, 2, 5, 12, 15])) for _ in range(25)]
    docs = [(i, draw.choice([" ", "\n"]).join(draw.choice(pool) for _ in range(draw.randint(0, 12)))) for i in range(60)]
    first = {}
    for i, text in docs:
        for u in s.units(text):
            first.setdefault(u[0], i)
    want = {i: s.without(t, s.cut(t, {u[0] for u in s.units(t) if first[u[0]] < i})) for i, t in docs}
    got = s.deduplicate(spark.createDataFrame(docs, "doc_id long, text string").repartition(7))
    assert {r.doc_id: r.text for r in got.collect()} == want
    assert s.deduplicate(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_text():
    text = " ".join(["word"] * 300_000)
    assert s.cut(text, set()) == [] and s.cut(text + ". " + text + ".", set())[0][1] == 2 * len(text) + 3


def test_short_lines_go_whatever_their_neighbours(spark):
    line, short = "Released under the MIT License.", "Rights reserved. All of them."
    texts = [f"First words here {i}\n{line}\nother words {i} follow\n}}\n\n{short}" for i in range(4)]
    texts += [line, f"{line} And more in the same line 5", f"{short}\nnew\n{short}"]
    got = {r.doc_id: r.text for r in s.deduplicate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)).collect()}
    assert got[0] == texts[0]
    assert all(got[i] == f"First words here {i}\nother words {i} follow\n}}\n\n" for i in (1, 2, 3))
    assert got[4] == "" and got[5] == texts[5] and got[6] == "new\n"

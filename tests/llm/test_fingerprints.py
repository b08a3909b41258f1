"""Fingerprints against plain string comparison."""

import hashlib
import random

import pytest

from townpulse.llm import fingerprints as fp


def test_spans_and_extensions_agree_with_strings():
    draw = random.Random(5)
    for _ in range(300):
        a, b = ("".join(draw.choice("abé😀") for _ in range(draw.randint(1, 40))) for _ in range(2))
        x, y = fp.Prefixes(a), fp.Prefixes(b)
        i, j = draw.randrange(len(a)), draw.randrange(len(b))
        n = draw.randint(0, min(len(a) - i, len(b) - j))
        assert (x.span(i, i + n) == y.span(j, j + n)) == (a[i:i + n] == b[j:j + n])
        want = next((k for k in range(min(len(a) - i, len(b) - j)) if a[i + k] != b[j + k]), min(len(a) - i, len(b) - j))
        assert fp.common_extension(x, i, y, j) == want
        ends = next((k for k in range(min(len(a), len(b))) if a[-1 - k] != b[-1 - k]), min(len(a), len(b)))
        assert fp.common_suffix(x, y) == ends


def windows(text):
    return {text[i:i + fp.WINDOW] for i in range(max(1, len(text) - fp.WINDOW + 1))} if text else set()


def test_likeness_estimates_common_windows():
    draw = random.Random(6)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    for share in (0.0, 0.3, 0.75, 1.0):
        common = " ".join(word() for _ in range(int(600 * share)))
        a, b = (common + " ".join(word() for _ in range(int(600 * (1 - share)))) for _ in range(2))
        got = fp.likeness(*(fp.fingerprint(fp.Prefixes(t)) for t in (a, b)))
        x, y = windows(a), windows(b)
        assert abs(got - 2 * len(x & y) / (len(x) + len(y))) < 0.12
    one = fp.fingerprint(fp.Prefixes("abc" * 3000))
    assert len(one[1]) == 3 and fp.likeness(one, fp.parsed(one[0])) == 1.0


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_every_document_meets_its_successor(spark, ranges):
    draw = random.Random(ranges)
    rows = [(i, "".join(draw.choice("ab é\n") for _ in range(draw.choice([0, 1, 5, 80, 4000])))) for i in range(0, 150, 3)]
    rows += [(4, None), (5, ""), (7, rows[3][1]), (8, rows[3][1]), (9, "again"), (9, "again"), (None, "without id")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fingerprint string").repartition(5)
        got = fp.fingerprints(docs).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for (i, t), (_, u) in zip(rows, [*rows[1:], rows[0]]):
        cut = len(t) // 4
        edited = t[:len(t) - cut] + u[:cut]
        a, b, c = (fp.fingerprint(fp.Prefixes(x)) for x in (t, edited, u))
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), a[0], b[0], fp.likeness(a, b), fp.likeness(a, c)))
    assert sorted(map(repr, (tuple(r)[:7] for r in got))) == sorted(map(repr, want))


def test_one_row_and_none(spark):
    schema = "doc_id long, text string"
    assert fp.fingerprints(spark.createDataFrame([], schema)).count() == 0
    row, = fp.fingerprints(spark.createDataFrame([(1, "abcdefgh")], schema)).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and row.near_next == 1.0

"""Surrogates: nothing personal is left, formats and identities are kept."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from townpulse.llm import surrogates as s

CARD, NO_CARD = "4111111111111111", "4111111111111112"
TEXTS = [
    "Mail und.34@mail7.example.com or Größe.9@mail1.example.com, call +1 (017) 555-7713 or +44 20 7946 0958.",
    f"Cards {CARD}!! and {NO_CARD}; 4111 1111 1111 1111. From 97.51.17.173*** not 1.2.3 or 300.1.1.1 or 1.2.3.4.5",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" password=Abcd1234Efgh5678Z and again und.34@mail7.example.com',
    "Mrs. Jane Doe met Mr Smith-Jones and Госпожа Анна Каренина; Jane Doe left. Frau Müller too.",
    "Nothing here, 12 words.", "", None, "9" * 16 + " " + CARD + " " + CARD,
]
DOCS = [(i, t, "en", "clash", 5) for i, t in enumerate(TEXTS)] + [(None, TEXTS[0], "en", None, 5), (1, TEXTS[1], "en", "x", 5), (1, TEXTS[1], "en", "x", 5)]
SCHEMA = "doc_id long, text string, lang string, entity string, surrogates int"


def luhn(digits):
    d = [int(c) for c in digits if c.isdigit()][::-1]
    return sum(d[::2] + [sum(divmod(2 * x, 10)) for x in d[1::2]]) % 10 == 0


def shape(text):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "9", text)))


def test_texts(spark):
    df = s.replace(spark.createDataFrame(DOCS, SCHEMA))
    assert df.columns == ["doc_id", "text", "lang", "entity", "surrogates", "n_entities"]
    rows = df.collect()
    assert len(rows) == len(DOCS)
    got = {r.doc_id: r for r in rows}
    assert [got[i].n_entities for i in range(8)] == [4, 3, 3, 5, 0, 0, 0, 2]
    assert got[4].text == TEXTS[4] and got[5].text == "" and got[6].text is None
    for private in ("und.34@", "Größe.9@", "555-7713", "7946 0958", CARD, "4111 1111 1111 1111", "97.51.17.173", "04dbebab", "Abcd1234", "Mrs. Jane", "Smith-Jones", "Анна", "Müller"):
        assert not any(private in (r.text or "") for r in rows), private
    for public in (NO_CARD, "1.2.3 ", "300.1.1.1", "1.2.3.4.5"):
        assert public in got[1].text
    assert got[None].text == got[0].text
    mail = re.search(r"\S+@\S+", got[0].text)[0]
    assert mail in got[2].text and shape(mail.split("@")[0]) == "aaa.99" and mail.endswith(".example.org")
    card, spaced = re.search(r"Cards (\d+)!!", got[1].text)[1], re.search(r"; ([\d ]+)\. From", got[1].text)[1]
    assert luhn(card) and len(card) == 16 and card[0] == "4" and luhn(spaced) and shape(spaced) == "9999 9999 9999 9999"
    assert got[7].text == "9" * 16 + f" {card} {card}"
    assert shape(re.search(r"From ([\d.]+)\*", got[1].text)[1]) == "99.99.99.999"
    assert re.search(r"call \+1 \(\d{3}\) \d{3}-\d{4} or \+44 \d\d \d{4} \d{4}\.", got[0].text)
    assert re.search(r'token = "[0-9a-f]{40}" ', got[2].text)
    first, last = re.search(r"Mrs\. (\w+) (\w+) met", got[3].text).groups()
    assert first in s.NAMES["f", "latin"] and last in s.FAMILY["latin"] and f"; {first} {last} left" in got[3].text and "Jane Doe" not in got[3].text
    cyrillic = re.search(r"Госпожа (\w+) (\w+);", got[3].text).groups()
    assert cyrillic[0] in s.NAMES["f", "cyrillic"] and cyrillic[1] in s.FAMILY["cyrillic"]
    assert {r.text for r in s.replace(spark.createDataFrame(DOCS, SCHEMA), key="another").collect()} != {r.text for r in rows}


def test_crowded_formats_stay_distinct(spark):
    addresses = [f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in (1, 2)]
    names = [f"Mr {a} {b}" for a in ("Aba", "Bob", "Cec", "Dod", "Efe") for b in "Xa Xb Xc Xd Xe Xf Xg Xh Xi Xj".split()]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(addresses + names)], "doc_id long, text string")
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text", s.found_in(F.col("text")).alias("found"))
    given = s.assign(s.mentions(texts)).collect()
    assert len(given) == len(addresses) + len(names) == len({r.surrogate for r in given})
    assert not {r.surrogate for r in given} & {r.entity for r in given}


def test_empty_and_native(spark):
    df = s.replace(spark.createDataFrame([], SCHEMA))
    assert df.count() == 0
    plan = s.replace(spark.createDataFrame(DOCS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_later_mentions_of_a_name_corefer(spark):
    texts = [
        "Mr. John Smith came. Later Mr. Smith and John left; Smith's hat, Smithson and smith stayed. John Smith!",
        "Mrs. Jane Doe met Mr Smith-Jones; Jane Doe left. Doe\nslept.",
        "Mrs. Ann Kerr and Mr. Tom Kerr; Mr. Kerr sat. Ann stood.",
        "Nobody named: Smith, John Smith.",
    ]
    got = {r.doc_id: r for r in s.replace(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    first, last = re.match(r"Mr\. (\w+) (\w+) came", got[0].text).groups()
    assert got[0].text == f"Mr. {first} {last} came. Later Mr. {last} and {first} left; {last}'s hat, Smithson and smith stayed. {first} {last}!"
    assert got[0].n_entities == 5 and {first, last} & {"John", "Smith"} == set()
    first, last = re.match(r"Mrs\. (\w+) (\w+) met", got[1].text).groups()
    assert f"; {first} {last} left. {last}\nslept." in got[1].text and "Jane" not in got[1].text and "Doe" not in got[1].text
    ann, tom, family = re.match(r"Mrs\. (\w+) \w+ and Mr\. (\w+) (\w+);", got[2].text).groups()
    assert got[2].text.endswith(f"; Mr. {family} sat. {ann} stood.")
    assert got[3].text == texts[3] and got[3].n_entities == 0


def test_long_and_national_forms_go_whole(spark):
    long, local = "aB3" * 200, "x" * 80
    texts = [
        f'token = "{long}" end', "token=" + "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSMeK" + " end", 'password = "Abc.12" password=hunter22 end',
        f"Write to {local}@mail.example.com or _ann@mail.example.com end", "Call (212) 555-0100, 212-555-0100, 212.555.0100 or 030 1234567 end",
        'secret = "4111111111111112" and 4111111111111112 end', 'token = "short" 1.2.3.4.5 2024-01-15 10.5 2001 20012 end',
    ]
    got = {r.doc_id: r for r in s.replace(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i].n_entities for i in range(7)] == [1, 1, 2, 2, 4, 1, 0] and got[6].text == texts[6]
    for i, private in ((0, long[-20:]), (1, "eyJzdWI"), (1, "SflKxw"), (2, "Abc.12"), (2, "hunter22"), (3, "xxxx"), (3, "_ann@"), (4, "555"), (4, "1234567"), (5, '"4111111111111112"')):
        assert private not in got[i].text, (i, private)
    assert shape(got[0].text) == shape(texts[0]) and shape(got[1].text)[6:] == shape(texts[1])[6:] and got[1].text.startswith("token=")
    assert shape(got[4].text) == shape(texts[4]) and " or 0" in got[4].text and got[5].text.endswith('" and 4111111111111112 end')


def _salt(key, kind, entity, round_no):
    base = "\0".join([key, kind, entity.lower(), str(round_no)])
    return "".join(hashlib.sha256(f"{base}\0{i}".encode()).hexdigest() for i in range(4))


def _same_kind(text, salt):
    groups, out = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ"), ""
    for i, c in enumerate(text):
        letters = next((g for g in groups if c in g), c)
        out += letters[int(salt[i % 120 * 2:][:2], 16) % len(letters)]
    return out


def _plain_surrogate(kind, entity, gender, salt):
    number = lambda i: int(salt[2 * i:2 * i + 2], 16)
    pick = lambda names, i: names[int(salt[6 * i:6 * i + 6], 16) % len(names)]
    if kind == "email":
        return f"{_same_kind(entity.split('@')[0], salt)}@mail{number(100) % 10}.example.org"
    if kind == "ip":
        return ".".join(str((1 + number(i) % 9, 10 + number(i) % 90, 100 + number(i) % 156)[len(x) - 1]) for i, x in enumerate(entity.split(".")))
    if kind == "phone":
        n = len(entity.split(" ")[0]) if entity[0] == "+" else int(entity[0] == "0")  # a leading zero stays, like a country code
        return entity[:n] + _same_kind(entity[n:], salt)
    if kind == "card":
        issued = entity[0] + _same_kind(entity[1:-1], salt)
        return next(issued + c for c in "0123456789" if luhn(issued + c))
    if kind == "name":
        parts = entity.split(" ")
        firsts = [pick(s.NAMES[gender, "latin"], 2 * i) for i in range(len(parts) - 1)]
        return " ".join([*firsts, pick(s.FAMILY["latin"], 2 * len(parts) - 2)])
    return _same_kind(entity, salt)


def _plain_assignment(entities, key):
    """Rounds over all entities at once: a surrogate goes to the smallest entity that drew it, unless it is an entity or was given."""
    given, left, own = {}, dict(entities), {e for _, e in entities}
    for round_no in range(s.WIDER):
        drawn = {(k, e): _plain_surrogate(k, e, g, _salt(key, k, e, round_no)) for (k, e), g in left.items()}
        first, taken = {}, set(given.values())
        for (_, e), new in drawn.items():
            first[new] = min(first.get(new, e), e)
        for (k, e), new in drawn.items():
            if new not in own and new not in taken and first[new] == e:
                given[k, e] = new
                del left[k, e]
    assert not left
    return given


def _corpus(draw):
    """Texts as lists of parts: plain strings, or (kind, entity, gender) of what a reader would call personal."""
    digits = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    hexes = lambda n: "".join(draw.choice("0123456789abcdef") for _ in range(n))
    people = [(f"{a} {b}", g) for a, g in (("Bob", "m"), ("Jim", "m"), ("Sue", "f"), ("Kim", "f")) for b in "Hill Ford Lake Wood Dale Marsh Brook".split()]
    card = lambda: next(c for c in iter(lambda: "4" + digits(15), "") if luhn(c))
    makers = [
        lambda: [("email", f"{draw.choice(('ann', 'bob', 'xyzzy'))}.{digits(2)}@mail{digits(1)}.example.com", "")],
        lambda: [("phone", f"+{draw.choice((1, 44, 380))} ({digits(3)}) {digits(3)}-{digits(4)}", "")], lambda: [("phone", f"{digits(3)}-{digits(3)}-{digits(4)}", "")],
        lambda: [("ip", ".".join(str(draw.randint(1, 255)) for _ in range(4)), "")], lambda: [("card", card(), "")],
        lambda: ['token = "', ("secret", hexes(40), ""), '"'], lambda: ["password=", ("secret", "Pw" + hexes(6), "")],
        lambda: ["in 2001 or 1.2.3 or Hill"], lambda: ["@ 12 token"], lambda: [""], lambda: ["ünï \n\t 日本"],
    ]
    shared = [maker() for maker in makers for _ in range(6)]
    for i in range(120):
        parts = ["start"]
        person, gender = draw.choice(people)
        named = draw.random() < 0.5
        if named:
            parts += [f" and {'Mr.' if gender == 'm' else draw.choice(('Mrs', 'Ms.'))} ", ("name", person, gender)]
        for _ in range(3_000 if i == 7 else draw.randint(0, 6)):
            made = draw.choice(shared) if draw.random() < 0.6 else draw.choice(makers)()
            if named and draw.random() < 0.4:
                made = [draw.choice([("name", person, gender), ("first", person, gender), ("last", person, gender)])]
            if named:  # the family name stands in a plain part as well
                made = [x.replace(" or Hill", "") if isinstance(x, str) else x for x in made]
            parts += [" and ", *made]
        yield parts + [" end"]


def test_a_random_corpus_equals_plain_search_assignment_and_replacement(spark):
    texts = list(_corpus(random.Random(21)))
    shown = {"first": lambda name: name.split(" ")[0], "last": lambda name: name.split(" ")[-1]}
    plain = ["".join(x if isinstance(x, str) else shown.get(x[0], str)(x[1]) for x in parts) for parts in texts]
    entities = {("name" if k in shown else k, e): g for parts in texts for k, e, g in (x for x in parts if not isinstance(x, str))}
    given = _plain_assignment(entities, "k")
    want = [(
        i, "".join(x if isinstance(x, str) else shown.get(x[0], str)(given["name" if x[0] in shown else x[0], x[1]]) for x in parts),
        sum(not isinstance(x, str) for x in parts),
    ) for i, parts in enumerate(texts)]
    docs = spark.createDataFrame(list(enumerate(plain)), "doc_id long, text string")
    for partitions in (1, 7):
        got = s.replace(docs.repartition(partitions), key="k").orderBy("doc_id").collect()
        for row, expected in zip(got, want, strict=True):
            at = next((j for j, (a, b) in enumerate(zip(row.text, expected[1])) if a != b), 0)
            assert tuple(row) == expected, (row.text[at - 60:at + 60], expected[1][at - 60:at + 60], plain[expected[0]].count("x"))

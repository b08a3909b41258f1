"""Personal data: detection and keyed surrogates, with built-in functions only.

Detected are e-mail addresses, phone numbers (with a country code, or in the national forms
(212) 555-0100, 212-555-0100 with dots or spaces as well, 030 1234567), IPv4 addresses,
payment card numbers of 13 to 19 digits that pass the Luhn check, secrets assigned to a name
(``token = "..."``, ``token=...``) up to the closing quote or white space, from 16 characters
on, passwords from 4 on, and names behind a title of known gender. Not found are shorter
secrets, and phone numbers in one block of digits without a country code. Each different entity of the corpus gets one surrogate, so mentions
stay together: the same entity reads the same everywhere, different ones stay different.

In a text with a titled name every whole-word mention of it or of one of its parts is
replaced, titled or not. A family name alone is linked to a fuller name of the same text
and takes its surrogate's family name; where a text has no fuller name, it is an entity of
its own. Links do not reach beyond a text. Two people of one text may draw the same family
name, so their bare family names may read alike; whole names never do. A name that no
title introduces in its text is not found.

A surrogate keeps type and format: letters become letters of the same case, digits digits,
separators stay; octets stay below 256, cards keep issuer digit, length and Luhn check,
phone numbers their country code, mail addresses go to a reserved domain. Names are drawn
from a list of the title's gender in the name's script. Everything is drawn from SHA-256
over key, kind, entity and a round number. A surrogate that another entity also drew, or
that itself occurs in the corpus, loses to the smallest entity in order and is drawn again
in the next round, until none collide.

Nulls and ties: a null text stays null, an empty one empty. Rows are matched by their
text, so null ids and repeated rows need no care. Other columns stay as they are; the
result has ``docs``' columns and ``n_entities``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpulse.session import stage

KEY = "surrogates"

#: Names by gender and script; titles tell the gender.
NAMES = {
    ("f", "latin"): "Alice Amelia Anna Beatrice Carla Clara Diana Elena Emma Fiona Greta Hannah Helen Irene Iris Julia Karen Laura Lena Louise Maria Martha Nina Nora Olivia Paula Rita Rosa Sara Silvia Sonia Teresa Vera".split(),
    ("m", "latin"): "Adam Albert Anton Arthur Boris Bruno Carl Daniel David Edgar Emil Eric Felix Frank George Henry Hugo Ivan Jonas Julian Karl Leo Lucas Marco Martin Max Nicolas Oscar Otto Paul Peter Robert Simon Victor".split(),
    ("f", "cyrillic"): "Анна Вера Галина Дарья Елена Ирина Лидия Мария Нина Ольга Полина Раиса Софья Тамара Юлия".split(),
    ("m", "cyrillic"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Сергей".split(),
}
FAMILY = {
    "latin": "Adler Bauer Becker Bell Bishop Brandt Carter Costa Dumont Ellis Fischer Fontaine Garcia Graham Hansen Hoffman Keller Lambert Larsen Lopez Marin Mercier Moreau Navarro Olsen Parker Reyes Roth Santos Vidal Weber Winter Young Zimmer".split(),
    "cyrillic": "Алмазов Берёзов Волков Горин Дубов Ежов Зимин Исаев Котов Лебедев Морозов Орлов Петров Соколов".split(),
}
TITLES = {"f": "Mrs|Ms|Miss|Madame|Mme|Frau|Señora|Sra|Госпожа", "m": "Mr|Sir|Monsieur|Herr|Señor|Sr|Господин"}

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
NAME = r"\p{Lu}\p{Ll}+(?:[ -]\p{Lu}\p{Ll}+){0,2}"
#: What assigns a secret; it is part of the match, so that the kind does not hang on the value's shape.
ASSIGNED = r'(?i:\b(?:token|key|secret|password) = "|\b(?:token|api_key|password)=)'
#: Without country code: (212) 555-0100, 212-555-0100, 030 1234567.
NATIONAL = r"\([0-9]{2,5}\)[ -]?[0-9]{3,4}[ -]?[0-9]{3,4}|[0-9]{3}([-. ])[0-9]{3}\1[0-9]{4}|0[0-9]{1,4}[ /-][0-9]{5,8}"
_LOCAL = NATIONAL.replace("([-. ])", "(?<gap>[-. ])").replace(r"\1", r"\k<gap>")
#: kind -> pattern; the first that matches at a place wins.
PATTERNS = {
    "secret": r'(?i:\bpassword = ")[^"\r\n]{4,}+|(?i:\b(?:token|key|secret) = ")[^"\r\n]{16,}+|(?i:\bpassword=)[^\s"]{4,}+|(?i:\b(?:token|api_key)=)[^\s"]{16,}+',
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}",
    "phone": rf"(?<![0-9A-Za-z+])\+[0-9]{{1,3}}[ -]?(?:\([0-9]{{1,4}}\)[ -]?)?[0-9]{{2,4}}(?:[ -][0-9]{{2,4}}){{1,4}}(?![0-9])|(?<![0-9A-Za-z+]|[0-9][ .-])(?:{_LOCAL})(?![0-9A-Za-z]|[ .-][0-9])",
    "ip": rf"(?<![0-9.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z-])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9A-Za-z-])",
    "name": "|".join(rf"(?<=\b(?:{t})\.? ){NAME}" for t in TITLES.values()),
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: No entity is without one of these, and looking for them costs little.
HINT = r"@|[0-9]{2}|[0-9]\.[0-9]|(?i:token|key|secret|password)|(?:" + "|".join(TITLES.values()) + r")\b"
#: From this round on a format may grow, as it may hold fewer values than the corpus has entities.
WIDER = 6
MOST_ROUNDS = 64


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    each = F.transform(F.reverse(F.split(digits, "")), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise((2 * d.cast("int")) % 10 + F.floor(2 * d.cast("int") / 10).cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, b: a + b) % 10 == 0


def kind_of(match: Column) -> Column:
    """The kind of a match; null if it is none after all (a number that is no card)."""
    digits = F.regexp_replace(match, "[ -]", "")
    kind = F.when(match.rlike(f"^{ASSIGNED}"), "secret").when(match.contains("@"), "email")
    kind = kind.when(match.startswith("+") | match.rlike(f"^(?:{NATIONAL})$"), "phone").when(match.rlike(rf"^{PATTERNS['ip']}$"), "ip")
    kind = kind.when(match.rlike(r"^[0-9][0-9 -]*$"), F.when(digits.rlike("^[0-9]{13,19}$") & luhn(digits), "card"))
    return kind.otherwise("name")


def value_of(match: Column) -> Column:
    """A match without what assigns it."""
    return F.regexp_replace(match, f"^{ASSIGNED}", "")


def _draw(salt: Column, i: Column | int, n: int) -> Column:
    """A number below ``n`` from the ``i``-th pair of hex digits of a digest string."""
    at = (i if isinstance(i, Column) else F.lit(i)) * 2 + 1
    return F.conv(F.substring(salt, at, F.lit(2)), 16, 10).cast("int") % n


def _each(text: Column, salt: Column) -> Column:
    """Letters to letters of the same case, digits to digits, the rest as it is."""
    def letter(c: Column, i: Column) -> Column:
        draw = F.conv(F.substring(salt, i % 120 * 2 + 1, F.lit(2)), 16, 10).cast("int")
        pick = lambda letters, n: F.substring(F.lit(letters), draw % n + 1, F.lit(1))
        return F.when(c.rlike("[0-9]"), pick("0123456789", 10)).when(c.rlike("[a-f]"), pick("abcdef", 6)).when(c.rlike("[g-z]"), pick("ghijklmnopqrstuvwxyz", 20)).when(c.rlike("[A-F]"), pick("ABCDEF", 6)).when(c.rlike("[G-Z]"), pick("GHIJKLMNOPQRSTUVWXYZ", 20)).when(
            c.rlike(r"\p{IsCyrillic}"), F.when(c == F.lower(c), pick("абвгдежзиклмнопрстуфхцчшэюя", 27)).otherwise(pick("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ", 27))
        ).when(c.rlike(r"\p{Ll}"), pick("abcdefghijklmnopqrstuvwxyz", 26)).when(c.rlike(r"\p{Lu}"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 26)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), letter), "")


def _octet(text: Column, draw: Column) -> Column:
    """An octet with as many digits."""
    n = F.length(text)
    return F.when(n == 1, 1 + draw % 9).when(n == 2, 10 + draw % 90).otherwise(100 + draw % 156).cast("string")


def surrogate(kind: Column, entity: Column, salt: Column, gender: Column, round_no: int = 0) -> Column:
    """The replacement of ``entity``; ``salt`` is its digest of 240 or more hex digits.

    Late rounds draw from wider formats: longer local parts and secrets, an extension behind
    a phone number, 19 digits for a card, an IPv6 address reserved for documentation, one
    more family name for each further round.
    """
    more = F.substring(salt, 201, 24) if round_no >= WIDER else F.lit("")
    local = F.substring_index(entity, "@", 1)
    email = F.concat(_each(local, salt), more, F.lit("@mail"), _draw(salt, 100, 10).cast("string"), F.lit(".example.org"))
    ip = F.array_join(F.transform(F.split(entity, r"\."), lambda x, i: _octet(x, _draw(salt, i, 256))), ".")
    if round_no >= WIDER:
        ip = F.concat(F.lit("2001:db8"), *(F.concat(F.lit(":"), F.substring(salt, 201 + 4 * i, 4)) for i in range(6)))
    country = F.regexp_extract(entity, r"^(?:\+[0-9]{1,3}|0)", 0)
    phone = F.concat(country, _each(F.expr("substring(entity, length(regexp_extract(entity, '^([+][0-9]{1,3}|0)', 0)) + 1)"), salt))
    if round_no >= WIDER:
        phone = F.concat(phone, F.lit(" x"), F.translate(more, "abcdef", "012345"))
    issued = F.concat(F.substring(entity, 1, 1), _each(F.expr("substring(entity, 2, length(entity) - 2)"), salt))
    if round_no >= WIDER:
        issued = F.concat(F.substring(entity, 1, 1), F.translate(F.substring(salt, 201, 17), "abcdef", "012345"))
    check = F.array_max(F.filter(F.transform(F.sequence(F.lit(0), F.lit(9)), lambda d: F.when(luhn(F.concat(F.regexp_replace(issued, "[ -]", ""), d.cast("string"))), d)), lambda d: d.isNotNull()))
    card = F.concat(issued, check.cast("string"))
    return F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "card", card).when(kind == "name", _name(entity, salt, gender, round_no)).otherwise(F.concat(_each(entity, salt), more))


def _name(entity: Column, salt: Column, gender: Column, round_no: int) -> Column:
    """As many name parts as there were, with the same separators; the last of several is a family name."""
    def pick(names: list[str], i: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, names)), F.conv(F.substring(salt, i * 6 + 1, F.lit(6)), 16, 10).cast("int") % len(names) + 1)

    parts = F.split(entity, "(?<=[ -])|(?=[ -])")

    def part_of(script: str) -> Callable[[Column, Column], Column]:
        def part(x: Column, i: Column) -> Column:
            first = F.when(gender == "f", pick(NAMES["f", script], i)).otherwise(pick(NAMES["m", script], i))
            last = (i > 0) & (i == F.size(parts) - 1) | (F.size(parts) == 1)
            return F.when(x.rlike("^[ -]$"), x).when(last, pick(FAMILY[script], i)).otherwise(first)

        return part

    out = None
    for script, own in (("cyrillic", r"\p{IsCyrillic}"), ("latin", r".")):
        value = F.concat(F.array_join(F.transform(parts, part_of(script)), ""), *(F.concat(F.lit("-"), pick(FAMILY[script], F.lit(20 + i))) for i in range(max(0, round_no - WIDER + 1))))
        out = F.when(entity.rlike(own), value) if out is None else out.otherwise(value)
    return out


def found_in(text: Column) -> Column:
    """All matches in order; texts without a hint are not searched."""
    none = F.array().cast("array<string>")
    return F.coalesce(F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))), none)


def mentions(texts: DataFrame) -> DataFrame:
    """Each different entity of each different text of ``texts`` (text_key, text, found): text_key, kind, entity, gender."""
    found = texts.where(F.size("found") > 0).select("text_key", F.col("text").alias("t"), F.explode(F.array_distinct("found")).alias("match"))
    found = found.withColumns({"kind": kind_of(F.col("match")), "entity": value_of(F.col("match"))})
    female = F.expr(  # the title stands before the name
        "t rlike concat('\\\\b(?:" + TITLES["f"] + ")[.]? ', regexp_replace(entity, '([^\\\\p{L}])', '[$1]'))"
    )
    rows = found.where("kind is not null")
    gender = F.when(F.col("kind") != "name", F.lit("")).when(female, "f").otherwise("m")
    return rows.select("text_key", "kind", "entity", gender.alias("gender")).distinct()


def assign(mentioned: DataFrame, key: str = KEY) -> DataFrame:
    """One surrogate per entity: kind, entity, surrogate, all different and none of them an entity."""
    def drawn(rows: DataFrame, round_no: int) -> DataFrame:
        base = F.concat_ws("\x00", F.lit(key), "kind", F.lower("entity"), F.lit(str(round_no)))
        salt = F.concat(*(F.sha2(F.concat(base, F.lit(f"\x00{i}")), 256) for i in range(4)))
        return rows.withColumn("salt", salt).withColumn("surrogate", surrogate(F.col("kind"), F.col("entity"), F.col("salt"), F.col("gender"), min(round_no, WIDER + 15))).drop("salt")

    entities = stage(mentioned.groupBy("kind", "entity").agg(F.min("gender").alias("gender")), "entities")
    taken, left, done = None, entities, []
    for round_no in range(MOST_ROUNDS):
        new = stage(drawn(left, round_no), f"draw{round_no}")
        # a row per surrogate: the first entity has it, unless it is an entity or was given before
        winners = new.groupBy("surrogate").agg(F.min("entity").alias("entity"))
        winners = winners.join(entities.select(F.col("entity").alias("surrogate")).distinct(), "surrogate", "left_anti")
        if taken is not None:
            winners = winners.join(taken, "surrogate", "left_anti")
        good = stage(new.join(winners, ["surrogate", "entity"], "left_semi").select("kind", "entity", "surrogate"), f"given{round_no}")
        done.append(good)
        left = new.select("kind", "entity", "gender").join(good, ["kind", "entity"], "left_anti")
        taken = good.select("surrogate") if taken is None else taken.union(good.select("surrogate"))
        if left.isEmpty():
            out = done[0]
            for more in done[1:]:
                out = out.union(more)
            return out
    raise RuntimeError(f"surrogates still collide after {MOST_ROUNDS} rounds; the formats leave too few values")


def name_forms(names: Column) -> Column:
    """What the names of one text are called by there, longest first: form, value.

    ``names`` holds entity, surrogate and gender. A form is a whole name or one of its
    parts. A family name alone takes the family name of a fuller name of the text, of its
    own gender if there are several, else the first in order.
    """
    def parts(n: Column) -> Column:
        own = F.split(n["entity"], "[ -]")
        new = F.split(n["surrogate"], "[ -]", F.size(own))  # further family names stay with the last part
        single = F.exists(names, lambda m: (m["entity"] == F.element_at(own, -1)) & (m["gender"] != n["gender"]))
        return F.transform(own, lambda p, i: F.struct(
            F.when(F.size(own) == 1, 3).when(i < F.size(own) - 1, 2).otherwise(single.cast("int")).alias("rank"),
            n["entity"].alias("entity"), p.alias("form"), F.get(new, i).alias("value")))

    whole = F.transform(F.filter(names, lambda n: n["entity"].rlike("[ -]")), lambda n: F.struct(F.lit(-1).alias("rank"), n["entity"].alias("entity"), n["entity"].alias("form"), n["surrogate"].alias("value")))
    every = F.array_sort(F.concat(whole, F.flatten(F.transform(names, parts))))
    forms = F.array_distinct(F.transform(every, lambda f: f["form"]))
    first = F.transform(forms, lambda x: F.struct((-F.length(x)).alias("n"), x.alias("form"), F.get(F.filter(every, lambda f: f["form"] == x), 0)["value"].alias("value")))
    return F.transform(F.array_sort(first), lambda f: F.struct(f["form"].alias("form"), f["value"].alias("value")))


def replace(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with every entity in ``text`` replaced, and ``n_entities``, the number of replaced mentions.

    Texts are searched once; rows and matches are staged side by side. Only texts with a
    match are shuffled, to meet the surrogates of their entities; all others pass straight
    through.
    """
    columns = [c for c in docs.columns if c != "n_entities"]
    text = F.col("text")
    whole = stage(docs.select(F.struct(*columns).alias("row"), F.xxhash64(text).alias("text_key"), found_in(text).alias("found")), "found")
    mentioned = stage(mentions(whole.select("text_key", F.col("row.text").alias("text"), "found")), "mentions")
    given = assign(mentioned, key)
    pairs = mentioned.join(given, ["kind", "entity"]).groupBy("text_key")
    is_name = F.col("kind") == "name"
    per_text = pairs.agg(
        F.map_from_entries(F.collect_set(F.when(~is_name, F.struct(F.concat("kind", F.lit(" "), "entity"), "surrogate")))).alias("surrogates"),
        F.array_sort(F.collect_set(F.when(is_name, F.struct("entity", "surrogate", "gender")))).alias("names"),
    ).select("text_key", "surrogates", name_forms(F.col("names")).alias("forms"))
    rows = whole.where(F.size("found") > 0).join(per_text, "text_key", "left")
    named = F.size("forms") > 0
    pattern = F.when(named, F.concat(F.lit(rf"{ANY}|(?<![\p{{L}}\p{{N}}])(?:"), F.array_join(F.transform("forms", lambda f: f["form"]), "|"), F.lit(r")(?![\p{L}\p{N}])")))
    rows = rows.withColumn("pattern", pattern)
    between = F.when(named, F.split("row.text", F.col("pattern"), -1)).otherwise(F.split("row.text", ANY, -1))
    found = F.when(named, F.regexp_extract_all("row.text", F.col("pattern"), F.lit(0))).otherwise(F.col("found"))
    rows = rows.withColumns({"between": between, "found": found})
    form_of = lambda e: F.get(F.filter("forms", lambda f: f["form"] == e), 0)["value"]
    given_for = lambda e: F.concat(F.regexp_extract(e, f"^{ASSIGNED}", 0), F.try_element_at("surrogates", F.concat(kind_of(e), F.lit(" "), value_of(e))))
    rows = rows.withColumn("values", F.transform("found", lambda e: F.coalesce(given_for(e), form_of(e))))
    new = F.concat(F.get("between", 0), F.array_join(F.transform("found", lambda e, i: F.concat(F.coalesce(F.get("values", i), e), F.get("between", i + 1))), ""))
    count = F.size(F.filter("values", lambda v: v.isNotNull())).cast("long")
    rows = rows.select("row", new.alias("new"), count.alias("n"))
    changed = rows.select(*(F.col("new").alias("text") if c == "text" else F.col(f"row.`{c}`") for c in columns), F.col("n").alias("n_entities"))
    return whole.where(F.size("found") == 0).select("row.*", F.lit(0).cast("long").alias("n_entities")).unionByName(changed)

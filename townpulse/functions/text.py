"""Column expressions over free text and HTML."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from townpulse.constants import NEWS_PATH, NOTICE_SITE, STOP_PHRASES
from townpulse.functions.html import page_parts

#: What tells a listing page that it is not the last.
NEXT_PAGE = "ul.pagination li, div.pagination a"

# Digits and whitespace in the Unicode sense, in a notation that Java and RE2 share.
DIGIT = r"\p{Nd}"
SPACE_CLASS = (
    r"\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
SPACE = f"[{SPACE_CLASS}]"
SPACES = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())

# --- fixed values: rewrites of notice text, applied in this order (pattern, replacement) ---
NOTICE_REWRITES = [
    (rf"({DIGIT}){SPACE}+({DIGIT}){SPACE}*\.{SPACE}*({DIGIT}){SPACE}+({DIGIT})", "$1$2:$3$4"),
    (rf"({DIGIT}{{2}}){SPACE}*\.{SPACE}*({DIGIT}){SPACE}+({DIGIT})", "$1:$2$3"),
    (rf"({DIGIT}){SPACE}*\n{SPACE}*({DIGIT}){SPACE}*\n{SPACE}*\.", "$1$2."),
    (rf"({DIGIT}{{1,2}}){SPACE}*[:.]{SPACE}*({DIGIT}{{2}}){SPACE}*(AM|PM|am|pm)", "$1:$2 $3"),
    (rf"({DIGIT}{{1,2}})\.{SPACE}*({DIGIT}){SPACE}+({DIGIT}){SPACE}+(AM|PM)", "$1:$2$3 $4"),
    (rf"({DIGIT}+){SPACE}*-{SPACE}*({DIGIT}+)", "$1-$2"),
    (r"\n{3,}", "\n\n"),
    (rf"{SPACE}+([,.])", "$1"),
    (rf"([,.]){SPACE}*([^{SPACE_CLASS}])", "$1 $2"),
    (r"[\x{200B}-\x{200F}\x{FEFF}]", ""),
    (r"(Soi)([A-Z])", "$1 $2"),
    (r"(Road)([A-Z])", "$1 $2"),
    (r"([a-z])([A-Z])", "$1 $2"),
    (r" +", " "),
]
# --- end of fixed values ---


def strip(col: Column) -> Column:
    """Trim Unicode whitespace on both ends."""
    return F.btrim(col, F.lit(SPACES))


def is_blank(col: Column) -> Column:
    return col.isNull() | (F.length(strip(col)) == 0)


def _once(text: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a text that is worked out once however often it is named."""
    return F.get(F.transform(F.array(text), use), F.lit(0))


def cut_at_phrase(text: Column, phrase: str) -> Column:
    """Drop the phrase and all after it, unless the text begins with it."""
    return F.when(F.startswith(text, F.lit(phrase)), text).otherwise(F.substring_index(text, phrase, 1))


#: What a text must hold for a rewrite to change it: one of the signs of every list. By the rewrite's place.
_HALVES = ["AM", "PM", "am", "pm"]
REWRITE_SIGNS = {
    0: [["."]], 1: [["."]], 2: [["."], ["\n"]], 3: [_HALVES, [":", "."]], 4: [_HALVES[:2], ["."]], 5: [["-"]], 6: [["\n\n\n"]],
    7: [[",", "."]], 8: [[",", "."]], 9: [["\u200b", "\u200c", "\u200d", "\u200e", "\u200f", "\ufeff"]], 10: [["Soi"]], 11: [["Road"]], 13: [["  "]],
}


def rewritten(text: Column, place: int) -> Column:
    """A rewrite of notice text; the search by pattern is left out where a plain search shows that nothing fits."""
    changed = F.regexp_replace(text, *NOTICE_REWRITES[place])
    signs = REWRITE_SIGNS.get(place)
    if signs is None:
        return changed
    held = reduce(and_, (reduce(or_, (F.contains(text, F.lit(sign)) for sign in some)) for some in signs))
    return F.when(held, changed).otherwise(text)


def clean_notice(text: Column) -> Column:
    """Remove footers, repair scattered times, and drop lines of at most two characters."""
    for phrase in STOP_PHRASES:
        text = _once(text, lambda t: cut_at_phrase(t, phrase))
    for place in range(len(NOTICE_REWRITES)):
        text = _once(text, lambda t: rewritten(t, place))
    lines = F.transform(F.split(text, "\n"), strip)
    return F.array_join(F.filter(lines, lambda line: F.length(line) > 2), "\n")


def absolute_links(hrefs: Column, site: str = NOTICE_SITE, path: str = NEWS_PATH) -> Column:
    """Distinct links that contain ``path``, those without a host put behind ``site``."""
    kept = F.array_distinct(F.filter(hrefs, lambda h: F.contains(h, F.lit(path))))
    return F.transform(kept, lambda h: F.when(h.startswith("http"), h).otherwise(F.concat(F.lit(site), h)))


def first_links(html: Column, item: str, site: str = NOTICE_SITE, path: str = NEWS_PATH) -> Column:
    """Distinct absolute links: the first link inside each element of the selector ``item``, kept if it contains ``path``."""
    return absolute_links(page_parts(html, items=item)["links"], site, path)


def has_next_page(html: Column, selector: str = NEXT_PAGE) -> Column:
    """Whether the page has an element of the selector: an entry of a pagination list, or a link in a pagination box."""
    return F.coalesce(page_parts(html, exists=selector)["found"], F.lit(False))


#: Decimal digits of other scripts, ten by ten from zero, that notices may be written in.
_ZEROS = [0x0E50, 0x0660, 0x06F0, 0x0966, 0x0ED0, 0x1040, 0x17E0, 0xFF10]
OTHER_DIGITS = "".join(chr(z + d) for z in _ZEROS for d in range(10))


def ascii_digits(text: Column) -> Column:
    return F.translate(text, OTHER_DIGITS, "0123456789" * len(_ZEROS))


def html_text(html: Column, selector: str = "div.content-description") -> Column:
    """Text of the first element of ``selector``, one line per text node; null if absent."""
    return page_parts(html, text=selector)["text"]

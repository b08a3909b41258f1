"""Selectors over raw HTML, all answered in one scan of a page.

A selector names elements by tag and classes, below others in any depth (``ul.pagination
li``); commas part alternatives. The scan goes from tag to tag with the stack of open
elements; each open element remembers how many steps of every alternative its ancestors
and itself have matched, so an element is judged by its own tag and its parent alone.
An end tag closes the nearest open element of its name, with all inside it; one that
closes nothing is ignored. Comments and the content of scripts and styles are skipped.
"""

from __future__ import annotations

import html as entities
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>", re.S)
ATTRIBUTE = re.compile(r"([^\s=\"'<>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta source wbr".split())
HIDDEN = frozenset("script style template".split())
RAW = {tag: re.compile(rf"</{tag}\b", re.I) for tag in ("script", "style")}


def attributes(text: str) -> dict[str, str]:
    """Attributes of a start tag by lower-case name, the first of each."""
    found: dict[str, str] = {}
    for name, *values in ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), entities.unescape("".join(values)))
    return found


class Selector:
    """Alternatives, each a chain of (tag, classes) from the outermost step in."""

    def __init__(self, text: str) -> None:
        self.chains = [[self._step(s) for s in chain.split()] for chain in text.split(",")]
        self.start = (0,) * len(self.chains)

    @staticmethod
    def _step(text: str) -> tuple[str, frozenset[str]]:
        tag, *classes = text.split(".")
        return tag.lower(), frozenset(classes)

    def enter(self, tag: str, classes: frozenset[str], above: tuple[int, ...]) -> tuple[bool, tuple[int, ...]]:
        """Whether the element is selected, and the steps matched down to it."""
        selected, below = False, []
        for chain, n in zip(self.chains, above):
            wanted, of = chain[n]
            fits = wanted in ("", tag) and of <= classes
            last = n == len(chain) - 1
            selected |= fits and last
            below.append(n + 1 if fits and not last else n)
        return selected, tuple(below)

    def tags(self) -> set[str]:
        return {tag for chain in self.chains for tag, _ in chain}


class Scan:
    """What a page has: the text of the first element of ``text``, the first link in each of ``items``, any of ``exists``."""

    def __init__(self, text: str | None = None, items: str | None = None, exists: str | None = None) -> None:
        self.selectors = [s and Selector(s) for s in (text, items, exists)]
        known = [s for s in self.selectors if s]
        every = set().union(*(s.tags() for s in known)) if known else set()
        #: tags that any step asks for; None if a step asks for any tag
        self.wanted = None if "" in every else every

    def __call__(self, page: str) -> tuple[str | None, list[str], bool]:
        of_text, of_items, of_exists = self.selectors
        start = tuple(s.start if s else () for s in self.selectors)
        stack: list[tuple[str, tuple, bool, int]] = []  # tag, steps matched, hidden, item begun here
        links: list[str | None] = []
        open_items: list[int] = []
        parts: list[str] | None = None
        inside = 0  # height of the stack at the element whose text is taken; 0 outside
        found, hidden, at = False, 0, 0
        for m in TAG.finditer(page):
            if m.start() < at:
                continue
            if inside and not hidden and m.start() > at:
                parts.append(page[at:m.start()])
            at = m.end()
            tag = m[2]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1]:
                for i in range(len(stack) - 1, -1, -1):
                    if stack[i][0] == tag:
                        for _, _, was_hidden, item in stack[i:]:
                            hidden -= was_hidden
                            if item >= 0:
                                open_items.remove(item)
                        del stack[i:]
                        if inside > i:
                            inside, of_text = 0, None
                        break
                if of_text is None and of_items is None and (found or of_exists is None):
                    break  # all that was asked for is known
                continue
            matched, item = stack[-1][1] if stack else start, -1
            takes = False
            if self.wanted is None or tag in self.wanted or tag == "a" and open_items:
                own = attributes(m[3]) if m[3] else {}
                classes = frozenset(own.get("class", "").split())
                steps = []
                for k, (selector, above) in enumerate(zip(self.selectors, matched)):
                    if selector is None:
                        steps.append(above)
                        continue
                    selected, below = selector.enter(tag, classes, above)
                    steps.append(below)
                    if selected and k == 0:
                        takes = of_text is not None and not inside
                    elif selected and k == 1:
                        item = len(links)
                        links.append(None)
                    elif selected:
                        found = True
                if tag == "a" and "href" in own:
                    for i in open_items:
                        links[i] = own["href"] if links[i] is None else links[i]
                matched = tuple(steps)
            if tag in VOID:
                if takes:
                    parts, of_text = [], None
                continue
            if item >= 0:
                open_items.append(item)
            stack.append((tag, matched, tag in HIDDEN, item))
            hidden += tag in HIDDEN
            if takes:
                inside, parts = len(stack), []
            if tag in RAW:
                end = RAW[tag].search(page, at)
                at = end.start() if end else len(page)
        if inside and not hidden:
            parts.append(page[at:])
        text = None
        if parts is not None:
            stripped = ((entities.unescape(p) if "&" in p else p).strip() for p in parts)
            text = "\n".join(p for p in stripped if p)
        return text, [x for x in links if x is not None], found


def page_parts(page: Column, text: str | None = None, items: str | None = None, exists: str | None = None) -> Column:
    """Struct (text, links, found) of a page from one scan, see ``Scan``; null for a null page."""

    @F.pandas_udf("text string, links array<string>, found boolean")
    def scan(pages: pd.Series) -> pd.DataFrame:
        one = Scan(text, items, exists)
        return pd.DataFrame([one(p) if p is not None else (None, None, None) for p in pages], columns=["text", "links", "found"])

    return scan(page)

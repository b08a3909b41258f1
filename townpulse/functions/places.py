"""Place names found in texts by a keyword automaton.

All names are looked for in one scan of a text, however many there are; matching ignores
case. The names come from the caller and reach each worker once.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_BUILT: dict[str, tuple] = {}


def _automaton(shared) -> tuple[ahocorasick.Automaton, list[tuple[str, str]]]:
    """The worker's automaton; an entry's number is its priority."""
    key, entries = shared.value
    if key not in _BUILT:
        _BUILT.clear()
        automaton = ahocorasick.Automaton()
        for i in range(len(entries) - 1, -1, -1):  # of equal names the first stays
            automaton.add_word(entries[i][0].lower(), i)
        automaton.make_automaton()
        _BUILT[key] = automaton, entries
    return _BUILT[key]


class PlaceIndex:
    """Names and what each stands for (a district, a point as text); earlier names win."""

    def __init__(self, spark: SparkSession, entries: dict[str, str]) -> None:
        named = [(name, value) for name, value in entries.items() if name]
        self.shared = spark.sparkContext.broadcast((uuid.uuid4().hex, named)) if named else None

    def first_in(self, text: Column) -> Column:
        """The value of the name of highest priority that the text contains, else null."""
        shared = self.shared
        if shared is None:
            return F.lit(None).cast("string")

        @F.pandas_udf("string")
        def find(texts: pd.Series) -> pd.Series:
            automaton, entries = _automaton(shared)

            def one(text: str | None) -> str | None:
                best = min((i for _, i in automaton.iter(text.lower())), default=None) if text else None
                return None if best is None else entries[best][1]

            return pd.Series([one(t) for t in texts], dtype=object)

        return find(text)

    def all_in(self, text: Column) -> Column:
        """Array of (place, value): the names in a text from left to right, the longest where several begin or overlap."""
        shared = self.shared
        if shared is None:
            return F.array().cast("array<struct<place: string, value: string>>")

        @F.pandas_udf("array<struct<place: string, value: string>>")
        def find(texts: pd.Series) -> pd.Series:
            automaton, entries = _automaton(shared)

            def each(text: str) -> Iterator[dict]:
                for _, i in automaton.iter_long(text.lower()):
                    yield {"place": entries[i][0], "value": entries[i][1]}

            return pd.Series([None if t is None else list(each(t)) for t in texts], dtype=object)

        return find(text)

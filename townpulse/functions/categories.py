"""Column expressions over complaint types, states and ratings."""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townpulse.constants import FLOOD_PATTERN, NO_TYPE, TRAFFIC_PATTERN, UNKNOWN_TYPE, WASTE_PATTERN
from townpulse.functions.text import strip


def parse_types(col: Column) -> Column:
    """``{a,b}`` as an array of trimmed names; ``['Unknown']`` when there is none."""
    unknown = F.array(F.lit(UNKNOWN_TYPE))
    names = F.filter(
        F.transform(F.split(F.btrim(col, F.lit("{}")), ","), strip), lambda t: F.length(t) > 0
    )
    # the one-element array lets ``names`` be computed once and used twice
    filled = F.get(F.transform(F.array(names), lambda n: F.when(F.size(n) > 0, n).otherwise(unknown)), F.lit(0))
    return F.when(col.isNull() | (col == NO_TYPE), unknown).otherwise(filled)


def with_types(df: DataFrame, col: str = "type") -> DataFrame:
    return df.withColumn("types_list", parse_types(F.col(col))).withColumn(
        "primary_type", F.get("types_list", F.lit(0))
    )


def keyword_flag(col: Column, pattern: str) -> Column:
    """1 where the text matches, else 0 (also for null)."""
    return F.coalesce(col.rlike(pattern), F.lit(False)).cast("int")


def type_flags(col: Column) -> dict[str, Column]:
    return {
        "is_flood": keyword_flag(col, FLOOD_PATTERN),
        "is_traffic": keyword_flag(col, TRAFFIC_PATTERN),
        "is_waste": keyword_flag(col, WASTE_PATTERN),
    }


def decode_one_hot(df: DataFrame, prefix: str, default: Column, names: list[str] | None = None) -> Column:
    """The value whose ``prefix_value`` column is 1, else ``default``.

    Column names are trimmed before the value is read off them.
    """
    found = [c for c in df.columns if c.startswith(prefix + "_")]
    pairs = [(c, c[len(prefix) + 1:].strip()) for c in found]
    if names is not None:
        pairs = [(c, v) for c, v in pairs if v in names]
    return F.coalesce(*[F.when(F.col(f"`{c}`") == 1, F.lit(v)) for c, v in pairs], default)


def decode_state(df: DataFrame) -> Column:
    return decode_one_hot(df, "state", F.lit("Unknown"))


def decode_star(df: DataFrame) -> Column:
    return decode_one_hot(df, "star", F.lit(None)).try_cast("double")


def one_hot(df: DataFrame, cols: dict[str, list], drop_first: bool = False) -> DataFrame:
    """Replace each column by 0/1 columns ``col_value``; ``None`` becomes ``col_nan``.

    Values outside the given lists get zeros everywhere.
    """
    encoded = []
    for name, values in cols.items():
        for value in values[1:] if drop_first else values:
            hit = F.col(name).isNull() if value is None else F.col(name) == F.lit(value)
            label = "nan" if value is None else value
            encoded.append(F.coalesce(hit, F.lit(False)).cast("double").alias(f"{name}_{label}"))
    return df.select(*[F.col(c) for c in df.columns if c not in cols], *encoded)


def present_values(df: DataFrame, named: dict[str, list]) -> dict[str, list]:
    """Of the values the caller names per column, those that occur; ``None`` stands for null.

    One pass that tells of each named value whether it is there, so columns of any number of
    values are safe. For values nobody can name see ``one_hot_vector``.
    """
    hit = lambda c, v: F.col(c).isNull() if v is None else F.col(c) == F.lit(v)
    checks = [(c, v) for c, values in named.items() for v in values]
    if not checks:
        return {c: [] for c in named}
    row = df.agg(*[F.coalesce(F.bool_or(hit(c, v)), F.lit(False)).alias(f"_{i}") for i, (c, v) in enumerate(checks)]).first()
    there = {(c, v): row[i] for i, (c, v) in enumerate(checks)}
    return {c: [v for v in values if there[c, v]] for c, values in named.items()}


def one_hot_vector(df: DataFrame, cols: list[str], suffix: str = "_vector") -> tuple[DataFrame, dict[str, list[str]]]:
    """Add a sparse 0/1 vector per column, for any number of values, and each vector's values.

    Values are taken as text in alphabetical order; null has the place behind them.
    """
    texts, at, out = ([f"{p}{c}" for c in cols] for p in ("_text_", "_at_", ""))
    marked = df.withColumns({t: F.col(c).cast("string") for t, c in zip(texts, cols)})
    indexer = StringIndexer(inputCols=texts, outputCols=at, handleInvalid="keep", stringOrderType="alphabetAsc").fit(marked)
    encoder = OneHotEncoder(inputCols=at, outputCols=[c + suffix for c in out], dropLast=False)
    indexed = indexer.transform(marked)
    hot = encoder.fit(indexed).transform(indexed).drop(*texts, *at)
    return hot, {c: list(labels) for c, labels in zip(cols, indexer.labelsArray)}

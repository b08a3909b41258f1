"""Error metrics as aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPSILON = 2.220446049250313e-16


def mae(actual: Column, predicted: Column) -> Column:
    return F.avg(F.abs(actual - predicted))


def rmse(actual: Column, predicted: Column) -> Column:
    return F.sqrt(F.avg(F.pow(actual - predicted, F.lit(2.0))))


def mape_guarded(actual: Column, predicted: Column) -> Column:
    """Percent error with the denominator kept above machine epsilon."""
    return F.avg(F.abs(actual - predicted) / F.greatest(F.abs(actual), F.lit(EPSILON))) * 100


def mape(actual: Column, predicted: Column) -> Column:
    """Percent error over the days whose actual value is not zero."""
    return F.avg(F.abs((actual - predicted) / F.nullif(actual, F.lit(0)))) * 100


def error_metrics(df: DataFrame, by: list[str]) -> DataFrame:
    """mae, rmse and mape per ``by``, overall (horizon null) and per horizon."""
    y, p = F.col("actual").cast("double"), F.col("predicted").cast("double")
    return df.groupingSets(
        [[F.col(c) for c in by], [F.col(c) for c in [*by, "horizon"]]],
        *[F.col(c) for c in [*by, "horizon"]],
    ).agg(mae(y, p).alias("mae"), rmse(y, p).alias("rmse"), mape_guarded(y, p).alias("mape"))

"""Numeric parsing, ratios and period-over-period change."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import PLAIN_NUMBER, SCIENTIFIC_NUMBER, stripped


def parsed_number(df: DataFrame, column: str) -> Column:
    """The column as a number; NULL where it cannot be read as one.

    Numeric columns pass through untouched. Text goes through a pattern first, because a
    bare cast to double accepts suffixes such as ``1d``.
    """
    dtype = df.schema[column].dataType
    c = F.col(column)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(c), c)
    if isinstance(dtype, T.NumericType):
        return c
    if isinstance(dtype, T.BooleanType):
        return c.cast("int")
    text = stripped(c)
    return F.when(text.rlike(PLAIN_NUMBER) | text.rlike(SCIENTIFIC_NUMBER), text.try_cast("double"))


def parsed_or_zero(df: DataFrame, column: str) -> Column:
    return F.coalesce(parsed_number(df, column), F.lit(0))


def pct_change(current: Column, previous: Column) -> Column:
    """Percent change. NULL without a previous value or for 0 to 0, infinite from 0."""
    rise = F.when(current > 0, F.lit(float("inf"))).when(current < 0, F.lit(float("-inf")))
    return F.when(previous == 0, rise).otherwise(
        (F.try_divide(current.cast("double"), previous.cast("double")) - 1) * 100
    )


def rate_pct(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")) * 100, F.lit(0.0))

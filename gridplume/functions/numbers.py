"""Tolerant text-to-number conversion and rounding casts, as native expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of the number formats that Spark's parser takes beyond plain decimals: type suffixes, hexadecimal floats.
_FOREIGN = "dDfFxX"
_INFINITY = r"(?i)^[+-]?inf(inity)?$"
_INF = float("inf")


def parsed(text: Column) -> Column:
    """Text as a double wherever Spark finds one in it; ``plain`` then says which of these count."""
    return text.try_cast("double")


def plain(value: Column, text: Column, dtype: T.DataType) -> Column:
    """``value``, as ``parsed`` from ``text``, where ``text`` is a plain decimal number; else NULL. NaN is NULL.

    Infinity counts only when spelled out: a decimal too large for a double gives NULL. Text of another type
    than string has no spelling to test. ``value`` should be a column computed before: it occurs more than once
    here, and Spark would parse the text as often.
    """
    if not isinstance(dtype, T.StringType):
        return F.nanvl(value, F.lit(None).cast("double"))
    size = F.abs(value)
    foreign = reduce(lambda found, letter: found | text.contains(letter), _FOREIGN[1:], text.contains(_FOREIGN[0]))
    spelled_out = size.eqNullSafe(F.lit(_INF)) & text.rlike(_INFINITY)
    return F.when((size < _INF) & ~foreign, value).when(spelled_out, value)


def is_id(value: Column) -> Column:
    """Whether a number fits a BIGINT once rounded."""
    return (value > -(2.0**63)) & (value < 2.0**63)


def to_id(value: Column) -> Column:
    """Number as BIGINT, halves rounded away from zero; NULL where it does not fit."""
    return F.round(value).try_cast("bigint")


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))

"""Tolerant text-to-number casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Spark would also read "1d", "inf" and "NaN"; money text never means those
NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def lenient_double(text: Column) -> Column:
    """A number as double, anything else NULL."""
    text = text.cast("string")
    return F.when(text.rlike(NUMBER), F.trim(text).try_cast("double"))


def number(column: Column, kind: T.DataType) -> Column:
    """A column of a known type as double; text is parsed, numbers are cast, NaN counts as missing."""
    if not isinstance(kind, T.NumericType):
        return lenient_double(column)
    value = column.cast("double")
    return F.when(~F.isnan(value), value) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else value


def rounded(value: Column, precision: int = 2) -> Column:
    """The scaled value taken to the nearest even integer, and scaled back."""
    scale = float(10**precision)
    return F.rint(value * scale) / scale


def comma_decimal(text: Column, precision: int = 2) -> Column:
    """French-locale text such as ``100,50`` as a double rounded to ``precision``; bad text is NULL.

    A thousands separator is bad text.
    """
    return rounded(lenient_double(F.replace(text.cast("string"), F.lit(","), F.lit("."))), precision)

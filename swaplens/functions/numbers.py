"""Text to number, without exceptions and without NaN."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# A failing try_cast raises and catches an exception inside the row loop, some twenty times the price of a good
# value. The patterns keep such texts from the cast; what still fails (overflow) is rare.
_DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
_INTEGER = r"^\s*[+-]?[0-9]{1,19}\s*$"


def to_number(text: Column) -> Column:
    """Text to double; text that is no decimal number becomes NULL.

    Forms only the JVM parser takes ("5d", hexadecimal) are out, and so is NaN, which Spark sorts above every number.
    """
    return F.when(text.rlike(_DECIMAL), text.try_cast("double"))


def to_integer(text: Column) -> Column:
    """Text to bigint; anything but an integer becomes NULL."""
    return F.when(text.rlike(_INTEGER), text.try_cast("bigint"))


def no_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def to_whole(text: Column) -> Column:
    """Text to bigint; fractions and non-numbers become NULL."""
    value = to_number(text)
    return F.coalesce(to_integer(text), F.when(value == F.rint(value), value.try_cast("bigint")))


def is_finite(col: Column) -> Column:
    """True for a number that is neither NULL, NaN nor infinite."""
    return F.coalesce(~F.isnan(col) & (F.abs(col) != float("inf")), F.lit(False))

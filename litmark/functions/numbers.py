"""Numeric expressions: rounding, coercion, ranges, sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litmark.fixed_values import BINARY_UNITS

GIB = float(1024**3)
TIB = float(1024**4)


def round2(c: Column) -> Column:
    """Two decimals, scaling before rounding (1.005 stays 1.0, as in SQL engines that round the binary value)."""
    return F.round(c * 100) / 100


def try_int(c: Column, kind: T.DataType) -> Column:
    """Integer or NULL. Text such as '3.0' is a number; fractions round, as SQL casts do."""
    if isinstance(kind, T.StringType):
        return F.round(c.try_cast("double")).try_cast("int")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.rint(c).try_cast("int")
    if isinstance(kind, T.DecimalType):
        return F.round(c).try_cast("int")
    return c.try_cast("int")


def strict(c: Column, parsed: Column, name: str) -> Column:
    """``parsed``, or an error when a present value could not be parsed (also with ANSI mode off)."""
    failure = F.raise_error(F.concat(F.lit(f"{name}: cannot cast "), c.cast("string")))
    return F.when(c.isNull() | parsed.isNotNull(), parsed).otherwise(failure.cast("void"))


def strict_int(c: Column, kind: T.DataType, name: str) -> Column:
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return c.cast("int")
    return strict(c, try_int(c, kind), name)


def strict_double(c: Column, kind: T.DataType, name: str) -> Column:
    """A cast between numeric types cannot fail and is left bare; text is checked."""
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    return strict(c, c.try_cast("double"), name)


def coerce_double(c: Column) -> Column:
    """Double, NULL when the value is not a number (NaN counts as no value)."""
    value = c.try_cast("double")
    return F.when(~F.isnan(value), value)


def coerce_long(c: Column) -> Column:
    """Whole number, NULL when the value is not a number or has a fraction."""
    value = coerce_double(c)
    return F.when(value == F.floor(value), value.try_cast("long"))


def out_of_range(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    """True outside [low, high]; NULL passes."""
    return c.isNotNull() & ((c < low) | (c > high))


def out_of_domain(c: Column, allowed: list) -> Column:
    """True for NULL and for values that are not allowed."""
    return c.isNull() | ~c.isin(allowed)


def clamp(c: Column, low: float = 0.0, high: float = 100.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), c))


def differs(a: Column, b: Column, tolerance: float) -> Column:
    return F.abs(a - b) > tolerance


def gib(c: Column) -> Column:
    return c / F.lit(GIB)


def tib(c: Column) -> Column:
    return c / F.lit(TIB)


def readable_bytes(c: Column, units: list[str] = BINARY_UNITS) -> Column:
    """Size with two decimals in the largest unit below 1024, steps of 1024."""
    value = c.cast("double")

    def two_decimals(scaled: Column, unit: str) -> Column:
        return F.concat(F.call_function("format_number", scaled, F.lit("0.00")), F.lit(f" {unit}"))

    text = F.when(value.isNull(), None)
    for power, unit in enumerate(units[:-1]):
        scaled = value / float(1024**power)
        text = text.when(scaled < 1024, two_decimals(scaled, unit))
    return text.otherwise(two_decimals(value / float(1024 ** (len(units) - 1)), units[-1]))

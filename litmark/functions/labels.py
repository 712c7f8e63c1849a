"""Codes, labels and classifications."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from litmark import fixed_values as V
from litmark.functions.numbers import try_int


def network_label(code: Column) -> Column:
    label = F
    for value, text in V.NETWORK_LABELS.items():
        label = label.when(code == value, text)
    return label.otherwise(V.NETWORK_UNKNOWN)


def network_code(c: Column, kind: T.DataType) -> Column:
    """Code of a network given as number or name; unknown names are NULL, unknown numbers stay."""
    name = F.lower(F.trim(c.cast("string")))
    by_name = F.when(name.startswith(V.NETWORK_TOTAL_PREFIX), 0)
    for text, code in V.NETWORK_NAME_CODES.items():
        by_name = by_name.when(name == text, code)
    return F.coalesce(try_int(c, kind), by_name)


def state_of(municipality: Column) -> Column:
    """State code: the first two characters of a municipality code."""
    return F.substring(municipality, 1, 2)


def target_status(rate: Column, target: Column) -> Column:
    return (
        F.when(rate.isNull(), V.STATUS_NO_RESULT)
        .when(target.isNull(), V.STATUS_NO_TARGET)
        .when(rate >= target, V.STATUS_REACHED)
        .otherwise(V.STATUS_BELOW)
    )


def trend(before: Column, after: Column) -> Column:
    return (
        F.when(before.isNull() | after.isNull(), V.TREND_NONE)
        .when(after > before, V.TREND_UP)
        .when(after < before, V.TREND_DOWN)
        .otherwise(V.TREND_FLAT)
    )

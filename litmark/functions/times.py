"""Time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_timestamp(c: Column) -> Column:
    """Timestamp of an ISO text, NULL when it is not one; text without an offset is UTC.

    Dates may go without dashes and clocks without colons, minutes and seconds may be left out, and ``z`` may be small.
    """
    dashes = (F.substring(c, 5, 1) == "-") & (F.substring(c, 8, 1) == "-")
    has_clock = dashes & F.substring(c, 11, 1).isin("T", " ") & (F.substring(c, 14, 1) == ":")
    clock = F.substring(c, 12, 64)
    has_offset = clock.endswith("Z") | clock.contains("+") | clock.contains("-")
    common = has_clock & ~clock.endswith("z")
    text = (
        F.when(common & has_offset, c)
        .when(common, F.concat(c, F.lit("Z")))
        .when(dashes & (F.length(c) == 10), F.concat(c, F.lit("T00:00:00Z")))
        .when(c.rlike(_SHORT), _spelled_out(c))
    )
    return text.try_cast("timestamp")


# Year, month, day, hour, minute, second, fraction, offset; either all dashes or none.
_SHORT = (
    r"^(\d{4})(?:-(?=\d\d-)|(?=\d{4}(?:\D|$)))(\d{2})-?(\d{2})"
    r"(?:[T ](\d{2})(?::?(\d{2})(?::?(\d{2})(\.\d{1,6})?)?)?([Zz]|[+-]\d{2}(?::?\d{2})?)?)?$"
)


def _spelled_out(c: Column) -> Column:
    """A text that ``_SHORT`` matches, with dashes, colons, seconds and an offset."""

    def part(number: int, default: str) -> Column:
        found = F.regexp_extract(c, _SHORT, number)
        return F.when(found == "", default).otherwise(found)

    offset = F.regexp_replace(F.upper(part(8, "Z")), r"^([+-]\d{2})$", "$1:00")
    date = F.concat_ws("-", part(1, ""), part(2, ""), part(3, ""))
    clock = F.concat_ws(":", part(4, "00"), part(5, "00"), part(6, "00"))
    return F.concat(date, F.lit("T"), clock, F.regexp_extract(c, _SHORT, 7), F.regexp_replace(offset, r"^([+-]\d{2})(\d{2})$", "$1:$2"))


def within_days(c: Column, days: int, now: Column | None = None) -> Column:
    """True when ``c`` lies in the last ``days`` days before ``now``."""
    now = F.current_timestamp() if now is None else now
    return c >= now - F.make_dt_interval(F.lit(days))

"""Date parsing and the Monday-week bucket.

Four ways to reach the Monday of a date's week are in use; they agree on
every date from 1900-01-01 on. Before that day the signed remainder
(``truncated``) moves the date to the *next* Monday, because the remainder
of a negative day count is negative.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickweek.fixed import DATE_PATTERN, DURATION_PREFIX, DURATION_SUFFIX, WEEK_ORIGIN

ORIGIN = WEEK_ORIGIN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The shape of ISO date text, the fast path for the ISO pattern.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"


def parse_date(text: Column | str, fmt: str = DATE_PATTERN) -> Column:
    """Text to DATE by pattern; a bad value is NULL instead of an error.

    The ISO pattern takes a faster route with the same result: text of the
    exact ``dddd-dd-dd`` shape is cast (invalid days give NULL), other text
    is NULL. Any other pattern goes through the pattern parser."""
    t = _col(text)
    if fmt == "yyyy-MM-dd":  # the pattern the fast path is equal to
        return F.when(t.rlike(ISO_DATE), t.try_cast("date"))
    return F.try_to_date(t, fmt)


def cast_date(value: Column | str) -> Column:
    """``CAST(x AS DATE)`` that yields NULL for text that is not a date."""
    return _col(value).try_cast("date")


def iso_date_text(d: Column | str) -> Column:
    """DATE as ``yyyy-MM-dd`` text (the cast of a date to text is ISO)."""
    return _col(d).cast("date").cast("string")


def day_of_week(d: Column | str) -> Column:
    """Day of the week with Monday = 1 ... Sunday = 7."""
    return F.weekday(_col(d)) + 1


def days_since_origin(d: Column | str) -> Column:
    return F.datediff(_col(d), F.lit(ORIGIN))


def week_start(d: Column | str, mode: str = "pmod") -> Column:
    """Monday of the week holding ``d``.

    ``weekday``: step back by the day of the week (Monday = 1).
    ``pmod``: subtract the non-negative day count remainder mod 7.
    ``truncated``: subtract the signed remainder (next Monday before 1900).
    ``duration``: as ``truncated``, but through an ISO ``P<n>D`` duration text.
    """
    d = _col(d)
    if mode == "weekday":
        return F.date_add(d, F.lit(1) - day_of_week(d))
    if mode == "pmod":
        return F.date_sub(d, F.pmod(days_since_origin(d), F.lit(7)))
    if mode == "truncated":
        return F.date_sub(d, days_since_origin(d) % 7)
    if mode == "duration":
        return subtract_duration(d, days_duration(days_since_origin(d) % 7))
    raise ValueError(f"unknown week mode {mode!r}")


def days_duration(days: Column) -> Column:
    """ISO-8601 duration text ``P<n>D`` for a day count."""
    return F.concat(F.lit(DURATION_PREFIX), days.cast("string"), F.lit(DURATION_SUFFIX))


def duration_days(text: Column | str) -> Column:
    """Day count of a ``P<n>D`` duration text; NULL for any other text."""
    digits = F.regexp_extract(_col(text), r"^P(-?\d+)D$", 1)
    return F.when(digits != "", digits.try_cast("int"))


def subtract_duration(d: Column | str, duration: Column | str) -> Column:
    """DATE minus an ISO ``P<n>D`` duration."""
    return F.date_sub(_col(d), duration_days(duration))

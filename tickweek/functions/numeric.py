"""Numeric helpers: tolerant casts and the mid price."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(value: Column | str) -> Column:
    """``CAST(x AS DOUBLE)`` that yields NULL for text that is not a number."""
    return _col(value).try_cast("double")


def mid_price(high: Column | str = "high", low: Column | str = "low") -> Column:
    """``(high + low) / 2`` in double arithmetic."""
    return (to_double(high) + to_double(low)) / 2

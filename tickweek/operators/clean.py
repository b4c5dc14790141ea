"""Row filters: header and malformed rows, valid titles, date ranges, rejects.

All are plain predicates, so Catalyst pushes them to the scan where the
source allows it (``PushedFilters`` on Parquet and CSV scans).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweek.fixed import HEADER_SYMBOL, MIN_MODEL_YEAR


def is_clean_bar(symbol: str = "symbol", sector: str = "sector") -> Column:
    """Not the header line and a non-empty sector. NULL in either drops the row."""
    return (F.col(symbol) != HEADER_SYMBOL) & (F.col(sector) != "")


def clean_bars(df: DataFrame, symbol: str = "symbol", sector: str = "sector") -> DataFrame:
    return df.where(is_clean_bar(symbol, sector))


def is_valid_title(cost: str = "vehicleCost", model_year: str = "modelYear") -> Column:
    """A positive cost and a model year after 1900 (a header line has NULLs and drops)."""
    return (F.col(cost) > 0) & (F.col(model_year) > MIN_MODEL_YEAR)


def valid_titles(df: DataFrame) -> DataFrame:
    return df.where(is_valid_title())


def within(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Rows whose ``column`` (a date, or date text) lies in [start, end]; a bound of None is open.

    Text that is not a date is NULL and drops (no error under ANSI mode). On
    a DATE column the cast is a no-op and the range reaches the scan."""
    c = F.col(column).try_cast("date")
    low = c.isNotNull() if start is None else c >= F.lit(start).cast("date")
    high = c.isNotNull() if end is None else c <= F.lit(end).cast("date")
    return df.where(low & high)


def split_rejects(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    """(rows where ``ok`` holds, all other rows). Both sides stay lazy."""
    return df.where(ok), df.where(~F.coalesce(ok, F.lit(False)))

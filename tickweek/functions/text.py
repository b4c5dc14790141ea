"""String functions: sector normalisation, comma cleaning, field splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tickweek.fixed import SECTOR_FILL, TEXT_COMMA, TEXT_COMMA_FILL


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_sector(sector: Column | str, mode: str = "lower") -> Column:
    """Sector name as a grouping key.

    ``lower``: lower case, each literal space becomes ``_`` (SQL and Pig jobs).
    ``whitespace``: case kept, every whitespace character becomes ``_``
    (the MapReduce job, which later splits its key text on whitespace).
    """
    s = _col(sector)
    if mode == "lower":
        return F.lower(F.replace(s, F.lit(" "), F.lit(SECTOR_FILL)))
    if mode == "whitespace":
        return F.regexp_replace(s, r"\s", SECTOR_FILL)
    raise ValueError(f"unknown sector mode {mode!r}")


def field(text: Column | str, pattern: str, n: int) -> Column:
    """The n-th (0-based) part of ``text`` split on the regex ``pattern``."""
    return F.get(F.split(_col(text), pattern), n)


def comma_to_dot(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Replace ``,`` by ``.`` in every string cell; other types are untouched.

    The type test reads ``df.schema`` on the driver, so the work per row is a
    plain ``translate`` inside the generated code.
    """
    wanted = set(columns) if columns is not None else None
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, StringType) and (wanted is None or f.name in wanted):
            c = F.translate(c, TEXT_COMMA, TEXT_COMMA_FILL).alias(f.name)
        out.append(c)
    return df.select(*out)

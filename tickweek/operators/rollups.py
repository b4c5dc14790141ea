"""Weekly averages per symbol and per sector.

Each rollup is one ``groupBy().agg(avg)``: Spark plans a partial average on
the map side and the final one after the exchange, so a hot key costs one
buffer per task, never a list of its rows. The sector rollup is an average of
the symbol averages (each symbol weighs the same), which is why it is a
second aggregation and never folded into one ``AVG``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweek.fixed import AVERAGE_COLUMNS
from tickweek.functions.calendar import parse_date, week_start
from tickweek.functions.numeric import mid_price, to_double
from tickweek.functions.text import normalise_sector

# Output name -> input column of the symbol-week rollup.
SYMBOL_MEASURES = {
    "avgLow": "low",
    "avgHigh": "high",
    "avgClose": "close",
    "avgOpen": "open",
    "avgVolume": "volume",
    "avgPrice": "mid",
}


def prepare_bars(
    bars: DataFrame,
    date: str = "date",
    sector_mode: str = "lower",
    week_mode: str = "pmod",
) -> DataFrame:
    """Normalised sector, Monday week and typed prices of each bar row."""
    d = parse_date(F.col(date)) if dict(bars.dtypes).get(date) == "string" else F.col(date).cast("date")
    return bars.select(
        "symbol",
        normalise_sector("sector", sector_mode).alias("sector"),
        week_start(d, week_mode).alias("periodStart"),
        to_double("open").alias("open"),
        to_double("high").alias("high"),
        to_double("low").alias("low"),
        to_double("close").alias("close"),
        to_double("volume").alias("volume"),
        mid_price("high", "low").alias("mid"),
    )


def _avg(c: Column, default: float | None) -> Column:
    a = F.avg(c)
    return a if default is None else F.coalesce(a, F.lit(float(default)))


def symbol_week_averages(prepared: DataFrame, default: float | None = None) -> DataFrame:
    """Average low, high, close, open, volume and mid price per (symbol, sector, week).

    ``default`` replaces an average over no non-NULL value (e.g. 0.0)."""
    return prepared.groupBy("symbol", "sector", "periodStart").agg(
        *[_avg(F.col(src), default).alias(out) for out, src in SYMBOL_MEASURES.items()]
    )


def sector_week_averages(symbol_weeks: DataFrame, default: float | None = None) -> DataFrame:
    """Average of the symbol averages per (sector, week)."""
    return symbol_weeks.groupBy("sector", "periodStart").agg(
        *[_avg(F.col(c), default).alias(c) for c in AVERAGE_COLUMNS]
    )


def grouped_averages(df: DataFrame, keys: list[str], measures: dict[str, str], default: float | None = None) -> DataFrame:
    """Group on a struct key and flatten it back into columns.

    This is the grouped-bag form: ``GROUP rel BY (k1, k2)`` then
    ``AVG(rel.x)`` per bag and ``FLATTEN(group)``. The bag itself is never
    built; the average is taken by the aggregation buffer.
    """
    grouped = df.groupBy(F.struct(*keys).alias("group")).agg(
        *[_avg(F.col(src), default).alias(out) for out, src in measures.items()]
    )
    return grouped.select("group.*", *measures.keys())

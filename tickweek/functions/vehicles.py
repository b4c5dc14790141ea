"""Vehicle age and the wear-and-tear band."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickweek.fixed import BAND_CLASSIC, BAND_NEW, BAND_OLD, OLD_FROM, OLD_TO

NEW, OLD, CLASSIC = BAND_NEW, BAND_OLD, BAND_CLASSIC


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vehicle_age(purchase_date: Column | str, model_year: Column | str) -> Column:
    """Years between the model year and the purchase date's year (may be negative)."""
    return F.year(_col(purchase_date)) - _col(model_year)


def wear_and_tear(age: Column | str, null_band: str | None = CLASSIC) -> Column:
    """Age band. A NULL age falls through to ``Classic`` as in SQL ``CASE``;
    pass ``null_band=None`` to keep NULL, as a chained ``?:`` does."""
    a = _col(age)
    band = F.when(a < OLD_FROM, NEW).when((a >= OLD_FROM) & (a <= OLD_TO), OLD).otherwise(CLASSIC)
    if null_band == CLASSIC:
        return band
    return F.when(a.isNull(), F.lit(null_band)).otherwise(band)

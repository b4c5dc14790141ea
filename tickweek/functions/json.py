"""JSON text and array-of-record helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_json(text: Column | str, schema: DataType | str) -> Column:
    """JSON text to a typed value; malformed text gives NULL."""
    return F.from_json(_col(text), schema)


def json_text(value: Column | str) -> Column:
    return F.to_json(_col(value))


def first_element(arr: Column | str) -> Column:
    """``arr[0]``, or NULL for an empty or NULL array."""
    return F.get(_col(arr), 0)


def field_of_each(arr: Column | str, name: str) -> Column:
    """Project one field out of an array of records."""
    return F.transform(_col(arr), lambda x: x[name])


def contains(arr: Column | str, value: Column | str) -> Column:
    return F.array_contains(_col(arr), _col(value) if not isinstance(value, str) else F.lit(value))

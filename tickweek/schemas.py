"""Declared schemas of the input shapes, built from the lists in ``tickweek.fixed``.

Inference is never used: it reads ``0000012`` as the number 12 and turns a
numeric column with one bad cell into text. With these schemas in
PERMISSIVE mode a bad cell becomes NULL and the rest of the row is kept.
"""

from __future__ import annotations

from pyspark.sql.types import ArrayType, BooleanType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from tickweek.fixed import AVERAGE_COLUMNS, BAR_FIELDS, COMPANY_COLUMNS, COMPANY_FIELDS, INSTRUMENT_COLUMNS, TITLE_FIELDS

# How every delimited text is quoted: a cell may hold the separator, a quote in it is doubled.
CSV_OPTIONS = {"quote": '"', "escape": '"'}


_TYPES = {"string": StringType(), "double": DoubleType(), "bigint": LongType(), "int": IntegerType(), "boolean": BooleanType()}


def _struct(fields: list[tuple[str, str]]) -> StructType:
    return StructType([StructField(name, _TYPES[kind], True) for name, kind in fields])


# One daily bar inside a company document.
BAR = _struct(BAR_FIELDS)
BAR_COLUMNS = BAR.fieldNames()

# One company profile record: any field of a company document, without the bars.
PROFILE = _struct(COMPANY_FIELDS)

# Company document: instrument merged with its profile, plus the nested bars.
COMPANY = StructType([*PROFILE.fields, StructField("stockData", ArrayType(BAR), True)])

# One instrument of the full list.
INSTRUMENT = StructType([COMPANY[c] for c in INSTRUMENT_COLUMNS])

# One bar of a symbol's history as a flat record (history files).
HISTORY_ROW = StructType([COMPANY["symbol"], *BAR.fields])

# A flattened company-and-bar row as written by the converter: 19 company
# columns (typed as in the document) and the 13 bar columns.
FLAT_ROW = StructType([COMPANY[c] for c in COMPANY_COLUMNS] + list(BAR.fields))
BAR_ROW_COLUMNS = FLAT_ROW.fieldNames()

# The same 32 positional columns as the stock job reads them: every number is a double.
BARS = StructType([f if isinstance(f.dataType, StringType) else StructField(f.name, DoubleType()) for f in FLAT_ROW.fields])

# Vehicle title record: 13 positional columns of tab text.
TITLES = _struct(TITLE_FIELDS)

# Wrapped constituent list: {"companies": [{"symbol": ..., "name": ...}, ...]}.
MEMBER = StructType([COMPANY["symbol"], COMPANY["name"]])
MEMBER_LIST = StructType([StructField("companies", ArrayType(MEMBER), True)])

# Output shapes of the two stock stages and of the vehicle job.
SECTOR_WEEK_COLUMNS = ["sector", "periodStart", *AVERAGE_COLUMNS]
SYMBOL_WEEK_COLUMNS = ["symbol", *SECTOR_WEEK_COLUMNS]
VEHICLE_COLUMNS = ["purchaseDate", "modelYear", "vehicleAge", "periodStart", "WearAndTear"]

"""Constants that must equal those of the original jobs for equal results.

Everything else in the library is derived from these or from the data.
"""

from __future__ import annotations

import datetime as _dt

# Fixed values.
# Week buckets count days from this Monday.
WEEK_ORIGIN = _dt.date(1900, 1, 1)
# Dates are text of this pattern.
DATE_PATTERN = "yyyy-MM-dd"
# A header line read as data has this text in its symbol column.
HEADER_SYMBOL = "symbol"
# Sector names: a space (or, in the key/value style, any whitespace) becomes this character.
SECTOR_FILL = "_"
# Vehicle age bands: age below 8 is New, 8 to 40 is Old, anything else Classic.
BAND_NEW, BAND_OLD, BAND_CLASSIC = "New", "Old", "Classic"
OLD_FROM, OLD_TO = 8, 40
# A valid title has a positive cost and a model year after this one.
MIN_MODEL_YEAR = 1900
# In flattened rows a comma inside a text cell becomes a dot.
TEXT_COMMA, TEXT_COMMA_FILL = ",", "."
# A day count as duration text: P<n>D.
DURATION_PREFIX, DURATION_SUFFIX = "P", "D"
# The history range asked of the source.
HISTORY_FROM, HISTORY_TO = "2017-01-01", "2023-01-01"
# The fields of a company document, in its order; the bars follow as ``stockData``.
COMPANY_FIELDS = [
    ("symbol", "string"),
    ("name", "string"),
    ("price", "double"),
    ("exchange", "string"),
    ("exchangeShortName", "string"),
    ("type", "string"),
    ("beta", "double"),
    ("volAvg", "bigint"),
    ("mktCap", "bigint"),
    ("lastDiv", "double"),
    ("range", "string"),
    ("changes", "double"),
    ("companyName", "string"),
    ("currency", "string"),
    ("cik", "string"),
    ("isin", "string"),
    ("cusip", "string"),
    ("industry", "string"),
    ("website", "string"),
    ("description", "string"),
    ("ceo", "string"),
    ("sector", "string"),
    ("country", "string"),
    ("fullTimeEmployees", "string"),
    ("phone", "string"),
    ("address", "string"),
    ("city", "string"),
    ("state", "string"),
    ("zip", "string"),
    ("dcfDiff", "double"),
    ("dcf", "double"),
    ("image", "string"),
    ("ipoDate", "string"),
    ("defaultImage", "boolean"),
    ("isEtf", "boolean"),
    ("isActivelyTrading", "boolean"),
    ("isAdr", "boolean"),
    ("isFund", "boolean"),
]
# The fields of an instrument in the full list.
INSTRUMENT_COLUMNS = ["symbol", "name", "price", "exchange", "exchangeShortName", "type"]
# The fields of one daily bar.
BAR_FIELDS = [
    ("date", "string"),
    ("open", "double"),
    ("high", "double"),
    ("low", "double"),
    ("close", "double"),
    ("adjClose", "double"),
    ("volume", "bigint"),
    ("unadjustedVolume", "bigint"),
    ("change", "double"),
    ("changePercent", "double"),
    ("vwap", "double"),
    ("label", "string"),
    ("changeOverTime", "double"),
]
# The company columns of a flattened bar row, in this order; the bar fields follow.
COMPANY_COLUMNS = [
    "symbol", "name", "sector", "industry", "exchange", "exchangeShortName", "volAvg", "mktCap",
    "companyName", "cik", "isin", "cusip", "website", "ceo", "fullTimeEmployees", "address",
    "city", "zip", "image",
]
# A vehicle title record: positional columns of tab text.
TITLE_FIELDS = [
    ("vin", "string"),
    ("vehicleCost", "double"),
    ("odometerTypeCode", "int"),
    ("odometerReading", "int"),
    ("countyName", "string"),
    ("ZIP5", "int"),
    ("modelYear", "int"),
    ("makeCode", "string"),
    ("modelCode", "string"),
    ("vehicleTypeDescription", "string"),
    ("newUsedCode", "string"),
    ("titleIssueDate", "string"),
    ("purchaseDate", "string"),
]
# The averages of both stock stages, in output order.
AVERAGE_COLUMNS = ["avgLow", "avgHigh", "avgClose", "avgOpen", "avgVolume", "avgPrice"]

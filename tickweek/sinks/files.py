"""Writers: headed or bare delimited text, key/value lines, JSON documents.

The write mode is a parameter everywhere: ``overwrite`` replaces,
``errorifexists`` refuses a present target, ``append`` adds, and
``ignore`` lands data only where nothing is yet. ``packed`` text takes a
quarter of the space or less; every reader here opens it like plain text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweek.schemas import CSV_OPTIONS

# Options of packed text: gzip at its fastest level. One task reads a packed file, so a
# file holds a bounded number of rows; every file of headed text has its own header.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "500000"}


def write_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite", packed: bool = False) -> None:
    (
        df.write.mode(mode)
        .option("sep", sep)
        .option("header", header)
        .options(**CSV_OPTIONS, **(PACKED if packed else {}))
        .csv(path)
    )


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite", packed: bool = False) -> None:
    """Headed comma text that replaces the target (the default)."""
    write_delimited(df, path, ",", header, mode, packed)


def write_bare_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "errorifexists", packed: bool = False) -> None:
    """Headerless delimited text that refuses to replace an existing target."""
    write_delimited(df, path, sep, False, mode, packed)


def key_value_line(keys: list[str], values: list[str]) -> Column:
    """``k1,k2,k3<TAB>v1,...,vn`` text of each row; a NULL is an empty field,
    so every line keeps its field positions."""
    as_text = lambda names: [F.coalesce(F.col(n).cast("string"), F.lit("")) for n in names]
    return F.concat(F.concat_ws(",", *as_text(keys)), F.lit("\t"), F.concat_ws(",", *as_text(values)))


def write_key_value_lines(df: DataFrame, path: str, keys: list[str], values: list[str], mode: str = "overwrite", sort: bool = True) -> None:
    """One ``key<TAB>values`` text line per row, in key order when ``sort``.

    The sort is a range-partitioned global sort: every task writes one
    contiguous key range, so no single task receives all rows."""
    out = df.orderBy(*keys) if sort else df
    out.select(key_value_line(keys, values).alias("value")).write.mode(mode).text(path)


def write_documents(df: DataFrame, path: str, mode: str = "overwrite", packed: bool = False) -> None:
    """Nested documents as JSON, one object per line; NULL fields are left out."""
    df.write.mode(mode).option("ignoreNullFields", True).options(**(PACKED if packed else {})).json(path)


def land(df: DataFrame, path: str, fmt: str = "csv", header: bool = True) -> None:
    """Write only if nothing is at ``path`` yet; an existing target is kept as is."""
    w = df.write.mode("ignore").format(fmt)
    if fmt == "csv":
        w = w.option("header", header).options(**CSV_OPTIONS)
    w.save(path)

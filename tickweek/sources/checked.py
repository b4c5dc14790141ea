"""Delimited text read with its bad cells kept and counted.

A cell that is no value of its column's type is NULL in the row, as with the plain
readers; here the row also carries the raw line and the text of each such cell,
and the counts come from the same pass through ``DataFrame.observe``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickweek.schemas import CSV_OPTIONS

BAD_LINE = "bad_line"
BAD_CELLS = "bad_cells"


def _bad_cells(schema: StructType, sep: str, columns: list[str]) -> Column:
    """``{column: text}`` of the cells that the typed parse made NULL. A header's cell, the column's own name, is none."""
    ddl = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    # Only a line that did not parse is taken apart a second time.
    texts = F.from_csv(F.col(BAD_LINE), F.lit(ddl), {"sep": sep, "mode": "PERMISSIVE", **CSV_OPTIONS})
    cells = F.transform(
        F.array(*[F.struct(F.lit(c).alias("name"), texts.getField(c).alias("text"), F.col(f"`{c}`").isNull().alias("lost")) for c in columns]),
        lambda x: F.struct(x["name"], x["text"], x["lost"] & x["text"].isNotNull() & (F.trim(x["text"]) != x["name"])),
    )
    kept = F.filter(cells, lambda x: x["col3"])
    return F.when(F.col(BAD_LINE).isNotNull(), F.map_from_entries(F.transform(kept, lambda x: F.struct(x["name"], x["text"]))))


def read_checked(spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = False, columns: list[str] | None = None) -> DataFrame:
    """The columns of ``schema``, ``bad_line`` and ``bad_cells``.

    ``bad_line`` is the raw text of a line with a bad cell or another number of
    cells, else NULL; ``bad_cells`` maps the columns whose text was no value to
    that text. ``columns`` limits the check to some columns, so the others can
    still be pruned from the parse."""
    lined = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    rows = (
        spark.read.schema(lined)
        .options(sep=sep, header=header, mode="PERMISSIVE", columnNameOfCorruptRecord=BAD_LINE, **CSV_OPTIONS)
        .csv(path)
    )
    typed = [f.name for f in schema.fields if not isinstance(f.dataType, StringType) and (columns is None or f.name in columns)]
    return rows.withColumn(BAD_CELLS, _bad_cells(schema, sep, typed))


def counted(checked: DataFrame, columns: list[str]) -> tuple[DataFrame, Observation]:
    """``checked``, and its counts once an action has run: ``lines``, ``bad_lines``, ``bad_cells`` and ``bad_<column>``."""
    seen = Observation("cells")
    cells = F.coalesce(F.size(F.map_keys(BAD_CELLS)), F.lit(0))
    per_column = [F.count(F.when(F.map_contains_key(BAD_CELLS, c), 1)).alias(f"bad_{c}") for c in columns]
    totals = [F.count(F.lit(1)).alias("lines"), F.count(F.when(cells > 0, 1)).alias("bad_lines"), F.sum(cells).alias("bad_cells")]
    return checked.observe(seen, *totals, *per_column), seen


def bad_cells(checked: DataFrame, *keep: str) -> DataFrame:
    """One row per bad cell: the columns ``keep`` of its line, ``column`` and ``text``."""
    return checked.where(F.col(BAD_LINE).isNotNull()).select(*keep, F.explode(BAD_CELLS).alias("column", "text"))

"""Catalog tables over file locations, in Spark SQL.

An external table is a ``USING csv`` table with a ``LOCATION``: dropping it
keeps its files, so a later ``INSERT INTO`` at the same location adds to
what is there. Callers give each run its own location.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tickweek.schemas import CSV_OPTIONS


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def columns_ddl(schema: StructType) -> str:
    return ", ".join(f"{_ident(f.name)} {f.dataType.simpleString().upper()}" for f in schema.fields)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_ident(name)}")


def create_external_table(spark: SparkSession, name: str, schema: StructType, location: str, sep: str = ",") -> None:
    """A delimited text table over a folder: every file below it is a part."""
    dialect = ", ".join(f"{k} {_literal(v)}" for k, v in CSV_OPTIONS.items())
    spark.sql(
        f"CREATE TABLE {_ident(name)} ({columns_ddl(schema)}) USING csv "
        f"OPTIONS (sep {_literal(sep)}, header 'false', mode 'PERMISSIVE', {dialect}) LOCATION {_literal(location)}"
    )


def create_table_as(spark: SparkSession, name: str, query: str, location: str, fmt: str = "parquet", args: dict | None = None) -> None:
    """``CREATE TABLE name USING fmt LOCATION loc AS query``."""
    spark.sql(f"CREATE TABLE {_ident(name)} USING {fmt} LOCATION {_literal(location)} AS {query}", args=args)


def create_bucketed_table_as(
    spark: SparkSession, name: str, query: str, location: str, clustered_by: list[str], buckets: int, fmt: str = "parquet"
) -> None:
    """``CREATE TABLE ... CLUSTERED BY (columns) INTO n BUCKETS AS query``: grouping by the columns needs no shuffle."""
    columns = ", ".join(_ident(c) for c in clustered_by)
    spark.sql(
        f"CREATE TABLE {_ident(name)} USING {fmt} CLUSTERED BY ({columns}) INTO {int(buckets)} BUCKETS "
        f"LOCATION {_literal(location)} AS {query}"
    )


def insert_into(spark: SparkSession, name: str, query: str, args: dict | None = None) -> None:
    """``INSERT INTO name query`` (adds rows, never replaces)."""
    spark.sql(f"INSERT INTO {_ident(name)} {query}", args=args)


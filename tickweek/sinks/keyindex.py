"""Sorted key/value lines with an index of each file's first and last key.

A sorted output cut into files answers a lookup by one symbol from the few files
whose key range holds it; the index is one small row per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tickweek.functions.text import field
from tickweek.sinks.files import write_key_value_lines
from tickweek.sources.files import read_lines

INDEX = "_index"  # readers of the folder skip names that begin with an underscore
INDEX_SCHEMA = StructType(
    [StructField("path", StringType()), StructField("first", StringType()), StructField("last", StringType()), StructField("lines", LongType())]
)


def first_key() -> Column:
    """The first part of a line's key."""
    return field(field("value", "\t", 0), ",", 0)


def write_indexed_lines(df: DataFrame, path: str, keys: list[str], values: list[str]) -> None:
    """``key<TAB>values`` lines in key order, and the index beside them.

    The index follows from one aggregate over the files just written: a few
    rows per file, whatever the number of lines."""
    spark = df.sparkSession
    path = path.rstrip("/")
    write_key_value_lines(df, path, keys, values)
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), first_key().alias("key"))
    index = lines.groupBy("path").agg(F.min("key").alias("first"), F.max("key").alias("last"), F.count("*").alias("lines"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/{INDEX}")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path.rstrip('/')}/{INDEX}")


def lookup(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The lines whose first key part is ``key``; only files whose range holds it are read.

    A NULL key part is written as an empty field, so it is looked up as ``""``."""
    inside = read_index(spark, path).where((F.col("first") <= key) & (F.col("last") >= key))
    files = sorted(r.path for r in inside.select("path").collect())  # the few files of one key
    lines = read_lines(spark, files) if files else read_lines(spark, path).limit(0)
    return lines.where(first_key() == key)

"""Readers for delimited text, raw lines and JSON documents.

Every reader declares its schema (see ``tickweek.schemas``); nothing is
inferred, so no extra pass over the data runs and codes such as ``0000012``
stay text. Reads are lazy and split across tasks by file blocks, except a
multi-line JSON file, which is one task per file by nature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickweek.operators.clean import split_rejects
from tickweek.schemas import BARS, COMPANY, CSV_OPTIONS, MEMBER_LIST, TITLES


def read_delimited(spark: SparkSession, path: str, schema: StructType, sep: str = ",", header: bool = False) -> DataFrame:
    """Delimited text with a declared schema.

    ``header=True`` skips the first line of each file; ``header=False`` reads
    it as data (bad numbers become NULL, as with a positional loader), and a
    row filter removes it later. Quoted fields may hold the separator.
    """
    return (
        spark.read.schema(schema)
        .option("sep", sep)
        .option("header", header)
        .option("mode", "PERMISSIVE")
        .options(**CSV_OPTIONS)
        .csv(path)
    )


def read_bars(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """The 32-column comma text of flattened bars."""
    return read_delimited(spark, path, BARS, ",", header)


def read_titles(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """The 13-column tab text of vehicle titles."""
    return read_delimited(spark, path, TITLES, "\t", header)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Raw text lines as one ``value`` column."""
    return spark.read.text(path)


def parse_lines(lines: DataFrame, schema: StructType = BARS, sep: str = ",", keep: list[str] | None = None) -> DataFrame:
    """Parse each line with CSV rules (a quoted comma stays inside its field); ``keep`` names columns of ``lines`` to carry along.

    A naive split on the separator would cut ``"December 30, 22"`` in two and
    shift every later column."""
    schema_ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    parsed = F.from_csv(F.col("value"), schema_ddl, {"sep": sep, "mode": "PERMISSIVE", **CSV_OPTIONS})
    return lines.select(parsed.alias("_row"), *(keep or [])).select("_row.*", *(keep or []))


def read_documents(spark: SparkSession, path: str, schema: StructType = COMPANY, multi_line: bool = False, strict: bool = False) -> DataFrame:
    """Company documents. ``multi_line=True`` reads files that hold one JSON
    array (or one pretty-printed object); otherwise one object per line. With
    ``strict`` text that is no such document, or a cell of another type,
    fails the job; otherwise it becomes NULL."""
    mode = "FAILFAST" if strict else "PERMISSIVE"
    return spark.read.schema(schema).option("multiLine", multi_line).option("mode", mode).json(path)


def parse_documents(lines: DataFrame, schema: StructType | str) -> tuple[DataFrame, DataFrame]:
    """JSON lines (``value``) as ``(documents, rejects)``.

    A line that is no JSON object, or one with a cell of another type, is a
    reject and keeps its raw text. NULL and empty lines are neither."""
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    # A field of this name would hide the corrupt text, so it is unlikely on purpose.
    whole = StructType([*fields.fields, StructField("__malformed", StringType())])
    doc = F.from_json("value", whole, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__malformed"})
    # Exploded, so the parse runs once per line: filters on a projected parse are moved below it and parse again.
    parsed = lines.where(F.trim("value") != "").select("value", F.explode(F.array(doc)).alias("_doc"))
    good, rejects = split_rejects(parsed, F.col("_doc").isNotNull() & F.col("_doc.__malformed").isNull())
    return good.select(*[F.col("_doc").getField(f.name).alias(f.name) for f in fields]), rejects.select("value")


def read_member_list(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Wrapped constituent lists ``{"companies": [...]}`` unwrapped to
    ``(symbol, name)`` rows; lists may be split over many documents."""
    docs = spark.read.schema(MEMBER_LIST).option("multiLine", multi_line).json(path)
    return docs.select(F.inline("companies"))


def register(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` visible to SQL under ``name`` (session scoped)."""
    df.createOrReplaceTempView(name)
    return df

"""Landing file by file: files that a manifest does not list yet are copied, then listed.

The manifest is written last. A run that dies before leaves no entry, and the
next run lands the same files again into the same folders, so each file ends up
landed once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

MANIFEST = "_manifest"  # readers of the landing folder skip names that begin with an underscore
MANIFEST_SCHEMA = StructType([StructField("file", StringType()), StructField("size", LongType()), StructField("run", StringType())])
FILE = "file"


def source_files(spark: SparkSession, source: str) -> DataFrame:
    """``(file, size, path)`` of the files in a folder; their content is not read."""
    listed = spark.read.format("binaryFile").load(source).select("path", F.col("length").alias("size"))
    return listed.select(F.element_at(F.split("path", "/"), -1).alias(FILE), "size", "path")


def manifest(spark: SparkSession, target: str) -> DataFrame:
    """The files landed so far; empty for a folder that is not there yet."""
    path = f"{target.rstrip('/')}/{MANIFEST}"
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def land_files(spark: SparkSession, source: str, target: str, run: str) -> int:
    """Land each file of ``source`` that the manifest of ``target`` does not list; returns how many.

    A file's lines go to ``target/file=<name>``; a name that is listed is left
    alone, whatever its content has become. The driver sees the new files' names,
    as it does in any listing, never their content."""
    target = target.rstrip("/")
    new = source_files(spark, source).join(manifest(spark, target).select(FILE), FILE, "left_anti")
    names = [(r.file, r.size, r.path) for r in new.collect()]
    if not names:
        return 0
    lines = spark.read.text([p for _, _, p in names]).select("value", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias(FILE))
    written = lines.select("value", F.url_decode(F.replace(FILE, F.lit("+"), F.lit("%2B"))).alias(FILE)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    written.partitionBy(FILE).text(target)
    entries = spark.createDataFrame([(f, n, run) for f, n, _ in names], MANIFEST_SCHEMA)
    entries.coalesce(1).write.mode("append").parquet(f"{target}/{MANIFEST}")
    return len(names)


def read_landed(spark: SparkSession, target: str) -> DataFrame:
    """``(value, file)``: the lines of the files that the manifest lists."""
    schema = StructType([StructField("value", StringType()), StructField(FILE, StringType())])
    lines = spark.read.schema(schema).text(target)
    return lines.join(manifest(spark, target).select(FILE).distinct(), FILE, "left_semi").select("value", FILE)

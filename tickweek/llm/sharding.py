"""Contiguous shards of nearly equal bytes, from global prefix sums of row sizes (native).

Rows are ordered by (doc_id, scan position). A range partitioning puts each
stretch of that order into one partition; the slim rows (no text) are written
once with their partition's number. Per-partition totals then give every
partition its global offset, and only a running sum inside each partition is
left: no window ever spans the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweek.llm.common import documents
from tickweek.session import stored

SHARDS = 8


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, name: str = "shard") -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row of ``docs``.

    ``size`` is the UTF-8 length of ``text`` plus 1 (NULL text: 1). A row goes to
    the shard in whose equal share of all bytes its middle byte lies, so shards
    are contiguous in the order and differ by at most one row's size at each
    cut. ``slot`` numbers a shard's rows from 0 without gaps.
    NULL ids come first; rows of equal id (also wholly equal rows) follow each
    other in scan order, each with a slot of its own. An empty table gives no
    rows. Columns of ``docs`` other than ``doc_id`` and ``text`` are not read.
    """
    slim = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_row"),
    )
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = stored(
        slim.repartitionByRange(parts, F.col("doc_id").asc_nulls_first(), "_row").withColumn("_part", F.spark_partition_id()),
        f"{name}-slim",
    )
    # One row per partition: a window over them is bounded by the number of partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count("*").alias("_rows"))
    offsets = totals.select(
        "_part",
        F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_bytes0"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows0"),
        F.sum("_bytes").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_all"),
    )
    inside = Window.partitionBy("_part").orderBy(F.col("doc_id").asc_nulls_first(), "_row").rowsBetween(Window.unboundedPreceding, 0)
    numbered = placed.select(
        "*", F.sum("size").over(inside).alias("_sum"), F.count("*").over(inside).alias("_n")
    ).join(F.broadcast(offsets), "_part")  # one row per partition
    middle2 = 2 * (F.col("_bytes0") + F.col("_sum")) - F.col("size")
    numbered = numbered.select(
        "doc_id",
        "size",
        "text_crc32",
        F.least(F.floor(middle2 * shards / (2 * F.col("_all"))), F.lit(shards - 1)).cast("int").alias("shard"),
        (F.col("_rows0") + F.col("_n") - 1).alias("_index"),
    )
    firsts = numbered.groupBy("shard").agg(F.min("_index").alias("_first"))
    return numbered.join(F.broadcast(firsts), "shard").select(  # one row per shard
        "doc_id", "size", "text_crc32", "shard", (F.col("_index") - F.col("_first")).cast("long").alias("slot")
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir), SHARDS).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )

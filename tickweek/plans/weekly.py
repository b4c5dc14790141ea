"""Weekly averages that are kept up to date instead of computed anew.

* ``insert_bars`` / ``averages_of``: a table of sums and counts per (symbol,
  sector, week) that batches of new bars add to. Sums are decimals, so they are
  the same whatever the batches and their order.
* ``write_weeks`` / ``rerun_weeks``: stage 1 partitioned by week; a rerun over a
  range of dates replaces the weeks it touches and leaves the others' files alone.
* ``bucketed_stage1``: stage 1 as a table clustered by (sector, week), so that the
  second rollup needs no exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, LongType, StringType, StructField, StructType

from tickweek.fixed import AVERAGE_COLUMNS
from tickweek.functions.calendar import parse_date, week_start
from tickweek.operators.clean import clean_bars
from tickweek.operators.rollups import SYMBOL_MEASURES, prepare_bars, sector_week_averages
from tickweek.plans.stock import SECTOR_WEEK_SCHEMA, SYMBOL_WEEK_SCHEMA, symbol_week_report
from tickweek.sinks.tables import create_bucketed_table_as, create_external_table, drop_table, insert_into
from tickweek.sources.files import read_delimited

KEYS = ["symbol", "sector", "periodStart"]
# A price is kept to ten decimals in a sum; 28 digits in front of them fit.
CELL, SUM = DecimalType(28, 10), DecimalType(38, 10)
BATCH = "batch"

SUMS_SCHEMA = StructType(
    [StructField("symbol", StringType()), StructField("sector", StringType()), StructField("periodStart", DateType())]
    + [StructField(f"sum{c}", SUM) for c in AVERAGE_COLUMNS]
    + [StructField(f"n{c}", LongType()) for c in AVERAGE_COLUMNS]
    + [StructField(BATCH, StringType())]
)


def week_sums(bars: DataFrame, date: str = "date") -> DataFrame:
    """Sum and count of each measure per (symbol, sector, week); NULL, NaN and infinite cells count nowhere."""
    prepared = prepare_bars(clean_bars(bars), date)
    # an average's input, rounded once: from here on addition is exact
    cells = {out: F.col(src).try_cast(CELL) for out, src in SYMBOL_MEASURES.items()}
    sums = [F.sum(c).cast(SUM).alias(f"sum{out}") for out, c in cells.items()]
    return prepared.groupBy(*KEYS).agg(*sums, *[F.count(c).alias(f"n{out}") for out, c in cells.items()])


def _added(sums: DataFrame) -> DataFrame:
    totals = [F.sum(f"sum{c}").cast(SUM).alias(f"sum{c}") for c in AVERAGE_COLUMNS]
    return sums.groupBy(*KEYS).agg(*totals, *[F.sum(f"n{c}").alias(f"n{c}") for c in AVERAGE_COLUMNS])


def insert_bars(bars: DataFrame, path: str, batch: str, date: str = "date") -> None:
    """Add a batch of bars to the table at ``path``. The same batch inserted again replaces itself, so a retry adds nothing twice."""
    week_sums(bars, date).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def read_sums(spark: SparkSession, path: str) -> DataFrame:
    """The rows of all batches, several per key."""
    return spark.read.schema(SUMS_SCHEMA).parquet(path)


def averages_of(sums: DataFrame) -> DataFrame:
    """Stage 1 from the rows of ``read_sums``: the totals over all batches, divided. No value: NULL."""
    total = _added(sums)
    return total.select(*KEYS, *[(F.col(f"sum{c}").cast("double") / F.nullif(F.col(f"n{c}"), F.lit(0))).alias(c) for c in AVERAGE_COLUMNS])


def compact(spark: SparkSession, path: str, target: str, batch: str = "merged") -> None:
    """All batches at ``path`` added up into one batch of the table at ``target``, another folder."""
    _added(read_sums(spark, path)).write.mode("overwrite").parquet(f"{target}/{BATCH}={batch}")


def write_weeks(stage1: DataFrame, path: str) -> None:
    """Write stage 1 into its week partitions; weeks that ``stage1`` has no row of stay as they are.

    The rows of a week come together first (a large week in several tasks), so
    a task does not open a file for every week."""
    rows = stage1.hint("rebalance", "periodStart")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("periodStart").parquet(path)


def read_weeks(spark: SparkSession, path: str) -> DataFrame:
    fields = [f for f in SYMBOL_WEEK_SCHEMA.fields if f.name != "periodStart"] + [SYMBOL_WEEK_SCHEMA["periodStart"]]
    return spark.read.schema(StructType(fields)).parquet(path).select(*SYMBOL_WEEK_SCHEMA.fieldNames())


def rerun_weeks(bars: DataFrame, path: str, start: str, end: str, date: str = "date") -> None:
    """Compute the weeks that hold a day of ``start`` .. ``end`` from ``bars`` and replace just these.

    All bars of the first and the last week count, also those outside the range. A
    week that has no bars any more keeps its old rows."""
    low, high = (week_start(F.lit(d).cast("date")) for d in (start, end))
    day = parse_date(F.col(date)) if dict(bars.dtypes)[date] == "string" else F.col(date).cast("date")
    touched = bars.where((day >= low) & (day < F.date_add(high, 7)))
    write_weeks(symbol_week_report(touched, date=date), path)


def bucketed_stage1(spark: SparkSession, bars: DataFrame, name: str, location: str, buckets: int = 16, date: str = "date") -> DataFrame:
    """Stage 1 as a catalog table in ``buckets`` files' worth of (sector, week) clusters; returns the table."""
    view = f"{name}_source"
    # One task per bucket writes it, so the table has one file per bucket.
    stage1 = symbol_week_report(bars, date=date).repartition(buckets, "sector", "periodStart")
    stage1.createOrReplaceTempView(view)
    try:
        create_bucketed_table_as(spark, name, f"SELECT * FROM {view}", location, ["sector", "periodStart"], buckets)
    finally:
        spark.catalog.dropTempView(view)
    return spark.table(name)


def bucketed_job(spark: SparkSession, bars: DataFrame, work: str, tag: str, buckets: int = 16) -> DataFrame:
    """Both stages over catalog tables, stage 1 bucketed; the rows of the output table's files."""
    stage1, final, view = (f"tickweek_{n}_{tag}" for n in ("clustered", "clustered_sectors", "clustered_view"))
    try:
        table = bucketed_stage1(spark, bars, stage1, f"{work}/stage1", buckets)
        create_external_table(spark, final, SECTOR_WEEK_SCHEMA, f"{work}/final")
        sector_week_averages(table).createOrReplaceTempView(view)
        insert_into(spark, final, f"SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)
        drop_table(spark, stage1)
        drop_table(spark, final)
    return read_delimited(spark, f"{work}/final", SECTOR_WEEK_SCHEMA)

"""Registered queries on files: arrays in parallel, open records, bad cells, one-pass rejects, kept-up tables, landing, index.

Same contract as ``plans.registry``, which adds these to its own; their DuckDB twins
are in ``plans.oracle_files``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickweek.fixed import AVERAGE_COLUMNS
from tickweek.operators.clean import clean_bars
from tickweek.operators.enrich import attach_history, keep_members, merge_right_wins, nest_history
from tickweek.operators.open import EXTRA, open_documents, write_open_documents
from tickweek.operators.rollups import sector_week_averages
from tickweek.plans import acquisition, stock, weekly
from tickweek.plans.oracle import DIGITS, SNAP
from tickweek.schemas import BARS, COMPANY, FLAT_ROW, INSTRUMENT, MEMBER, PROFILE, TITLES
from tickweek.session import scratch_path, stored
from tickweek.sinks.files import write_bare_csv, write_csv, write_delimited
from tickweek.sinks.keyindex import lookup, read_index, write_indexed_lines
from tickweek.sinks.landing import land_files, manifest, read_landed
from tickweek.sinks.routed import GOOD, REJECTED, STATUS, read_routed, write_routed
from tickweek.sources import adapters as A
from tickweek.sources.arrays import read_json_array, write_json_arrays
from tickweek.sources.checked import bad_cells, read_checked
from tickweek.sources.files import parse_lines, read_lines

LINE = StructType([StructField("value", StringType())])
# Files that a query writes its JSON arrays to; readers split each of them.
ARRAY_FILES = 4
# The rerun replaces the weeks of this month; the first run had its prices doubled.
RERUN = ("1997-03-01", "1997-03-31")
# The symbol that the key index looks up.
LOOKUP = "42"


def rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(c).cast(SNAP), DIGITS).cast("double").alias(c) if c in AVERAGE_COLUMNS else F.col(c) for c in df.columns])


def json_array_parallel(spark: SparkSession, sf: str) -> DataFrame:
    """Companies as pretty-printed JSON arrays, each file read back in several splits."""
    path = scratch_path(spark, "company-arrays")
    merged = merge_right_wins(A.instruments(spark, sf), acquisition.profiles(A.profile_bodies(spark, sf, by_symbol=True)))
    write_json_arrays(merged, path, ARRAY_FILES)
    return read_json_array(spark, path, PROFILE)[0]


def json_wrapped_parallel(spark: SparkSession, sf: str) -> DataFrame:
    """The constituent list as ``{"companies": [...]}`` documents on one line, read back in splits."""
    path = scratch_path(spark, "member-arrays")
    write_json_arrays(A.members(spark, sf), path, ARRAY_FILES, wrapper="companies", pretty=False)
    return read_json_array(spark, path, MEMBER, wrapper="companies")[0]


def json_array_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Array elements with a cell of another type (text with braces in it): their raw text."""
    path = scratch_path(spark, "spoilt-arrays")
    price = F.when(F.col("price") > 100000, F.lit('"much, {or} ]"')).otherwise(F.col("price").cast("string"))
    spoilt = A.instruments(spark, sf).select("symbol", "name", F.parse_json(price).alias("price"))
    write_json_arrays(spoilt, path, ARRAY_FILES, pretty=False)
    return read_json_array(spark, path, "symbol string, name string, price double")[1]


def _open_fields(df: DataFrame) -> list:
    extra = F.col(EXTRA)
    return [
        F.try_variant_get(extra["listed"], "$", "string").alias("listed"),
        F.try_variant_get(extra["rating"], "$.grade", "string").alias("grade"),
        F.try_variant_get(extra["rating"], "$.score", "bigint").alias("score"),
        F.try_variant_get(extra["tags"], "$[1]", "string").alias("second_tag"),
        F.array_join(F.array_sort(F.map_keys(EXTRA)), ",").alias("extra_names"),
    ]


def profile_open_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Constituents merged with their profiles; the fields that no schema declares come along."""
    merged = acquisition.open_companies(A.instrument_lines(spark, sf), A.members(spark, sf), A.profile_bodies(spark, sf, by_symbol=True))
    return merged.select("symbol", "name", "price", *_open_fields(merged))


def open_documents_written(spark: SparkSession, sf: str) -> DataFrame:
    """Open company documents with nested bars written as JSON, read back and flattened."""
    path = scratch_path(spark, "open-documents")
    members = A.members(spark, sf)
    bars = keep_members(A.history(spark, sf, by_symbol=True), members)
    listed = acquisition.open_companies(A.instrument_lines(spark, sf), members, A.profile_bodies(spark, sf, by_symbol=True))
    docs = attach_history(listed, nest_history(bars, by_month=False), history=bars, keys=members)
    write_open_documents(docs.drop("page_month", "page"), path, packed=True)
    docs = open_documents(read_lines(spark, path), COMPANY)
    fields = _open_fields(docs)  # once per document, not per bar
    flat = docs.select("symbol", "companyName", F.explode("stockData").alias("_bar"), *fields)
    return flat.select("symbol", "companyName", F.col("_bar.date").alias("date"), F.col("_bar.close").alias("close"), *flat.columns[3:])


def csv_bad_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of comma text that are no numbers: where they stand and what they hold."""
    path = scratch_path(spark, "spoilt-csv")
    write_csv(A.bar_text(spark, sf), path, header=True, packed=True)
    return bad_cells(read_checked(spark, path, BARS), "symbol", "date", "close")


def tsv_bad_cells(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "spoilt-tsv")
    write_delimited(A.title_text(spark, sf), path, "\t", header=False)
    return bad_cells(read_checked(spark, path, TITLES, "\t"), "vin")


def csv_spoilt_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The rows themselves: a bad cell is NULL, all others of its line are kept."""
    path = scratch_path(spark, "spoilt-rows")
    write_csv(A.bar_text(spark, sf), path, header=True, packed=True)
    rows = clean_bars(read_checked(spark, path, BARS))
    return rows.select("symbol", "sector", "date", "high", "low", "volume", F.col("bad_line").isNotNull().alias("spoilt"))


def _routed_documents(spark: SparkSession, sf: str) -> str:
    path = scratch_path(spark, "routed-documents")
    bodies, history = A.profile_bodies(spark, sf, by_symbol=True), A.history(spark, sf, by_symbol=True)
    docs = acquisition.company_documents(A.instruments(spark, sf), A.members(spark, sf), bodies, history)
    write_routed(acquisition.routed_documents(docs), path, "text", packed=True)
    return path


def routed_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents flattened and rejected in one write: the good side, parsed from its comma text."""
    path = _routed_documents(spark, sf)
    lines = read_routed(spark, path, LINE, GOOD, "text")
    return parse_lines(lines, FLAT_ROW)


def routed_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The rejected side of the same write: documents without bars."""
    path = _routed_documents(spark, sf)
    lines = read_routed(spark, path, LINE, REJECTED, "text")
    return lines.select(F.from_json("value", PROFILE).alias("_doc")).select("_doc.*")


def routed_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Stage-1 lines re-keyed and rejected in one write, both sides read back."""
    path = scratch_path(spark, "routed-lines")
    rows = stock.route_key_value_lines(A.stage1_lines(spark, sf))
    write_routed(rows, path)
    schema = rows.drop(STATUS).schema
    good = read_routed(spark, path, schema, GOOD).select(F.lit(GOOD).alias("side"), "value", "sector", "periodStart", "avgLow", "avgPrice")
    bad = read_routed(spark, path, schema, REJECTED).select(F.lit(REJECTED).alias("side"), "value", "sector", "periodStart", "avgLow", "avgPrice")
    return good.unionByName(bad)


def merged_inserts(spark: SparkSession, sf: str) -> DataFrame:
    """Stage 1 as sums and counts: two halves inserted, one of them twice, added up and compacted.

    The bars are joined once; each insert reads the columns it needs from that copy."""
    work = scratch_path(spark, "week-sums")
    bars = stored(A.bar_rows(spark, sf).select("symbol", "sector", "date", "open", "high", "low", "close", "volume"), "week-bars")
    second = F.pmod(F.xxhash64("symbol", "date", "close"), F.lit(2)) == 1
    weekly.insert_bars(bars.where(~second), f"{work}/sums", "first")
    weekly.insert_bars(bars.where(second), f"{work}/sums", "second")
    weekly.insert_bars(bars.where(second), f"{work}/sums", "second")  # a retry
    weekly.compact(spark, f"{work}/sums", f"{work}/compacted")
    return rounded(sector_week_averages(weekly.averages_of(weekly.read_sums(spark, f"{work}/compacted"))))


def merged_symbol_weeks(spark: SparkSession, sf: str) -> DataFrame:
    """Stage 1 itself from the sums of three batches, one of them without bars."""
    path = scratch_path(spark, "week-batches")
    bars = A.bar_rows(spark, sf)
    part = F.pmod(F.xxhash64("date", "symbol"), F.lit(2))
    for batch in range(3):
        weekly.insert_bars(bars.where(part == batch), path, str(batch))
    return rounded(weekly.averages_of(weekly.read_sums(spark, path)))


def rerun_month(spark: SparkSession, sf: str) -> DataFrame:
    """Stage 1 by week: a first run with wrong prices in one month, then a rerun of that month's weeks."""
    path = scratch_path(spark, "weeks")
    bars = A.bar_rows(spark, sf)
    wrong = F.col("date").between(*RERUN)
    spoilt = bars.withColumns({c: F.when(wrong, F.col(c) * 2).otherwise(F.col(c)) for c in ("open", "high", "low", "close")})
    weekly.write_weeks(stock.symbol_week_report(spoilt), path)
    weekly.rerun_weeks(bars, path, *RERUN)
    return rounded(weekly.read_weeks(spark, path))


def bucketed_sector_week(spark: SparkSession, sf: str) -> DataFrame:
    """Both stages over tables, stage 1 clustered by (sector, week)."""
    work = scratch_path(spark, "bucketed")
    return rounded(weekly.bucketed_job(spark, A.bar_rows(spark, sf), work, work.rsplit("-", 1)[-1][:12]))


def landing_by_file(spark: SparkSession, sf: str) -> DataFrame:
    """The files of two folders of five landed first, then all five: the others land; a third run lands nothing."""
    work = scratch_path(spark, "landing-files")
    rows = A.instruments(spark, sf)
    for k in range(5):
        write_bare_csv(rows.where(F.pmod(F.col("symbol").cast("bigint"), F.lit(5)) == k), f"{work}/source/{k}")
    for run, folders in enumerate(("{0,1}", "*", "*"), 1):
        last = land_files(spark, f"{work}/source/{folders}", f"{work}/landed", str(run))
    lines = read_landed(spark, f"{work}/landed").join(manifest(spark, f"{work}/landed").select("file", "run"), "file")
    landed = parse_lines(lines.select("value", "run"), INSTRUMENT, keep=["run"])
    return landed.withColumns({"run": F.col("run").cast("int"), "landed_last": F.lit(last)})


def indexed_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Stage 1 in key order with an index of its files; the weeks of one symbol from the files that hold it."""
    path = scratch_path(spark, "indexed-lines")
    stage1 = stock.key_value_stage1(A.bar_rows(spark, sf))
    write_indexed_lines(stage1, path, ["symbol", "sector", "periodStart"], AVERAGE_COLUMNS)
    return rounded(stock.parse_key_value_lines(lookup(spark, path, LOOKUP))[0])


def indexed_files(spark: SparkSession, sf: str) -> DataFrame:
    """The index itself, summed up: lines, and files whose first key is not below the last of the file before."""
    path = scratch_path(spark, "indexed-lines")
    stage1 = stock.key_value_stage1(A.bar_rows(spark, sf))
    write_indexed_lines(stage1, path, ["symbol", "sector", "periodStart"], AVERAGE_COLUMNS)
    index = read_index(spark, path)
    return index.agg(F.sum("lines").alias("lines"), F.min("first").alias("first"), F.max("last").alias("last"), F.count(F.when(F.col("first") > F.col("last"), 1)).alias("unsorted"))


def stock_renamed_date(spark: SparkSession, sf: str) -> DataFrame:
    """Both stages over bars whose date column has another name."""
    return rounded(stock.sector_week_report(A.bar_rows(spark, sf).withColumnRenamed("date", "date_str"), date="date_str"))


def stock_renamed_date_written(spark: SparkSession, sf: str) -> DataFrame:
    work = scratch_path(spark, "renamed-date")
    bars = A.bar_rows(spark, sf).withColumnRenamed("date", "dateCol")
    return rounded(stock.run_stock_job(spark, bars, f"{work}/job1", f"{work}/final", date="dateCol"))


QUERIES = {
    f.__name__: f
    for f in (
        json_array_parallel, json_wrapped_parallel, json_array_rejects, profile_open_fields, open_documents_written,
        csv_bad_cells, tsv_bad_cells, csv_spoilt_rows, routed_rows, routed_rejects, routed_lines, merged_inserts,
        merged_symbol_weeks, rerun_month, bucketed_sector_week, landing_by_file, indexed_lookup, indexed_files,
        stock_renamed_date, stock_renamed_date_written,
    )
}

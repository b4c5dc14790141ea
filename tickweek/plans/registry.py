"""Registered queries: ``queries()`` and their DuckDB twins in ``oracle_sql()``.

Each query takes ``(spark, sf_dir)``, reads the driver tables of that folder
through ``tickweek.sources.adapters`` and runs over all of their rows.
Queries that exercise a sink write into a fresh folder below the session's
``spark.checkpoint.dir`` and return what Spark reads back from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweek.functions.calendar import day_of_week, days_since_origin, iso_date_text, parse_date, week_start
from tickweek.functions.json import field_of_each, json_text, parse_json
from tickweek.functions.numeric import mid_price, to_double
from tickweek.functions.text import normalise_sector
from tickweek.operators.clean import clean_bars, valid_titles, within
from tickweek.operators.enrich import keep_members, merge_right_wins, paged_lists
from tickweek.plans import acquisition, oracle_files, registry_files, stock, vehicles
from tickweek.fixed import AVERAGE_COLUMNS
from tickweek.plans.oracle import DIGITS, SNAP
from tickweek.plans.oracle import oracle_sql as _oracle_sql
from tickweek.schemas import FLAT_ROW, INSTRUMENT, MEMBER_LIST
from tickweek.session import scratch_path
from tickweek.sinks.files import land, write_bare_csv, write_csv, write_delimited, write_documents
from tickweek.sources import adapters as A
from tickweek.sources.files import (
    parse_documents,
    parse_lines,
    read_bars,
    read_delimited,
    read_documents,
    read_lines,
    read_member_list,
    read_titles,
    register,
)

Query = Callable[[SparkSession, str], DataFrame]

# The original history request covers fixed.HISTORY_FROM .. HISTORY_TO (2017-2023); the
# driver tables hold dates of 1995-2001, so the range query asks for 1996-1997 instead.
HISTORY_FROM, HISTORY_TO = "1996-01-01", "1997-12-31"


def _rounded(df: DataFrame) -> DataFrame:
    """Averages rounded to ``DIGITS`` decimals, halves up (see ``plans.oracle`` on ``SNAP``)."""
    rounded = [F.round(F.col(c).cast(SNAP), DIGITS).cast("double").alias(c) if c in AVERAGE_COLUMNS else F.col(c) for c in df.columns]
    return df.select(*rounded)


def sector_week_avg(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(stock.sector_week_report(A.bar_rows(spark, sf)))


def symbol_week_avg(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(stock.symbol_week_by_expressions(A.bar_rows(spark, sf)))


def clean_bars_q(spark: SparkSession, sf: str) -> DataFrame:
    return clean_bars(A.bar_rows(spark, sf))


def _sector_pairs(spark: SparkSession, sf: str, mode: str) -> DataFrame:
    sector = A.sectors(spark, sf).distinct()
    return sector.select(F.col("sector").alias("sector_raw"), normalise_sector("sector", mode).alias("sector"))


def sector_normalised(spark: SparkSession, sf: str) -> DataFrame:
    return _sector_pairs(spark, sf, "lower")


def sector_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    return _sector_pairs(spark, sf, "whitespace")


def _trade_dates(spark: SparkSession, sf: str) -> DataFrame:
    return A.bar_dates(spark, sf).select(parse_date("date").alias("trade_date")).distinct()


def week_start_weekday(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("trade_date")
    return _trade_dates(spark, sf).select(
        d,
        day_of_week(d).alias("dayOfWeek"),
        week_start(d, "weekday").alias("periodStart"),
        iso_date_text(week_start(d, "weekday")).alias("periodStartText"),
    )


def week_start_pmod(spark: SparkSession, sf: str) -> DataFrame:
    d = F.col("trade_date")
    return _trade_dates(spark, sf).select(d, days_since_origin(d).alias("daysSinceOrigin"), week_start(d, "pmod").alias("periodStart"))


def week_start_trunc_pre1900(spark: SparkSession, sf: str) -> DataFrame:
    shifted = _trade_dates(spark, sf).select(F.date_sub("trade_date", 36525).alias("shifted_date"))
    d = F.col("shifted_date")
    return shifted.select(
        d, week_start(d, "pmod").alias("periodStartPmod"), week_start(d, "truncated").alias("periodStartTruncated")
    )


def week_start_interval(spark: SparkSession, sf: str) -> DataFrame:
    """The vehicle job in the grouped-bag style: week through ``P<n>D`` text,
    pattern-parsed dates, and a NULL band for a NULL age."""
    return vehicles.vehicle_report(A.titles(spark, sf), week_mode="duration", null_band=None, parse="pattern")


def mid_price_q(spark: SparkSession, sf: str) -> DataFrame:
    bars = A.bar_rows(spark, sf)
    return bars.select(
        "symbol", "date", to_double("high").alias("high"), to_double("low").alias("low"), mid_price("high", "low").alias("avg")
    )


def vehicles_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return valid_titles(A.titles(spark, sf))


def vehicle_age_week_band(spark: SparkSession, sf: str) -> DataFrame:
    return vehicles.vehicle_report(A.titles(spark, sf))


def constituents_semi(spark: SparkSession, sf: str) -> DataFrame:
    return keep_members(A.instruments(spark, sf), A.members(spark, sf))


def profile_left_join(spark: SparkSession, sf: str) -> DataFrame:
    return merge_right_wins(A.instruments(spark, sf), acquisition.profiles(A.profile_bodies(spark, sf, by_symbol=True)))


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return acquisition.company_documents(
        A.instruments(spark, sf), A.members(spark, sf), A.profile_bodies(spark, sf, by_symbol=True), A.history(spark, sf, by_symbol=True)
    )


def nest_then_inline(spark: SparkSession, sf: str) -> DataFrame:
    return acquisition.flat_rows(_documents(spark, sf))


def missing_history_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return acquisition.rejects(_documents(spark, sf))


def history_range(spark: SparkSession, sf: str) -> DataFrame:
    return within(A.history(spark, sf, HISTORY_FROM, HISTORY_TO), "date", HISTORY_FROM, HISTORY_TO)


def json_props_field(spark: SparkSession, sf: str) -> DataFrame:
    ev = A.events(spark, sf)
    k = parse_json("props", "k INT").getField("k")
    return ev.select("event_id", k.alias("k"), json_text(F.struct(k.alias("k"))).alias("props_out"))


def json_companies_inline(spark: SparkSession, sf: str) -> DataFrame:
    """The constituent list written as wrapped ``{"companies": [...]}``
    documents of bounded size, read back and unwrapped."""
    path = scratch_path(spark, "member-lists")
    lists = paged_lists(A.members(spark, sf), [], ["symbol", "name"], "companies")
    write_documents(lists.select("companies"), path)
    return read_member_list(spark, path)


def json_member_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """The symbols of the wrapped constituent lists, one field of each record."""
    path = scratch_path(spark, "member-lists")
    lists = paged_lists(A.members(spark, sf), [], ["symbol", "name"], "companies")
    write_documents(lists.select("companies"), path)
    return read_documents(spark, path, MEMBER_LIST).select(F.explode(field_of_each("companies", "symbol")).alias("symbol"))


def json_instruments(spark: SparkSession, sf: str) -> DataFrame:
    """The instrument list written as JSON, read back and queried as a view."""
    path = scratch_path(spark, "instrument-json")
    write_documents(A.instruments(spark, sf), path)
    view = f"tickweek_instruments_{path.rsplit('-', 1)[-1][:12]}"
    register(read_documents(spark, path, INSTRUMENT, strict=True), view)
    return spark.sql(f"SELECT * FROM {view} WHERE price > :least", args={"least": 100000})


def _event_documents(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    path = scratch_path(spark, "event-json")
    A.event_lines(spark, sf).write.text(path)
    return parse_documents(read_lines(spark, path), "event bigint, kind bigint")


def json_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return _event_documents(spark, sf)[0]


def json_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The raw lines of the documents that do not parse or have a cell of another type."""
    return _event_documents(spark, sf)[1]


def _flat_csv(spark: SparkSession, sf: str) -> DataFrame:
    return acquisition.flat_csv(
        A.instruments(spark, sf), A.members(spark, sf), A.profile_bodies(spark, sf, by_symbol=True), A.history(spark, sf, by_symbol=True)
    )


def comma_to_dot(spark: SparkSession, sf: str) -> DataFrame:
    return _flat_csv(spark, sf)


def split_reparse_stage1(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(stock.key_value_stage_job(spark, A.bar_rows(spark, sf)))


def bag_average(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(stock.grouped_bag_report(A.bar_rows(spark, sf)))


def avg_default_zero(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(stock.symbol_week_report(A.bar_rows(spark, sf), default=0.0))


def csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Headed comma text written, then read by position: each file's header
    line comes back as a row with NULL numbers and is removed with the
    sector-less rows."""
    path = scratch_path(spark, "bars-csv")
    write_csv(A.bar_rows(spark, sf), path, header=True, packed=True)
    return clean_bars(read_bars(spark, path, header=False))


def tsv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "titles-tsv")
    write_delimited(A.titles(spark, sf), path, "\t", header=True)
    return valid_titles(read_titles(spark, path, header=False))


def text_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Bare comma text read back as raw lines and parsed with quote rules."""
    path = scratch_path(spark, "bars-lines")
    write_bare_csv(A.bar_rows(spark, sf), path, packed=True)
    rows = parse_lines(read_lines(spark, path))
    sector = normalise_sector("sector", "whitespace")
    return rows.where((F.col("symbol") != "symbol") & (sector != "")).select(
        "symbol", sector.alias("sector"), "date", mid_price("high", "low").alias("avg")
    )


def json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "company-json")
    write_documents(_documents(spark, sf), path, packed=True)
    return acquisition.flat_rows(read_documents(spark, path))


def table_ctas_insert(spark: SparkSession, sf: str) -> DataFrame:
    return _rounded(stock.catalog_table_report(spark, A.bar_rows(spark, sf)))


def landing_ignore(spark: SparkSession, sf: str) -> DataFrame:
    """Land the instruments; a second landing at the same place is skipped."""
    path = scratch_path(spark, "landing")
    land(A.instruments(spark, sf), path)
    land(A.members(spark, sf), path)
    return read_delimited(spark, path, INSTRUMENT, ",", header=True)


def stock_stages_written(spark: SparkSession, sf: str) -> DataFrame:
    """Both stock stages written as headed comma text; stage 2 and the
    result are read back from the files."""
    work = scratch_path(spark, "stock-stages")
    final = stock.run_stock_job(spark, A.bar_rows(spark, sf), f"{work}/job1", f"{work}/final")
    return _rounded(final)


def vehicle_stages_written(spark: SparkSession, sf: str) -> DataFrame:
    """Filtered titles written as headed tab text and read back for stage 2;
    the result is written as headed comma text and read back."""
    work = scratch_path(spark, "vehicle-stages")
    return vehicles.run_vehicle_job(spark, A.titles(spark, sf), f"{work}/job1", f"{work}/final")


def vehicle_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The vehicle job as SQL over catalog tables on landed tab text."""
    work = scratch_path(spark, "vehicle-tables")
    write_delimited(A.titles(spark, sf), f"{work}/raw", "\t", header=True)
    return vehicles.catalog_table_job(spark, f"{work}/raw", work, work.rsplit("-", 1)[-1][:12])


def flat_csv_export(spark: SparkSession, sf: str) -> DataFrame:
    """Flattened company-and-bar rows written as headed comma text (commas in
    text cells turned into dots first) and read back with the row schema."""
    path = scratch_path(spark, "flat-csv")
    write_csv(_flat_csv(spark, sf), path, header=True, packed=True)
    return read_delimited(spark, path, FLAT_ROW, ",", header=True)


_QUERIES: dict[str, Query] = {
    "sector_week_avg": sector_week_avg,
    "symbol_week_avg": symbol_week_avg,
    "clean_bars": clean_bars_q,
    "sector_normalised": sector_normalised,
    "sector_whitespace": sector_whitespace,
    "week_start_weekday": week_start_weekday,
    "week_start_pmod": week_start_pmod,
    "week_start_trunc_pre1900": week_start_trunc_pre1900,
    "week_start_interval": week_start_interval,
    "mid_price": mid_price_q,
    "vehicles_filtered": vehicles_filtered,
    "vehicle_age_week_band": vehicle_age_week_band,
    "constituents_semi": constituents_semi,
    "profile_left_join": profile_left_join,
    "nest_then_inline": nest_then_inline,
    "missing_history_rejects": missing_history_rejects,
    "history_range": history_range,
    "json_props_field": json_props_field,
    "json_companies_inline": json_companies_inline,
    "json_member_symbols": json_member_symbols,
    "json_instruments": json_instruments,
    "json_accepted": json_accepted,
    "json_rejects": json_rejects,
    "comma_to_dot": comma_to_dot,
    "split_reparse_stage1": split_reparse_stage1,
    "bag_average": bag_average,
    "avg_default_zero": avg_default_zero,
    "csv_roundtrip": csv_roundtrip,
    "tsv_roundtrip": tsv_roundtrip,
    "text_lines": text_lines,
    "json_roundtrip": json_roundtrip,
    "table_ctas_insert": table_ctas_insert,
    "landing_ignore": landing_ignore,
    "stock_stages_written": stock_stages_written,
    "vehicle_stages_written": vehicle_stages_written,
    "vehicle_tables": vehicle_tables,
    "flat_csv_export": flat_csv_export,
}


def queries() -> dict[str, Query]:
    return _QUERIES | registry_files.QUERIES


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query."""
    sql = _oracle_sql() | oracle_files.oracle_sql()
    return {name: sql[name] for name in queries() if name in sql}

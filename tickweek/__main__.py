"""Command line: run the jobs on files, as the original scripts were run.

    python -m tickweek stock INPUT OUTPUT [--stage1 DIR] [--style dataframe|tables|key-value|grouped] [--table NAME]
    python -m tickweek vehicles INPUT OUTPUT [--filtered DIR] [--style dataframe|tables|grouped] [--table NAME]
    python -m tickweek update INPUT SUMS OUTPUT --batch NAME [--header]
    python -m tickweek acquire INSTRUMENTS MEMBERS PROFILES HISTORY OUTPUT [--from D --to D] [--multi-line | --array]
    python -m tickweek flatten DOCUMENTS OUTPUT [--rejects DIR | --routed] [--multi-line | --array]
    python -m tickweek land SOURCE TARGET [--format csv|json|text|parquet] [--by-file RUN]

or ``spark-submit --py-files tickweek.zip tickweek/__main__.py stock ...``. The
session comes from the environment (``spark-submit`` settings); nothing here
forces a master. ``--mode`` picks
how outputs treat an existing target (overwrite, errorifexists, append, ignore).
The text jobs print how many lines and cells were no values of their columns.
``--array`` reads files that hold one JSON array each in splits. ``update`` adds a
batch of bars to a table of weekly sums and writes the sector averages of all batches.
Style ``key-value`` writes ``key<TAB>values`` lines, style ``grouped`` headerless
comma text, the others headed comma text.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickweek.fixed import HISTORY_FROM, HISTORY_TO
from tickweek.operators.rollups import sector_week_averages
from tickweek.plans import acquisition, stock, vehicles, weekly
from tickweek.schemas import BARS, COMPANY, CSV_OPTIONS, HISTORY_ROW, INSTRUMENT, MEMBER, PROFILE, TITLES
from tickweek.session import apply_recommended_conf, scratch_path
from tickweek.sinks.files import land, write_csv, write_documents
from tickweek.sinks.landing import land_files
from tickweek.sinks.routed import write_routed
from tickweek.sources.arrays import read_array_elements, read_json_array
from tickweek.sources.checked import BAD_CELLS, BAD_LINE, counted, read_checked
from tickweek.sources.files import read_documents, read_member_list


# The number columns that each job computes with; only their cells are checked, so the others stay pruned.
STOCK_CELLS = ["open", "high", "low", "close", "volume"]
VEHICLE_CELLS = ["vehicleCost", "modelYear"]


def _checked(spark: SparkSession, a: argparse.Namespace, schema: StructType, sep: str, columns: list[str]) -> tuple[DataFrame, Observation]:
    rows, seen = counted(read_checked(spark, a.input, schema, sep, a.header, columns), columns)
    return rows.drop(BAD_LINE, BAD_CELLS), seen


def _report(seen: Observation) -> None:
    """Print the counts of the first pass over the input."""
    print(" ".join(f"{name}={n}" for name, n in seen.get.items()))


def _stock(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.style == "tables":
        return _tables(spark, a, stock.catalog_table_job, a.stage1)
    bars, seen = _checked(spark, a, BARS, ",", STOCK_CELLS)
    if a.style == "dataframe":
        stock.run_stock_job(spark, bars, a.stage1, a.output, a.mode)
    elif a.style == "key-value":
        stock.key_value_stage_job(spark, bars, a.stage1, a.output, a.mode)
    else:
        stock.grouped_bag_job(spark, bars, a.stage1, a.output, a.mode)
    _report(seen)


def _vehicles(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.style == "tables":
        return _tables(spark, a, vehicles.catalog_table_job, a.filtered)
    titles, seen = _checked(spark, a, TITLES, "\t", VEHICLE_CELLS)
    if a.style == "dataframe":
        vehicles.run_vehicle_job(spark, titles, a.filtered, a.output, a.mode)
    else:
        vehicles.grouped_bag_job(spark, titles, a.filtered, a.output, a.mode)
    _report(seen)


def _update(spark: SparkSession, a: argparse.Namespace) -> None:
    bars, seen = _checked(spark, a, BARS, ",", STOCK_CELLS)
    weekly.insert_bars(bars, a.sums, a.batch)
    _report(seen)
    write_csv(sector_week_averages(weekly.averages_of(weekly.read_sums(spark, a.sums))), a.output, header=True, mode=a.mode)


def _tables(spark: SparkSession, a: argparse.Namespace, job, folder: str | None) -> None:
    """The catalog-table style; each run has a folder of its own, so it can be repeated."""
    tag = uuid.uuid4().hex[:12]
    if a.table and not folder:
        raise SystemExit("--table keeps its files: name a folder for them (--stage1 or --filtered)")
    work = f"{folder}/{tag}" if folder else scratch_path(spark, "tables")
    write_csv(job(spark, a.input, work, tag, a.table), a.output, header=True, mode=a.mode)


def _documents(spark: SparkSession, a: argparse.Namespace, path: str, schema: StructType) -> DataFrame:
    """JSON documents as the options say; text that is none is an error."""
    if not a.array:
        return read_documents(spark, path, schema, multi_line=a.multi_line, strict=True)
    strict = F.from_json("value", schema, {"mode": "FAILFAST"})
    return read_array_elements(spark, path).select(strict.alias("_doc")).select("_doc.*")


def _flatten(spark: SparkSession, a: argparse.Namespace) -> None:
    docs = _documents(spark, a, a.input, COMPANY)
    if a.routed:
        write_routed(acquisition.routed_documents(docs), a.output, "text", a.mode)
        return
    write_csv(acquisition.csv_rows(docs), a.output, header=True, mode=a.mode)
    if a.rejects:
        write_csv(acquisition.rejects(docs), a.rejects, header=True, mode=a.mode)


def _acquire(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.array:
        members = read_json_array(spark, a.members, MEMBER, wrapper="companies")[0]
    else:
        members = read_member_list(spark, a.members, multi_line=a.multi_line)
    docs = acquisition.documents_from_records(
        _documents(spark, a, a.instruments, INSTRUMENT),
        members,
        _documents(spark, a, a.profiles, PROFILE),
        _documents(spark, a, a.history, HISTORY_ROW),
        history_range=(a.date_from, a.date_to) if a.date_from or a.date_to else None,
    )
    # One document per page of a company; the page ids tell them apart.
    write_documents(docs, a.output, mode=a.mode)


def _land(spark: SparkSession, a: argparse.Namespace) -> None:
    if a.by_file:
        print(f"landed={land_files(spark, a.source, a.target, a.by_file)}")
        return
    reader = spark.read.format(a.format)
    if a.format == "csv":
        reader = reader.option("header", True).options(**CSV_OPTIONS)
    land(reader.load(a.source), a.target, fmt=a.format)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="tickweek")
    p.add_argument("--mode", default="overwrite", choices=["overwrite", "errorifexists", "append", "ignore"])
    sub = p.add_subparsers(dest="job", required=True)

    s = sub.add_parser("stock", help="weekly averages per symbol, then per sector")
    s.add_argument("input")
    s.add_argument("output")
    s.add_argument("--stage1", help="where to write the per-symbol stage (style tables: the tables' folder)")
    s.add_argument("--table", help="style tables: name of the result table, which then stays in the catalog")
    s.add_argument("--style", default="dataframe", choices=["dataframe", "tables", "key-value", "grouped"])
    s.add_argument("--header", action="store_true", help="skip the first line of each file")
    s.set_defaults(run=_stock)

    v = sub.add_parser("vehicles", help="vehicle age, purchase week and age band")
    v.add_argument("input")
    v.add_argument("output")
    v.add_argument("--filtered", help="where to write the filtered titles (style tables: the tables' folder)")
    v.add_argument("--table", help="style tables: name of the result table, which then stays in the catalog")
    v.add_argument("--style", default="dataframe", choices=["dataframe", "tables", "grouped"])
    v.add_argument("--header", action="store_true")
    v.set_defaults(run=_vehicles)

    f = sub.add_parser("flatten", help="nested company documents to one CSV row per bar")
    f.add_argument("input")
    f.add_argument("output")
    f.add_argument("--rejects", help="where to write documents without bars (optional)")
    f.add_argument("--routed", action="store_true", help="one pass: comma text below status=good, JSON of the others below status=rejected")
    f.add_argument("--multi-line", action="store_true", help="files hold a JSON array, not one object per line")
    f.add_argument("--array", action="store_true", help="as --multi-line, for large files: each is read in splits")
    f.set_defaults(run=_flatten)

    q = sub.add_parser("acquire", help="constituents with profiles and nested history, as JSON documents")
    q.add_argument("instruments", help="instrument list (JSON records)")
    q.add_argument("members", help='constituent lists ({"companies": [...]})')
    q.add_argument("profiles", help="profile records (JSON, one per symbol)")
    q.add_argument("history", help="bars as JSON records with a symbol field")
    q.add_argument("output")
    q.add_argument("--from", dest="date_from", help=f"first history date (the original request used {HISTORY_FROM})")
    q.add_argument("--to", dest="date_to", help=f"last history date (the original request used {HISTORY_TO})")
    q.add_argument("--multi-line", action="store_true", help="files hold JSON arrays")
    q.add_argument("--array", action="store_true", help="as --multi-line, for large files: each is read in splits")
    q.set_defaults(run=_acquire)

    g = sub.add_parser("land", help="copy a dataset to a target unless the target exists")
    g.add_argument("source")
    g.add_argument("target")
    g.add_argument("--format", default="csv", choices=["csv", "json", "text", "parquet"])
    g.add_argument("--by-file", metavar="RUN", help="land the text files that the target's manifest does not list, under this run's name")
    g.set_defaults(run=_land)

    u = sub.add_parser("update", help="add a batch of bars to weekly sums, write the sector averages of all batches")
    u.add_argument("input")
    u.add_argument("sums", help="folder of the sums; the same batch inserted again replaces itself")
    u.add_argument("output")
    u.add_argument("--batch", required=True)
    u.add_argument("--header", action="store_true", help="skip the first line of each file")
    u.set_defaults(run=_update)

    a = p.parse_args(argv)
    spark = apply_recommended_conf(SparkSession.builder.appName(f"tickweek-{a.job}").getOrCreate())
    a.run(spark, a)


if __name__ == "__main__":
    main()

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickweek.__main__ import main
from tickweek.plans.stock import SECTOR_WEEK_COLUMNS, catalog_table_job, key_value_stage_job, parse_key_value_lines, sector_week_report
from tickweek.schemas import BAR_ROW_COLUMNS, INSTRUMENT, TITLES
from tickweek.sinks import land, write_bare_csv, write_csv, write_delimited, write_documents
from tickweek.sinks.tables import create_external_table, drop_table, insert_into
from tickweek.sources.files import parse_documents
from tickweek.sources import parse_lines, read_bars, read_delimited, read_documents, read_lines, read_member_list, read_titles
from tickweek.operators.enrich import documents_without_bars, flatten_documents
from tickweek.schemas import BAR_COLUMNS

HEADER = ",".join(BAR_ROW_COLUMNS)


def _line(symbol, sector, date, o, h, lo, c, v, label='"March 4, 21"'):
    company = [symbol, "Name", sector, "Ind", "NYSE X", "NYSE", "5000000", "90000000000", "Name", "0000012345",
               "XX0000012345", "000012345", "https://x.example", '"Dr. A, Ph.D."', "700", "Addr", "City", "00001", "img"]
    bar = [date, o, h, lo, c, "19.5", v, v, "-0.05", "-0.09", "20.7", label, "-0.0025"]
    return ",".join(company + [str(x) for x in bar])


def _write_text(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)


def test_positional_read_keeps_quoted_comma_and_drops_header(spark, scratch):
    path = scratch("bars")
    _write_text(spark, path, [HEADER, _line("AAA", "Healthcare", "2022-12-30", 20.5, 21.0, 20.0, 20.6, 9000),
                              _line("AAA", "Healthcare", "2022-12-29", "oops", 21.25, 20.25, 20.75, 7000)])
    df = read_bars(spark, path, header=False)
    rows = df.collect()
    assert len(rows) == 3
    assert rows[0].symbol == "symbol" and rows[0].open is None  # header as data, numbers NULL
    assert rows[1].label == "March 4, 21" and rows[1].changeOverTime == -0.0025
    assert rows[2].open is None and rows[2].high == 21.25  # bad cell NULL, row kept
    assert rows[1].cik == "0000012345"  # code stays text
    out = sector_week_report(df).collect()
    assert len(out) == 1 and out[0].sector == "healthcare"


def test_raw_lines_parsed_with_quotes(spark, scratch):
    path = scratch("lines")
    _write_text(spark, path, [_line("BBB", "Energy", "2022-12-30", 40.5, 41.5, 40.5, 41.0, 8000)])
    row = parse_lines(read_lines(spark, path)).first()
    assert row.label == "March 4, 21" and row.high == 41.5 and row.ceo == "Dr. A, Ph.D."
    # A naive split cuts inside the quotes and shifts later fields.
    naive = read_lines(spark, path).select(F.split("value", ",").getItem(31)).first()[0]
    assert naive != "-0.0025"


def test_quotes_in_cells_are_read_alike_everywhere(spark, scratch):
    schema = StructType.fromDDL("name string, price double")
    cells = [('The "Big", Co', 1.5), ("back\\slash", 2.5), ("plain", None)]
    path, landed = scratch("quoted"), scratch("quoted-landed")
    write_bare_csv(spark.createDataFrame(cells, schema).coalesce(1), path)
    drop_table(spark, "tickweek_quoted")
    create_external_table(spark, "tickweek_quoted", schema, path)
    try:
        insert_into(spark, "tickweek_quoted", "SELECT 'a \"b\", c' AS name, 3.5 AS price")
        spark.catalog.refreshTable("tickweek_quoted")
        want = sorted([*cells, ('a "b", c', 3.5)])
        assert sorted(map(tuple, spark.table("tickweek_quoted").collect())) == want
        assert sorted(map(tuple, read_delimited(spark, path, schema).collect())) == want
        assert sorted(map(tuple, parse_lines(read_lines(spark, path), schema).collect())) == want
    finally:
        drop_table(spark, "tickweek_quoted")
    source = scratch("quoted-source")
    _write_text(spark, source, ["name,price", '"say ""hi"", ok",1'])
    main(["land", source, landed])
    assert list(map(tuple, read_delimited(spark, landed, schema, header=True).collect())) == [('say "hi", ok', 1.0)]


def test_unparsable_documents_fail_the_command(spark, scratch):
    path = scratch("pretty")
    _write_text(spark, path, ["[", '  {"symbol": "A"}', "]"])
    with pytest.raises(Exception, match="(?i)malformed"):
        main(["flatten", path, scratch("pretty-out")])


def test_write_modes(spark, scratch):
    df = spark.createDataFrame([("A", 1.0)], "symbol string, price double")
    path = scratch("modes")
    write_csv(df, path)
    write_csv(df, path)  # overwrite replaces
    assert spark.read.csv(path, header=True).count() == 1
    with pytest.raises(AnalysisException):
        write_bare_csv(df, path)  # refuses a present target
    write_delimited(df, path, ",", header=True, mode="append")
    assert spark.read.csv(path, header=True).count() == 2


def test_landing_is_skipped_when_present(spark, scratch):
    path = scratch("land")
    first = spark.createDataFrame([("A", "a", 1.0, "X", "X", "stock")], INSTRUMENT)
    land(first, path)
    land(spark.createDataFrame([("B", "b", 2.0, "Y", "Y", "stock")], INSTRUMENT), path)
    assert [r.symbol for r in read_delimited(spark, path, INSTRUMENT, header=True).collect()] == ["A"]


def test_titles_tab_text_header_dropped_by_filter(spark, scratch):
    path = scratch("titles")
    header = "\t".join(TITLES.fieldNames())
    row = "V1\t100\t1\t2\tC\t12345\t2013\tM\tX\tCar\tN\t2020-06-01\t2020-06-15"
    _write_text(spark, path, [header, row])
    df = read_titles(spark, path).where("vehicleCost > 0 AND modelYear > 1900")
    assert [r.vin for r in df.collect()] == ["V1"]


def test_key_value_lines_roundtrip_and_rejects(spark, scratch):
    bars = spark.createDataFrame(
        [("AAA", "Health Care", "2022-12-30", 1.0, 4.0, 2.0, 3.0, 10.0), ("AAA", "Health Care", "2022-12-28", 3.0, 6.0, 4.0, 5.0, 30.0)],
        "symbol string, sector string, date string, open double, high double, low double, close double, volume double",
    )
    out = key_value_stage_job(spark, bars, scratch("kv")).collect()
    assert len(out) == 1 and out[0].sector == "Health_Care" and out[0].periodStart == dt.date(2022, 12, 26)
    assert out[0].avgLow == 3.0 and out[0].avgPrice == 4.0
    lines = spark.createDataFrame([("A,b,2022-12-26\t1,2,3,4,5,6",), ("broken\t1,2",)], "value string")
    good, rejects = parse_key_value_lines(lines)
    assert good.count() == 1 and [r.value for r in rejects.collect()] == ["broken\t1,2"]
    strict, _ = parse_key_value_lines(lines, strict=True)
    with pytest.raises(Exception):
        strict.collect()


def test_multiline_company_documents(spark, scratch):
    path = scratch("docs") + "/companies.json"
    text = """[
      {"symbol": "AAA", "name": "Alpha, Inc.", "isEtf": false, "volAvg": 5000000,
       "stockData": [{"date": "2022-12-30", "open": 20.5, "volume": 9000, "label": "March 4, 21"},
                     {"date": "2022-12-29", "open": 20.4, "volume": 7000, "label": "March 3, 21"}]},
      {"symbol": "NOP", "name": "No bars"}
    ]"""
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    docs = read_documents(spark, path, multi_line=True)
    assert docs.count() == 2
    flat = flatten_documents(docs, ["symbol", "name"], BAR_COLUMNS)
    assert flat.count() == 2 and flat.first().volume == 9000
    assert [r.symbol for r in documents_without_bars(docs).collect()] == ["NOP"]


def test_member_list_document(spark, scratch):
    path = scratch("members")
    text = '{"companies": [{"symbol": "MMM", "name": "3M"}, {"symbol": "BRK.B", "name": "Berkshire"}]}'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    assert sorted(r.symbol for r in read_member_list(spark, path, multi_line=True).collect()) == ["BRK.B", "MMM"]


def test_json_documents_leave_nulls_out(spark, scratch):
    path = scratch("json-out")
    write_documents(spark.createDataFrame([("A", None)], "symbol string, name string"), path)
    assert spark.read.text(path).first()[0] == '{"symbol":"A"}'


def test_catalog_tables_job(spark, scratch):
    work = scratch("tables")
    lines = [_line("AAA", "Health Care", "2022-12-30", 20.5, 21.0, 20.0, 20.6, 100),
             _line("BBB", "Energy", "2022-12-29", 30.0, 31.5, 29.5, 31.0, 200), HEADER]
    _write_text(spark, work + "/raw", lines)
    out = catalog_table_job(spark, work + "/raw", work, "t1")
    assert out.columns == SECTOR_WEEK_COLUMNS
    rows = {r.sector: r for r in out.collect()}
    assert set(rows) == {"health_care", "energy"} and rows["energy"].avgVolume == 200.0
    assert not spark.catalog.tableExists("stock_final_t1")


def test_full_instrument_list_multiline(spark, scratch):
    path = scratch("stocklist") + "/list.json"
    text = '[{"symbol": "A", "name": "Agilent", "price": 1.5, "exchange": "NYSE", "exchangeShortName": "NYSE", "type": "stock"},\n {"symbol": "ZZ", "name": "Other"}]'
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    rows = read_documents(spark, path, INSTRUMENT, multi_line=True).collect()
    assert [(r.symbol, r.price) for r in rows] == [("A", 1.5), ("ZZ", None)]


def test_command_line_jobs(spark, scratch):
    from tickweek.__main__ import main

    work = scratch("cli")
    _write_text(spark, work + "/in", [HEADER, _line("AAA", "Health Care", "2022-12-30", 20.5, 21.0, 20.0, 20.6, 100)])
    main(["stock", work + "/in", work + "/out", "--stage1", work + "/job1"])
    rows = spark.read.csv(work + "/out", header=True).collect()
    assert [(r.sector, r.periodStart) for r in rows] == [("health_care", "2022-12-26")]
    main(["stock", work + "/in", work + "/out-kv", "--style", "key-value"])
    assert spark.read.text(work + "/out-kv").first()[0] == "Health_Care,2022-12-26\t20.0,21.0,20.6,20.5,100.0,20.5"
    for _ in range(2):  # headerless; a present target is refused
        args = ["--mode", "errorifexists", "stock", work + "/in", work + "/out-bag", "--style", "grouped", "--stage1", work + "/bag1"]
        if _:
            with pytest.raises(AnalysisException):
                main(args)
        else:
            main(args)
    assert [tuple(r)[:2] for r in spark.read.csv(work + "/out-bag").collect()] == [("health_care", "2022-12-26")]
    assert [tuple(r)[:3] for r in spark.read.csv(work + "/bag1").collect()] == [("AAA", "health_care", "2022-12-26")]
    for _ in range(2):  # the tables style can be repeated, its named result stays
        main(["stock", work + "/in", work + "/out-tab", "--style", "tables", "--stage1", work + "/tab1", "--table", "tickweek_cli_result"])
    try:
        assert [r.sector for r in spark.table("tickweek_cli_result").collect()] == ["health_care"]
    finally:
        drop_table(spark, "tickweek_cli_result")
    for _ in range(2):  # stage 2 of a second run with append sees its own stage 1 only
        main(["--mode", "append", "stock", work + "/in", work + "/out-add", "--stage1", work + "/add1"])
    assert spark.read.csv(work + "/out-add", header=True).count() == 2
    header = "\t".join(TITLES.fieldNames())
    _write_text(spark, work + "/titles", [header, "V1\t100\t1\t2\tC\t12345\t2013\tM\tX\tCar\tN\t2020-06-01\t2020-06-15"])
    main(["vehicles", work + "/titles", work + "/vout", "--style", "tables"])
    row = spark.read.csv(work + "/vout", header=True).first()
    assert (row.vehicleAge, row.WearAndTear) == ("7", "New")
    main(["vehicles", work + "/titles", work + "/vbag", "--style", "grouped", "--filtered", work + "/vbag1"])
    assert [tuple(r) for r in spark.read.csv(work + "/vbag").collect()] == [("2020-06-15", "2013", "7", "2020-06-15", "New")]


def test_date_column_by_another_name(spark):
    bars = spark.createDataFrame(
        [("A", "S", "2022-12-30", 1.0, 2.0, 1.0, 1.0, 5.0)],
        "symbol string, sector string, day string, open double, high double, low double, close double, volume double",
    )
    assert sector_week_report(bars, date="day").first().periodStart == dt.date(2022, 12, 26)


def test_json_lines_with_rejects(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": "word"}', '{"a": 2', "[]", "nothing", "", None, "{}"]
    good, bad = parse_documents(spark.createDataFrame([(t,) for t in texts], "value string"), "a bigint, b string")
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "x"), (None, None)]
    assert sorted(r.value for r in bad.collect()) == sorted(['{"a": "word"}', '{"a": 2', "[]", "nothing"])


def test_recommended_conf_keeps_submitted_values(spark):
    from tickweek.session import apply_recommended_conf

    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    apply_recommended_conf(spark)
    assert spark.conf.get("spark.sql.adaptive.skewJoin.enabled") == "true"
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") in ("256m", str(256 * 1024 * 1024))


def test_command_line_acquire_then_flatten(spark, scratch):
    from tickweek.__main__ import main

    work = scratch("cli-acq")

    def put(name, lines):
        _write_text(spark, f"{work}/{name}", lines)

    put("instruments", ['{"symbol": "AAA", "name": "Alpha", "price": 1.0}', '{"symbol": "BBB", "name": "Beta"}',
                        '{"symbol": "NOPE", "name": "Not listed"}'])
    put("members", ['{"companies": [{"symbol": "AAA", "name": "Alpha"}, {"symbol": "BBB", "name": "Beta"}]}'])
    put("profiles", ['{"symbol": "AAA", "companyName": "Alpha Inc.", "sector": "Healthcare", "ceo": "Dr. A, Ph.D."}'])
    put("history", ['{"symbol": "AAA", "date": "2022-12-30", "open": 20.5, "volume": 9000, "label": "March 4, 21"}',
                    '{"symbol": "AAA", "date": "2016-12-30", "open": 40.0}'])
    main(["acquire", f"{work}/instruments", f"{work}/members", f"{work}/profiles", f"{work}/history", f"{work}/docs",
          "--from", "2017-01-01", "--to", "2023-01-01"])
    main(["flatten", f"{work}/docs", f"{work}/csv", "--rejects", f"{work}/rejects"])
    rows = spark.read.csv(f"{work}/csv", header=True).collect()
    assert [(r.symbol, r.date, r.ceo, r.label) for r in rows] == [("AAA", "2022-12-30", "Dr. A. Ph.D.", "March 4. 21")]
    assert [r.symbol for r in spark.read.csv(f"{work}/rejects", header=True).collect()] == ["BBB"]

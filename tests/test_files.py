"""Arrays in splits, open records, bad cells, routed writes, kept-up tables, landing and the key index."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from tickweek.__main__ import main
from tickweek.fixed import AVERAGE_COLUMNS
from tickweek.operators.enrich import attach_history, keep_members, nest_history, paged_lists, _with_pages
from tickweek.operators.open import merge_open, open_documents, open_first_records, open_text, write_open_documents
from tickweek.operators.rollups import sector_week_averages
from tickweek.plans import acquisition, stock, weekly
from tickweek.plans.explain import plan_text
from tickweek.schemas import BARS, BAR_ROW_COLUMNS, COMPANY, INSTRUMENT, PROFILE, TITLES
from tickweek.sinks.files import write_bare_csv
from tickweek.sinks.keyindex import lookup, read_index, write_indexed_lines
from tickweek.sinks.landing import land_files, manifest, read_landed
from tickweek.sinks.routed import GOOD, REJECTED, read_routed, routed, write_routed
from tickweek.sources import adapters as A
from tickweek.sources.arrays import read_array_elements, read_json_array, write_json_arrays
from tickweek.sources.checked import bad_cells, counted, read_checked
from tickweek.sources.files import parse_documents, read_lines

SF = "/root/testdata/sf0.001"


def local(path):
    return path.removeprefix("file:")


@pytest.fixture()
def small_splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = [spark.conf.get(n) for n in names]
    for n, v in zip(names, ("600", "100")):
        spark.conf.set(n, v)
    yield
    for n, v in zip(names, before):
        spark.conf.set(n, v)


def value(rnd, depth=0):
    c = rnd.random()
    if depth > 2 or c < 0.5:
        return rnd.choice(["}{][", ',"a":"', "\\", 'x\\"}', "é}日本", "", 5, 1.5, None, True, "\n}\t", "p" * rnd.randint(1, 900)])
    if c < 0.75:
        return [value(rnd, depth + 1) for _ in range(rnd.randint(0, 3))]
    return {rnd.choice(["k", "k}", 'k"{']) + str(i): value(rnd, depth + 1) for i in range(rnd.randint(0, 3))}


@pytest.mark.parametrize("indent, wrapper", [(2, None), (None, None), (2, "companies"), (None, "companies")])
def test_array_elements_over_many_splits(spark, scratch, small_splits, indent, wrapper):
    rnd = random.Random(indent)
    folder = local(scratch("arrays"))
    os.makedirs(folder)
    for n in (0, 1, 120):
        docs = [{"i": i, "v": value(rnd), "w": value(rnd)} for i in range(n)]
        path = f"{folder}/{n}.json"
        with open(path, "w", encoding="utf-8") as f:
            f.write(json.dumps(docs if wrapper is None else {wrapper: docs}, indent=indent, ensure_ascii=False) + ("\n" if n else ""))
        got = read_array_elements(spark, path, wrapper)
        assert sorted((json.loads(r.value) for r in got.collect()), key=lambda d: d["i"]) == docs
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 5  # one file, many tasks
    several = read_array_elements(spark, folder, wrapper)  # a folder of arrays
    assert several.count() == 121


@pytest.mark.parametrize(
    "text, good, rejects",
    [
        ("", [], []),
        ("[]", [], []),
        ("[ ]\n", [], []),
        ('[{"i":1},{"i":2', [1], ['{"i":2']),
        ('[{"i":1},{"i":"2}]', [1], ['{"i":"2']),
        ('[{"i":1}, {"i":"x"}, null]', [1], ['{"i":"x"}', "null]"]),
        ('[{"i":1}, 7, {"i":2}]', [1], ['7, {"i":2}']),
        ('[{}, {"i":3}]', [None, 3], []),
    ],
)
def test_array_text_that_is_no_array_of_objects(spark, scratch, text, good, rejects):
    path = local(scratch("bad-array"))
    os.makedirs(path)
    with open(f"{path}/a.json", "w") as f:
        f.write(text)
    docs, bad = read_json_array(spark, path, "i int")
    assert [r.i for r in docs.collect()] == good and sorted(r.value for r in bad.collect()) == sorted(rejects)


def test_written_arrays_are_json(spark, scratch):
    path = scratch("written-arrays")
    write_json_arrays(spark.range(50).withColumn("t", F.lit('a"}')), path, 3, wrapper="companies")
    files = [os.path.join(d, f) for d, _, names in os.walk(local(path)) for f in names if f.startswith("part-")]
    assert len(files) == 3
    assert sorted(x["id"] for f in files for x in json.load(open(f))["companies"]) == list(range(50))
    write_json_arrays(spark.range(0), scratch("no-arrays"), 3)


def test_open_fields_survive_merge_and_writing(spark, scratch):
    left = open_documents(
        spark.createDataFrame([('{"symbol":"A","name":"a","x":{"y":[1,2]},"z":1}',), ('{"symbol":"B","z":null}',), ("no json",), ("[1]",)], "value string"), INSTRUMENT
    )
    assert {r.symbol for r in left.collect()} == {"A", "B"}
    bodies = spark.createDataFrame([("A", '[{"symbol":"A","ceo":"c, \\"q\\"","z":null,"n":"new"}, {"z":9}]'), ("C", "[]"), ("B", "broken")], "symbol string, body string")
    merged = merge_open(left, open_first_records(bodies, "body", PROFILE))
    path = scratch("open")
    write_open_documents(merged, path)
    got = {d["symbol"]: d for d in (json.loads(r.value) for r in read_lines(spark, path).collect())}
    assert got["A"] == {"symbol": "A", "name": "a", "ceo": 'c, "q"', "x": {"y": [1, 2]}, "z": None, "n": "new"}
    assert got["B"] == {"symbol": "B", "z": None}
    again = open_documents(read_lines(spark, path), COMPANY)
    assert {r.symbol: sorted(json.loads(r.j)) for r in again.select("symbol", F.to_json("extra").alias("j")).collect()} == {"A": ["n", "x", "z"], "B": ["z"]}


def test_bad_cells_are_kept_and_counted(spark, scratch):
    path = local(scratch("cells"))
    os.makedirs(path)
    cells = dict.fromkeys(BAR_ROW_COLUMNS, "")
    good = {**cells, "symbol": "A", "high": "1.5", "low": "1e1", "volume": "", "label": '"May 2, 20"'}
    bad = {**cells, "symbol": "B", "high": '"1,5"', "low": "2", "volume": '"n/a ""x"" \\"'}
    with open(f"{path}/a.csv", "w") as f:
        f.write("\n".join([",".join(BAR_ROW_COLUMNS), *(",".join(r.values()) for r in (good, bad, bad)), "short,line"]) + "\n")
    rows, seen = counted(read_checked(spark, path, BARS), ["high", "low", "volume"])
    got = rows.select("symbol", "high", "low", "volume", "bad_line", "bad_cells").collect()
    assert [tuple(r)[:4] for r in got if r.symbol == "A"] == [("A", 1.5, 10.0, None)]
    assert [tuple(r)[:4] for r in got if r.symbol == "B"] == [("B", None, 2.0, None)] * 2
    assert {tuple(sorted(r.bad_cells.items())) for r in got if r.symbol == "B"} == {(("high", "1,5"), ("volume", 'n/a "x" \\'))}
    assert seen.get == {"lines": 5, "bad_lines": 2, "bad_cells": 4, "bad_high": 2, "bad_low": 0, "bad_volume": 2}
    assert {r.bad_line for r in got if r.symbol == "B"} == {",".join(bad.values())}
    assert sorted(tuple(r) for r in bad_cells(rows, "symbol").collect()) == sorted([("B", "high", "1,5"), ("B", "volume", 'n/a "x" \\')] * 2)
    pruned = plan_text(read_checked(spark, path, TITLES, "\t", columns=["modelYear"]).select("vin", "modelYear", "bad_cells"), "simple")
    assert "odometerReading" not in pruned.split("ReadSchema")[-1]


def test_routed_write_reads_its_input_once(spark, scratch):
    source, path = scratch("lines"), scratch("routed")
    A.stage1_lines(spark, SF).write.text(source)
    rows = stock.route_key_value_lines(read_lines(spark, source))
    assert plan_text(rows, "simple").count("FileScan") == 1
    write_routed(rows, path)
    schema = rows.drop("status").schema
    good, bad = (read_routed(spark, path, schema, s) for s in (GOOD, REJECTED))
    assert good.count() + bad.count() == read_lines(spark, source).count() and bad.count() > 0
    assert bad.where("value is null").count() == 0 and good.where("value is not null or sector is null").count() == 0
    assert "status=good" not in str(bad.inputFiles()) or "PartitionFilters" in plan_text(bad, "simple")
    empty = scratch("routed-empty")
    write_routed(routed(spark.range(3), F.lit(None).cast("boolean")), empty)
    assert read_routed(spark, empty, spark.range(1).schema, REJECTED).count() == 3


def test_routed_documents_are_one_scan(spark, scratch):
    path = scratch("docs")
    docs = [{"symbol": "A", "name": "a, b", "stockData": [{"date": "2020-01-01", "close": 1.0, "label": "x, y"}] * 2}, {"symbol": "B", "name": "b, c"}, {"symbol": "C", "stockData": []}]
    spark.createDataFrame([(json.dumps(d),) for d in docs], "value string").write.text(path)
    frame = acquisition.routed_documents(spark.read.schema(COMPANY).json(path))
    assert plan_text(frame, "simple").count("FileScan") == 1
    rows = sorted((r.status, r.value) for r in frame.collect())
    assert [s for s, _ in rows] == [GOOD, GOOD, REJECTED, REJECTED]
    assert rows[0][1].startswith("A,a. b,") and "x. y" in rows[0][1] and json.loads(rows[2][1])["name"] == "b, c"


@pytest.fixture(scope="module")
def bars(spark):
    return A.bar_rows(spark, SF).cache()


def averages(df):
    return {(r.symbol, r.sector, r.periodStart): tuple(None if r[c] is None else round(r[c], 6) for c in AVERAGE_COLUMNS) for r in df.collect()}


def test_merged_sums_are_the_same_for_any_cut(spark, scratch, bars):
    want = averages(stock.symbol_week_report(bars))
    totals = []
    for cut in (1, 3):
        path = scratch("sums")
        part = F.pmod(F.xxhash64("close", "date"), F.lit(cut))
        for k in reversed(range(cut)):
            weekly.insert_bars(bars.where(part == k), path, str(k))
            weekly.insert_bars(bars.where(part == k), path, str(k))  # a retry replaces
        assert averages(weekly.averages_of(weekly.read_sums(spark, path))) == want
        target = scratch("compact")
        weekly.compact(spark, path, target)
        totals.append(sorted(tuple(r)[:-1] for r in weekly.read_sums(spark, target).selectExpr("symbol", "sector", "string(periodStart)", "sumavgLow", "navgVolume", "batch").where("periodStart is not null").collect()))
    assert totals[0] == totals[1]  # exactly, not within a tolerance


def test_sums_of_odd_cells(spark, scratch):
    rows = [("A", "S", "2020-01-06", float("nan"), 1.0), ("A", "S", "2020-01-07", float("inf"), 2.0), ("A", "S", "2020-01-08", 3.0, None)]
    frame = spark.createDataFrame(rows, "symbol string, sector string, date string, high double, low double").withColumns({c: F.lit(None).cast("double") for c in ("open", "close", "volume")})
    path = scratch("odd-sums")
    weekly.insert_bars(frame, path, "x")
    [r] = weekly.averages_of(weekly.read_sums(spark, path)).collect()
    assert (r.avgHigh, r.avgLow, r.avgClose) == (3.0, 1.5, None)


def test_rerun_replaces_only_its_weeks(spark, scratch, bars):
    path = scratch("weeks")
    weekly.write_weeks(stock.symbol_week_report(bars), path)

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(local(path)) for f in names if f.endswith(".parquet")}

    before, old = files(), averages(weekly.read_weeks(spark, path))
    weekly.rerun_weeks(bars.withColumn("close", F.col("close") * 2), path, "1997-03-04", "1997-03-12")
    after, new = files(), averages(weekly.read_weeks(spark, path))
    changed = {f.split("periodStart=")[1][:10] for f in before ^ after}
    assert changed == {"1997-03-03", "1997-03-10"}
    assert {k for k in old if old[k] != new[k]} == {k for k in old if str(k[2]) in changed} and old.keys() == new.keys()


def test_second_rollup_of_a_bucketed_table_has_no_exchange(spark, scratch, bars):
    name = "bucketed_in_test"
    table = weekly.bucketed_stage1(spark, bars, name, scratch("bucketed"), buckets=4)
    try:
        second = sector_week_averages(table)
        plan = plan_text(second, "simple")
        assert "Exchange" not in plan and "Bucketed: true" in plan
        assert second.count() == stock.sector_week_report(bars).count()
    finally:
        spark.sql(f"DROP TABLE {name}")


def test_hot_month_is_joined_in_parts(spark):
    hot = spark.range(3000).select(F.lit("H").alias("symbol"), F.lit("2020-01").alias("page_month"), F.col("id").alias("n"))
    cold = spark.range(3000).select(F.concat(F.lit("S"), F.col("id").cast("string")).alias("symbol"), F.lit("2020-01").alias("page_month"), F.col("id").alias("n"))
    rows = hot.unionByName(cold).unionByName(hot.limit(5)).unionByName(spark.createDataFrame([(None, None, 1)] * 3, "symbol string, page_month string, n long"))
    placed = _with_pages(rows, ["symbol", "page_month"], ["n"], page_rows=10, assume_unique=False, spread_pages=30)
    parts = {r["_part"]: r["count"] for r in placed.where("symbol = 'H'").groupBy("_part").count().collect()}
    assert len(parts) == 11 and max(parts.values()) < 2 * 3000 / 11  # 301 pages in parts of 30
    assert placed.where("symbol <> 'H'").agg(F.max("_part")).first()[0] == 0
    lists = paged_lists(rows, ["symbol", "page_month"], ["n"], "items", page_rows=10, spread_pages=30).cache()
    got = sorted((r.symbol or "", r.n) for r in lists.select("symbol", F.explode("items").alias("x")).select("symbol", "x.n").collect())
    assert got == sorted((r.symbol or "", r.n) for r in rows.collect())
    assert lists.agg(F.max(F.size("items"))).first()[0] < 40
    whole = paged_lists(rows, [], ["symbol", "n"], "items", page_rows=10, spread_pages=30)
    assert whole.columns == ["page", "items"] and sum(len(r["items"]) for r in whole.collect()) == rows.count()
    assert paged_lists(rows.limit(0), [], ["n"], "items").count() == 0
    assert "CartesianProduct" not in (p := plan_text(whole, "simple")) and "NestedLoop" not in p


def test_landing_goes_file_by_file(spark, scratch):
    source, target = local(scratch("source")), scratch("landed")
    os.makedirs(source)
    names = ["a.txt", "b c.txt", "d+e%20.txt", "é.txt", "f.txt"]

    def put(some):
        for n in some:
            with open(f"{source}/{n}", "w") as f:
                f.write(f"{n}\n\nlast {n}\n")

    put(names[:2])
    assert land_files(spark, source, target, "1") == 2
    put(names)
    with open(f"{source}/a.txt", "a") as f:
        f.write("changed later\n")
    assert land_files(spark, source, target, "2") == 3
    assert land_files(spark, source, target, "3") == 0
    assert {r.file: r.run for r in manifest(spark, target).collect()} == {n: "1" if n in names[:2] else "2" for n in names}
    assert sorted((r.file, r.value) for r in read_landed(spark, target).collect()) == sorted((n, v) for n in names for v in (n, "", f"last {n}"))
    # a run that died before its manifest entry: the lines are there but not listed, and land again once
    spark.createDataFrame([("half", "g.txt")], "value string, file string").write.mode("append").partitionBy("file").text(target)
    put(["g.txt"])
    assert "half" not in {r.value for r in read_landed(spark, target).collect()}
    assert land_files(spark, source, target, "4") == 1
    assert sorted(r.value for r in read_landed(spark, target).where("file = 'g.txt'").collect()) == sorted(["g.txt", "", "last g.txt"])


def test_lookup_reads_the_files_of_its_key(spark, scratch, bars):
    path = scratch("indexed")
    stage1 = stock.key_value_stage1(bars)
    write_indexed_lines(stage1, path, ["symbol", "sector", "periodStart"], AVERAGE_COLUMNS)
    index = sorted((r.first, r.last) for r in read_index(spark, path).collect())
    assert len(index) > 1 and all(a[1] <= b[0] for a, b in zip(index, index[1:]))
    inner = next(k for k in sorted(r.symbol for r in stage1.select("symbol").distinct().collect()) if sum(a <= k <= b for a, b in index) == 1)
    found = lookup(spark, path, inner)
    assert len(found.inputFiles()) == 1
    assert found.count() == stage1.where(F.col("symbol") == inner).count()
    assert lookup(spark, path, "no such").count() == 0 and lookup(spark, path, "").count() == 0


def test_commands_on_files(spark, scratch, bars, capsys):
    work = scratch("cli")
    write_bare_csv(A.bar_text(spark, SF), f"{work}/bars")
    spark.createDataFrame([('[{"symbol":"A","name":"n, m","stockData":[{"date":"2020-01-01"}]},\n{"symbol":"B"}]',)], "value string").coalesce(1).write.text(f"{work}/docs")
    main(["stock", f"{work}/bars", f"{work}/sectors"])
    main(["update", f"{work}/bars", f"{work}/sums", f"{work}/updated", "--batch", "one"])
    main(["flatten", f"{work}/docs", f"{work}/flat", "--array", "--routed"])
    main(["land", f"{work}/bars", f"{work}/landed", "--by-file", "first"])
    lines = [line for line in capsys.readouterr().out.splitlines() if "=" in line]
    spoilt = bars.where(F.col("fullTimeEmployees").isin("600", "700")).count()
    assert f"lines={bars.count()} bad_lines={spoilt} bad_cells={spoilt}" in lines[0] and lines[0] == lines[1]
    assert lines[-1].startswith("landed=")
    a, b = (sorted(tuple(r[c] if not isinstance(r[c], float) else round(r[c], 4) for c in ("sector", "periodStart", "avgHigh")) for r in spark.read.csv(f"{work}/{d}", header=True, schema="sector string, periodStart string, avgLow double, avgHigh double, avgClose double, avgOpen double, avgVolume double, avgPrice double").where("periodStart is not null and avgHigh is not null").collect()) for d in ("sectors", "updated"))
    assert [x[:2] for x in a] == [x[:2] for x in b] and all(abs(x[2] - y[2]) < 1e-3 for x, y in zip(a, b))
    assert [r.value for r in spark.read.text(f"{work}/flat/status=rejected").collect()] == ['{"symbol":"B"}']
    assert spark.read.text(f"{work}/flat/status=good").first().value.startswith("A,n. m,")


def test_nesting_has_no_job_while_planning(spark):
    """Wrapped lists are planned without counting rows first."""
    tracker, history = spark.sparkContext.statusTracker(), A.history(spark, SF)  # opening a table reads its schema
    spark.sparkContext.setJobGroup("planning", "planning")
    try:
        paged_lists(spark.range(100).withColumnRenamed("id", "n"), [], ["n"], "items")
        nest_history(history)
        assert list(tracker.getJobIdsForGroup("planning")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def _element_text(spark, path, wrapper=None):
    return sorted(r.value for r in read_array_elements(spark, path, wrapper).collect())


def test_array_elements_are_put_together_over_batches_and_splits(spark, scratch, small_splits):
    """Escapes, braces in strings and text cut off inside a character, whatever a split or an Arrow batch holds."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    folder = local(scratch("batches"))
    os.makedirs(folder)
    docs = [{"i": i, "v": ["\\" * (i % 4) + '"}{', {"a}": [{}, {"b": "]" * (i % 7)}]}], "w": "}" * (40 * (i % 30 == 0))} for i in range(90)]
    text = ",".join(json.dumps(d) for d in docs)
    with open(f"{folder}/a.json", "wb") as f:
        f.write(f"[{text}]".encode())
    with open(f"{folder}/b.json", "wb") as f:
        f.write(f'[{text}, {{"i": "é'.encode()[:-1])
    want = sorted([json.dumps(d) for d in docs] * 2 + ['{"i": "�'])
    try:
        for rows in ("1", "7", "10000"):
            spark.conf.set(key, rows)
            assert _element_text(spark, folder) == want
    finally:
        spark.conf.set(key, before)


def test_arrays_are_written_and_read_without_moving_their_text(spark, scratch):
    """Neither writing nor reading exchanges the rows' text; only the two ends of each split move."""
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffled():
        names = disk.getAllFiles().mkString("\n").split("\n")
        return {f: os.path.getsize(f) for f in names if os.path.basename(f).startswith("shuffle_") and os.path.exists(f)}

    before, path = shuffled(), scratch("arrays-unmoved")
    rows = spark.range(0, 4000, 1, 8).select("id", F.concat(*[F.sha2(F.concat(F.lit(k), "id"), 512) for k in range(4)]).alias("t"))
    write_json_arrays(rows, path, 3)
    files = [os.path.join(d, f) for d, _, names in os.walk(local(path)) for f in names if f.startswith("part-")]
    assert len(files) == 3 and sorted(x["id"] for f in files for x in json.load(open(f))) == list(range(4000))
    docs, _ = read_json_array(spark, path, "id bigint, t string")
    assert sorted(map(tuple, docs.collect())) == sorted(map(tuple, rows.collect()))
    moved = sum(size for f, size in shuffled().items() if f not in before)
    assert moved * 10 < sum(map(os.path.getsize, files))


def test_lines_are_parsed_once(spark):
    docs, rejects = parse_documents(spark.createDataFrame([('{"a": 1}',), ('{"a": "x"}',)], "value string"), "a int")
    assert [plan_text(df, "simple").count("from_json(") for df in (docs, rejects)] == [1, 1]
    assert [r.a for r in docs.collect()] == [1] and [r.value for r in rejects.collect()] == ['{"a": "x"}']


def test_open_text_and_parses_are_made_once(spark, scratch):
    lines = spark.createDataFrame([('{"symbol":"A","x":{"y":1}}',), ('{"symbol":"B"}',), ('{"x":2}',), ("{}",), ("[1]",)], "value string")
    docs = open_documents(lines, INSTRUMENT)
    plan = plan_text(docs.where(F.col("symbol") == "A").select(F.explode(F.array("name"))), "simple")
    assert plan.count("from_json(") == 1 and plan.count("parseJson(") == 1
    assert plan_text(docs.select(open_text(docs)), "simple").count("to_json(struct(") == 1
    written = [r[0] for r in docs.select(open_text(docs)).collect()]
    assert written == ['{"symbol":"A","x":{"y":1}}', '{"symbol":"B"}', '{"x":2}', "{}"]


def test_companies_are_made_once_and_nested_whole(spark):
    bars = [("A", f"2020-{m:02}-01", m) for m in (3, 1, 2)] + [("A", "2020-01-01", 1), ("C", "2020-05-05", 1), (None, "2020-01-01", 1), ("Z", "2020-01-01", 1)]
    history = spark.createDataFrame(bars, "symbol string, date string, n int")
    members = spark.createDataFrame([("A",), ("B",), ("B",), ("C",), (None,), ("D",)], "symbol string")
    companies = keep_members(spark.createDataFrame([("A", "a"), ("A", "a2"), ("B", "b"), ("C", "c"), (None, "n"), ("X", "x")], "symbol string, name string"), members)
    bars_of = keep_members(history, members)
    pages = nest_history(bars_of, by_month=False)
    once, twice = (attach_history(companies, pages, history=bars_of, keys=keys) for keys in (members, None))
    rows = sorted((r.symbol, r.name, [tuple(b) for b in r.stockData or []]) for r in once.collect())
    a = [("2020-03-01", 3), ("2020-02-01", 2), ("2020-01-01", 1), ("2020-01-01", 1)]
    assert rows == [("A", "a", a), ("A", "a2", a), ("B", "b", []), ("C", "c", [("2020-05-05", 1)])]
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    months = attach_history(companies, nest_history(bars_of), history=bars_of, keys=members)
    flat = lambda docs: sorted(map(str, docs.select("symbol", "name", F.explode_outer("stockData")).collect()))
    assert flat(months) == flat(once)
    long = spark.range(400).select(F.lit("H").alias("symbol"), F.date_add(F.lit("2020-01-01").cast("date"), F.col("id").cast("int")).cast("string").alias("date"), F.col("id").alias("n"))
    paged = nest_history(long, page_rows=20, by_month=False).collect()
    assert len(paged) > 10 and max(len(r.stockData) for r in paged) < 60 and sorted(b.n for r in paged for b in r.stockData) == list(range(400))
    assert {r.page_month for r in paged} == {None} and all(r.stockData == sorted(r.stockData, reverse=True) for r in paged)

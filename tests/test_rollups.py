import datetime as dt

import pytest

from tickweek.operators.clean import clean_bars
from tickweek.operators.rollups import grouped_averages, prepare_bars, SYMBOL_MEASURES
from tickweek.plans.stock import grouped_bag_report, sector_week_report, symbol_week_report

# Six invented bars: symbol, sector, date, open, high, low, close, volume.
BARS = [
    ("AAA", "Toys", "2021-03-05", 10.5, 12.5, 10.0, 12.0, 300.0),
    ("AAA", "Toys", "2021-03-04", 11.0, 13.0, 10.5, 11.5, 500.0),
    ("AAA", "Toys", "2021-03-02", 13.0, 13.5, 12.5, 13.1, 100.0),
    ("BBB", "Boats", "2021-03-05", 200.0, 206.0, 198.0, 201.0, 40.0),
    ("BBB", "Boats", "2021-03-03", 202.0, 204.0, 200.0, 202.0, 50.0),
    ("BBB", "Boats", "2021-03-01", 204.0, 208.0, 196.0, 203.0, 90.0),
]
SCHEMA = "symbol string, sector string, date string, open double, high double, low double, close double, volume double"


@pytest.fixture()
def bars(spark):
    edge = [
        ("symbol", "sector", "date", None, None, None, None, None),  # header line read as data
        ("ABC", "", "2022-12-28", 1.0, 1.0, 1.0, 1.0, 1.0),  # empty sector
        ("DEF", None, "2022-12-28", 1.0, 1.0, 1.0, 1.0, 1.0),  # NULL sector
    ]
    return spark.createDataFrame(BARS + edge, SCHEMA)


def test_symbol_week_golden(bars):
    rows = {r.symbol: r for r in symbol_week_report(bars).collect()}
    assert set(rows) == {"AAA", "BBB"}
    assert rows["AAA"].sector == "toys" and rows["AAA"].periodStart == dt.date(2021, 3, 1)
    assert rows["BBB"].sector == "boats"
    golden = {  # low, high, close, open, volume, mid; by hand
        "AAA": (11.0, 13.0, 12.2, 11.5, 300.0, 12.0),
        "BBB": (198.0, 206.0, 202.0, 202.0, 60.0, 202.0),
    }
    for sym, vals in golden.items():
        r = rows[sym]
        got = (r.avgLow, r.avgHigh, r.avgClose, r.avgOpen, r.avgVolume, r.avgPrice)
        assert [round(v, 6) for v in got] == pytest.approx(list(vals), abs=1e-6)


def test_sector_week_one_symbol_per_sector_equals_stage1(bars):
    s1 = {r.sector: r.avgPrice for r in symbol_week_report(bars).collect()}
    s2 = {r.sector: r.avgPrice for r in sector_week_report(bars).collect()}
    assert s1 == pytest.approx(s2)


def test_average_of_averages_not_flat(spark):
    rows = [("A", "s", "2022-12-27", 1.0, 1.0, 1.0, 1.0, 1.0), ("A", "s", "2022-12-28", 3.0, 3.0, 3.0, 3.0, 3.0),
            ("B", "s", "2022-12-28", 10.0, 10.0, 10.0, 10.0, 10.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    r = sector_week_report(df).first()
    assert r.avgLow == pytest.approx(6.0)
    flat = df.groupBy().avg("low").first()[0]
    assert flat == pytest.approx(4.666667, abs=1e-6)


def test_filter_drops_header_and_sectorless(bars):
    kept = clean_bars(bars).select("symbol").distinct().collect()
    assert sorted(r[0] for r in kept) == ["AAA", "BBB"]


def test_default_zero_for_all_null_group(spark):
    rows = [("A", "s", "2022-12-28", 1.0, 1.0, 1.0, 1.0, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert symbol_week_report(df).first().avgVolume is None
    assert symbol_week_report(df, default=0.0).first().avgVolume == 0.0


def test_bad_date_is_its_own_null_week(spark):
    rows = [("A", "s", "not a date", 1.0, 1.0, 1.0, 1.0, 1.0), ("A", "s", "2022-12-28", 3.0, 3.0, 3.0, 3.0, 3.0)]
    out = {r.periodStart: r.avgLow for r in symbol_week_report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert out == {None: 1.0, dt.date(2022, 12, 26): 3.0}


def test_grouped_bag_form_equals_dataframe_form(bars):
    a = sorted(tuple(r) for r in sector_week_report(bars).collect())
    b = sorted(tuple(r) for r in grouped_bag_report(bars).select(*sector_week_report(bars).columns).collect())
    assert a == b


def test_struct_group_is_flattened(bars):
    prepared = prepare_bars(clean_bars(bars))
    out = grouped_averages(prepared, ["symbol", "sector", "periodStart"], SYMBOL_MEASURES)
    assert out.columns[:3] == ["symbol", "sector", "periodStart"]


def test_range_filter_tolerates_bad_text(spark):
    from tickweek.operators.clean import within

    df = spark.createDataFrame([("2017-01-01",), ("2023-01-01",), ("2016-12-31",), ("not a date",), (None,)], "date string")
    assert [r.date for r in within(df, "date", "2017-01-01", "2023-01-01").collect()] == ["2017-01-01", "2023-01-01"]


def test_hot_symbol_third_of_rows(spark):
    """One symbol holds a third of all rows: results stay exact and the rollup
    combines it map-side (partial average before the first exchange)."""
    from tickweek.plans.explain import plan_text

    rows = []
    for i in range(3000):
        symbol = "HOT" if i % 3 == 0 else f"S{i % 97}"
        day = 26 + i % 5  # Monday 2022-12-26 .. Friday 2022-12-30
        rows.append((symbol, "Tech" if symbol == "HOT" else "Energy", f"2022-12-{day}", 1.0, 2.0, float(i % 10), 1.0, 1.0))
    df = spark.createDataFrame(rows, SCHEMA).repartition(8)
    out = {r.sector: r.avgLow for r in sector_week_report(df).collect()}
    hot = [r[5] for r in rows if r[0] == "HOT"]
    assert out["tech"] == pytest.approx(sum(hot) / len(hot))
    plan = plan_text(sector_week_report(df), "simple")
    first_exchange = plan.rfind("Exchange hashpartitioning(symbol")
    assert "partial_avg" in plan[first_exchange:]

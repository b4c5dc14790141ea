"""Property tests with generated inputs (few examples: each one runs Spark jobs)."""

import collections
import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickweek.functions import normalise_sector, week_start
from tickweek.operators.enrich import paged_lists

SETTINGS = settings(max_examples=6, deadline=None)
texts = st.text(alphabet=st.sampled_from(list("aB c\t_,.X")), max_size=12)


@SETTINGS
@given(st.lists(texts, min_size=1, max_size=20))
def test_sector_normalisation_properties(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    rows = df.select(
        normalise_sector("s").alias("a"),
        normalise_sector(normalise_sector("s")).alias("aa"),
        normalise_sector("s", "whitespace").alias("w"),
    ).collect()
    for v, r in zip(values, rows):
        assert r.a == r.aa == v.replace(" ", "_").lower()
        assert not any(ch.isspace() for ch in r.w) and len(r.w) == len(v)


@SETTINGS
@given(st.lists(st.integers(min_value=-30000, max_value=60000), min_size=1, max_size=30))
def test_week_start_is_a_monday_within_a_week(spark, offsets):
    df = spark.createDataFrame([(dt.date(1900, 1, 1) + dt.timedelta(days=o),) for o in offsets], "d date")
    for r in df.select("d", week_start("d", "pmod").alias("w")).collect():
        assert r.w.weekday() == 0 and 0 <= (r.d - r.w).days <= 6


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.integers(0, 3), st.integers(1, 40)), min_size=1, max_size=8),
    st.integers(min_value=1, max_value=5),
)
def test_paging_keeps_every_row(spark, groups, page_rows):
    rows = [(k, v) for k, v, copies in groups for _ in range(copies)]
    df = spark.createDataFrame(rows, "k string, v int")
    pages = paged_lists(df, ["k"], ["v"], "items", page_rows=page_rows)
    out = pages.select("k", F.explode("items").alias("i")).select("k", "i.v").collect()
    assert collections.Counter(map(tuple, out)) == collections.Counter(rows)
    sizes = [r[0] for r in pages.select(F.size("items")).collect()]
    distinct_per_page = max(len(set(r[0])) for r in pages.select(F.transform("items", lambda x: x.v)).collect())
    assert max(sizes) <= page_rows * (distinct_per_page + 1)


def _brute_force_sector_weeks(rows):
    """The stock job's rules in plain Python: clean, normalise, Monday week, two averages."""
    per_symbol = collections.defaultdict(list)
    for symbol, sector, date, low in rows:
        if symbol is None or sector is None or symbol == "symbol" or sector == "":
            continue
        try:
            d = dt.date.fromisoformat(date) if date and len(date) == 10 else None
        except ValueError:
            d = None
        week = d - dt.timedelta(days=d.weekday()) if d else None
        per_symbol[(symbol, sector.replace(" ", "_").lower(), week)].append(low)
    per_sector = collections.defaultdict(list)
    for (symbol, sector, week), lows in per_symbol.items():
        vals = [v for v in lows if v is not None]
        per_sector[(sector, week)].append(sum(vals) / len(vals) if vals else None)
    out = {}
    for key, avgs in per_sector.items():
        vals = [v for v in avgs if v is not None]
        out[key] = sum(vals) / len(vals) if vals else None
    return out


@SETTINGS
@given(
    st.lists(
        st.tuples(
            st.sampled_from(["A", "B", "symbol", None]),
            st.sampled_from(["Real Estate", "energy", "", None, "A  B"]),
            st.sampled_from(["2022-12-26", "2022-12-30", "2023-01-02", "1899-12-31", "not a date", None]),
            st.one_of(st.none(), st.integers(0, 1000).map(float)),
        ),
        min_size=1,
        max_size=40,
    )
)
def test_sector_weeks_match_brute_force(spark, rows):
    from tickweek.plans.stock import sector_week_report

    schema = "symbol string, sector string, date string, low double"
    df = spark.createDataFrame(rows, schema).select(
        "*", *[F.col("low").alias(c) for c in ("high", "close", "open", "volume")]
    )
    got = {(r.sector, r.periodStart): r.avgLow for r in sector_week_report(df).collect()}
    want = _brute_force_sector_weeks(rows)
    assert set(got) == set(want)
    for key, value in want.items():
        assert (got[key] is None and value is None) or abs(got[key] - value) < 1e-9


@SETTINGS
@given(
    st.lists(
        st.tuples(
            st.sampled_from([100.0, 0.0, -5.0, None]),
            st.sampled_from([1900, 1950, 1975, 2010, 2016, None]),
            st.sampled_from(["2020-06-15", "2015-01-01", "1899-12-31", "unknown", None]),
        ),
        min_size=1,
        max_size=30,
    ),
    st.booleans(),
)
def test_vehicle_report_matches_brute_force(spark, rows, sql_null_band):
    from tickweek.plans.vehicles import vehicle_report

    df = spark.createDataFrame(rows, "vehicleCost double, modelYear int, purchaseDate string")
    got = sorted(
        (tuple(r) for r in vehicle_report(df, null_band="Classic" if sql_null_band else None).collect()),
        key=repr,
    )
    want = []
    for cost, year, text in rows:
        if cost is None or year is None or not (cost > 0 and year > 1900):
            continue
        d = dt.date.fromisoformat(text) if text and text[0].isdigit() else None
        age = d.year - year if d else None
        days = (d - dt.date(1900, 1, 1)).days if d else None
        week = d - dt.timedelta(days=int(days - 7 * int(days / 7))) if d else None  # signed remainder
        if age is None:
            band = "Classic" if sql_null_band else None
        else:
            band = "New" if age < 8 else ("Old" if age <= 40 else "Classic")
        want.append((d, year, age, week, band))
    assert got == sorted(want, key=repr)

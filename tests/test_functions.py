import datetime as dt

from pyspark.sql import functions as F

from tickweek.functions import (
    comma_to_dot,
    day_of_week,
    duration_days,
    mid_price,
    normalise_sector,
    parse_date,
    subtract_duration,
    vehicle_age,
    wear_and_tear,
    week_start,
)


def test_sector_lower_replaces_spaces_only(spark):
    df = spark.createDataFrame([("Real Estate",), ("Basic  Materials",), ("Tab\tSector",), (None,)], "s string")
    got = [r[0] for r in df.select(normalise_sector("s")).collect()]
    assert got == ["real_estate", "basic__materials", "tab\tsector", None]


def test_sector_whitespace_keeps_case(spark):
    df = spark.createDataFrame([("Real Estate",), ("Tab\tSector",), ("A  B",)], "s string")
    got = [r[0] for r in df.select(normalise_sector("s", "whitespace")).collect()]
    assert got == ["Real_Estate", "Tab_Sector", "A__B"]


def test_week_variants_agree_from_1900_and_differ_before(spark):
    days = spark.range(0, 55152).select(F.date_add(F.lit(dt.date(1880, 1, 1)), F.col("id").cast("int")).alias("d"))
    out = days.select(
        "d",
        week_start("d", "weekday").alias("w1"),
        week_start("d", "pmod").alias("w2"),
        week_start("d", "truncated").alias("w3"),
        week_start("d", "duration").alias("w4"),
    )
    assert out.where("w1 != w2").count() == 0
    assert out.where("weekday(w2) != 0").count() == 0
    assert out.where("w3 != w4").count() == 0
    assert out.where("d >= DATE'1900-01-01' AND w3 != w2").count() == 0
    before = out.where("w3 != w2")
    assert before.where("d >= DATE'1900-01-01'").count() == 0
    # Before the origin the signed remainder lands on the next Monday.
    assert before.where("datediff(w3, w2) != 7").count() == 0
    assert before.count() > 0


def test_week_before_origin_golden(spark):
    df = spark.createDataFrame([(dt.date(1899, 12, 31),)], "d date")
    row = df.select(week_start("d", "pmod").alias("p"), week_start("d", "truncated").alias("t")).first()
    assert row.p == dt.date(1899, 12, 25)
    assert row.t == dt.date(1900, 1, 1)


def test_parse_date_is_strict_iso(spark):
    df = spark.createDataFrame([("2022-12-30",), ("not a date",), ("2022-02-30",), ("2022-1-5",), (None,)], "s string")
    assert [r[0] for r in df.select(parse_date("s")).collect()] == [dt.date(2022, 12, 30), None, None, None, None]


def test_parse_date_other_pattern(spark):
    df = spark.createDataFrame([("30/12/2022",), ("x",)], "s string")
    assert [r[0] for r in df.select(parse_date("s", "dd/MM/yyyy")).collect()] == [dt.date(2022, 12, 30), None]


def test_day_of_week_monday_is_one(spark):
    df = spark.createDataFrame([(dt.date(2022, 12, 26),), (dt.date(2023, 1, 1),)], "d date")
    assert [r[0] for r in df.select(day_of_week("d")).collect()] == [1, 7]


def test_duration_text(spark):
    df = spark.createDataFrame([("P3D",), ("P-2D",), ("3D",), (None,)], "s string")
    assert [r[0] for r in df.select(duration_days("s")).collect()] == [3, -2, None, None]
    one = spark.createDataFrame([(dt.date(2022, 12, 29), "P3D")], "d date, p string")
    assert one.select(subtract_duration("d", "p")).first()[0] == dt.date(2022, 12, 26)


def test_mid_price_casts_text(spark):
    df = spark.createDataFrame([("51.4", "50.75"), ("x", "1")], "h string, l string")
    assert [r[0] for r in df.select(mid_price("h", "l")).collect()] == [51.075, None]


def test_wear_and_tear_golden(spark):
    # (modelYear, purchaseDate) -> (age, band), from the fixture table.
    rows = [
        (2013, "2020-06-15", 7, "New"),
        (2010, "2018-03-04", 8, "Old"),
        (1975, "2015-01-01", 40, "Old"),
        (1974, "2015-01-01", 41, "Classic"),
        (2016, "2015-01-01", -1, "New"),
        (2000, None, None, "Classic"),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "y int, p string")
    got = df.select(vehicle_age(F.col("p").cast("date"), "y").alias("a")).select("a", wear_and_tear("a").alias("b")).collect()
    assert [(r.a, r.b) for r in got] == [(r[2], r[3]) for r in rows]
    nulls = df.select(vehicle_age(F.col("p").cast("date"), "y").alias("a")).select(wear_and_tear("a", null_band=None))
    assert nulls.collect()[-1][0] is None


def test_comma_to_dot_only_text(spark):
    df = spark.createDataFrame([("Dr. A, Ph.D.", 1.5, "December 30, 22")], "ceo string, v double, label string")
    row = comma_to_dot(df).first()
    assert row.ceo == "Dr. A. Ph.D." and row.v == 1.5 and row.label == "December 30. 22"


def test_array_helpers(spark):
    from tickweek.functions import contains, field_of_each, first_element

    df = spark.createDataFrame([([("MMM", "3M"), ("BRK.B", "Berkshire")],), ([],)], "companies array<struct<symbol:string,name:string>>")
    rows = df.select(
        field_of_each("companies", "symbol").alias("symbols"),
        first_element("companies").alias("first"),
        contains(field_of_each("companies", "symbol"), "BRK.B").alias("has"),
    ).collect()
    assert rows[0].symbols == ["MMM", "BRK.B"] and rows[0].first.symbol == "MMM" and rows[0].has is True
    assert rows[1].symbols == [] and rows[1].first is None and rows[1].has is False


def test_field_splits_on_regex(spark):
    from tickweek.functions import field

    df = spark.createDataFrame([("A,b c\td",)], "s string")
    row = df.select(field("s", ",", 1).alias("x"), field("s", r"\s", 2).alias("y"), field("s", ",", 5).alias("z")).first()
    assert row.x == "b c\td" and row.y == "d" and row.z is None

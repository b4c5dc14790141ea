import pytest
import collections

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickweek.operators.enrich import (
    attach_history,
    documents_without_bars,
    first_record,
    flatten_documents,
    keep_members,
    merge_right_wins,
    nest_history,
    paged_lists,
)
from tickweek.schemas import PROFILE

HISTORY_SCHEMA = "symbol string, date string, close double"


def test_semi_join_never_duplicates(spark):
    items = spark.createDataFrame([("A", 1), ("B", 2), ("C.X", 3)], "symbol string, v int")
    members = spark.createDataFrame([("A",), ("A",), ("C.X",), ("Z",)], "symbol string")
    assert sorted(tuple(r) for r in keep_members(items, members).collect()) == [("A", 1), ("C.X", 3)]


def test_present_fields_win(spark):
    left = spark.createDataFrame([(k, "left-name", 1.0) for k in "ABCDE"], "symbol string, name string, price double")
    bodies = spark.createDataFrame(
        [
            ("A", '[{"symbol":"A","companyName":"Co"}]'),
            ("B", '[{"symbol":"B","name":null,"price":2.0}]'),
            ("C", "[]"),
            ("D", '[{"name":"zz-first"},{"name":"aa-second"}]'),
        ],
        "symbol string, body string",
    )
    rows = {r.symbol: r for r in merge_right_wins(left, first_record(bodies, "body", PROFILE, present=True)).collect()}
    assert {k: (r.name, r.price) for k, r in rows.items()} == {
        "A": ("left-name", 1.0),
        "B": (None, 2.0),
        "C": ("left-name", 1.0),
        "D": ("zz-first", 1.0),
        "E": ("left-name", 1.0),
    }
    assert rows["A"].companyName == "Co" and "__present" not in rows["A"]


def test_repeated_body_is_an_error(spark):
    bodies = spark.createDataFrame([("A", "[]"), ("A", "[]")], "symbol string, body string")
    with pytest.raises(Exception, match="several bodies"):
        first_record(bodies, "body", PROFILE).collect()


def test_absent_values_of_records_keep_the_left(spark):
    left = spark.createDataFrame([("A", "a-name", 1.0), ("B", "b-name", 2.0)], "symbol string, name string, price double")
    right = spark.createDataFrame([("A", None, "US")], "symbol string, name string, country string")
    rows = {r.symbol: r for r in merge_right_wins(left, right).collect()}
    assert rows["A"].name == "a-name" and rows["A"].country == "US" and rows["A"].price == 1.0
    assert rows["B"].name == "b-name" and rows["B"].country is None


def test_first_record_of_body(spark):
    bodies = spark.createDataFrame(
        [("A", '[{"symbol":"A","companyName":"first"},{"companyName":"second"}]'), ("B", "[]"), ("C", "not json"), ("D", None)],
        "symbol string, body string",
    )
    rows = first_record(bodies, "body", PROFILE).collect()
    assert [(r.symbol, r.companyName) for r in rows] == [("A", "first")]
    assert "symbol" == first_record(bodies, "body", PROFILE).columns[0]


def _history(spark, rows):
    return spark.createDataFrame(rows, HISTORY_SCHEMA)


def _multiset(rows):
    return collections.Counter(tuple(r) for r in rows)


def test_inline_of_nest_is_identity(spark):
    rows = [("A", f"2022-{m:02d}-{d:02d}", float(m * 100 + d)) for m in (1, 2) for d in range(1, 20)]
    rows += [("B", "2022-01-03", 1.0), ("B", "2022-01-03", 1.0)]  # an exact copy stays a copy
    hist = _history(spark, rows)
    pages = nest_history(hist, page_rows=7)
    flat = pages.select("symbol", F.explode("stockData").alias("b")).select("symbol", "b.date", "b.close")
    assert _multiset(flat.collect()) == _multiset(rows)
    # Bars inside a page are newest first.
    for p in pages.collect():
        dates = [b.date for b in p.stockData]
        assert dates == sorted(dates, reverse=True)


def test_hot_key_and_copies_stay_bounded(spark):
    page_rows = 50
    hot = [("HOT", "2022-01-03", 1.0)] * 2000  # one bar copied 2000 times
    hot += [("HOT", "2022-01-04", float(i)) for i in range(700)]
    cold = [("COLD", "2022-01-05", 2.0)]
    pages = nest_history(_history(spark, hot + cold), page_rows=page_rows)
    sizes = [r[0] for r in pages.select(F.size("stockData")).collect()]
    assert sum(sizes) == len(hot) + len(cold)
    assert max(sizes) <= 3 * page_rows
    assert len([s for s in sizes]) >= (len(hot) // page_rows)


def test_paged_lists_without_keys(spark):
    df = spark.createDataFrame([(f"S{i}", f"n{i}") for i in range(23)] + [("S0", "n0")] * 5, "symbol string, name string")
    pages = paged_lists(df, [], ["symbol", "name"], "companies", page_rows=4)
    sizes = [r[0] for r in pages.select(F.size("companies")).collect()]
    assert sum(sizes) == 28 and max(sizes) <= 12
    back = pages.select(F.inline("companies"))
    assert _multiset(back.collect()) == _multiset(df.collect())


def test_documents_and_rejects(spark):
    companies = spark.createDataFrame([("A", "a"), ("B", "b")], "symbol string, name string")
    hist = _history(spark, [("A", "2022-12-30", 1.0), ("A", "2022-12-29", 2.0), ("Z", "2022-12-29", 9.0)])
    docs = attach_history(companies, nest_history(hist))
    rejects = documents_without_bars(docs).select("symbol").collect()
    assert [r[0] for r in rejects] == ["B"]
    flat = flatten_documents(docs, ["symbol", "name"], ["date", "close"])
    assert sorted(tuple(r) for r in flat.collect()) == [("A", "a", "2022-12-29", 2.0), ("A", "a", "2022-12-30", 1.0)]
    # Same rejects when the anti join reads the raw history keys.
    docs2 = attach_history(companies, nest_history(hist), history=hist)
    assert [r[0] for r in documents_without_bars(docs2).select("symbol").collect()] == ["B"]


def test_rejects_plan_skips_nesting(spark):
    companies = spark.createDataFrame([("A", "a")], "symbol string, name string")
    hist = _history(spark, [("A", "2022-12-30", 1.0)])
    docs = attach_history(companies, nest_history(hist), history=hist)
    plan = documents_without_bars(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan


def test_profile_schema_is_struct():
    assert isinstance(PROFILE, StructType)


def test_huge_copy_run_is_expanded_in_blocks(spark, monkeypatch):
    import tickweek.operators.enrich as E

    monkeypatch.setattr(E, "CHUNK_BLOCK", 3)  # force the two-level path
    rows = [("HOT", "2022-01-03", 1.0)] * 100 + [("HOT", "2022-01-04", 2.0)]
    pages = E.nest_history(_history(spark, rows), page_rows=4)
    sizes = [r[0] for r in pages.select(F.size("stockData")).collect()]
    assert sum(sizes) == 101 and max(sizes) <= 8
    flat = pages.select("symbol", F.explode("stockData").alias("b")).select("symbol", "b.date", "b.close")
    assert _multiset(flat.collect()) == _multiset(rows)


def test_null_keys_keep_their_rows(spark):
    rows = [("A", None, 1.0), ("A", "2022-01-03", 2.0), (None, "2022-01-03", 3.0)]
    pages = nest_history(_history(spark, rows), page_rows=2)
    flat = pages.select("symbol", F.explode("stockData").alias("b")).select("symbol", "b.date", "b.close")
    assert _multiset(flat.collect()) == _multiset(rows)


def test_one_per_key_is_deterministic(spark):
    from tickweek.operators.enrich import one_per_key

    df = spark.createDataFrame([("A", "z", 2), ("A", "b", 9), ("B", None, 1)], "symbol string, name string, n int")
    assert sorted(tuple(r) for r in one_per_key(df).collect()) == [("A", "b", 9), ("B", None, 1)]


def test_assume_unique_keeps_rows_and_skips_a_shuffle(spark):
    from tickweek.plans.explain import plan_text

    rows = [("A", f"2022-01-{d:02d}", float(d)) for d in range(1, 29)] + [("B", "2022-02-01", 1.0), ("B", "2022-02-01", 1.0)]
    hist = _history(spark, rows)
    fast = nest_history(hist, page_rows=5, assume_unique=True)
    flat = fast.select("symbol", F.explode("stockData").alias("b")).select("symbol", "b.date", "b.close")
    assert _multiset(flat.collect()) == _multiset(rows)  # even the copies the promise did not cover
    counted = plan_text(nest_history(hist, page_rows=5), "simple").count("Exchange")
    assert plan_text(fast, "simple").count("Exchange") < counted

"""What joins and nesting move: rows are dealt by symbol once, before they are widened, and paged where they lie."""

import collections
import re

import pytest
from pyspark.sql import functions as F

from tickweek.operators.enrich import keep_members, nest_history, paged_lists
from tickweek.plans.explain import plan_text
from tickweek.sources import adapters as A

SF = "/root/testdata/sf0.001"


def _rows(df):
    return collections.Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("table", [A.history, A.profile_bodies])
def test_rows_by_symbol_are_joined_where_they_lie(spark, table):
    dealt = table(spark, SF, by_symbol=True)
    members = A.members(spark, SF)
    alone, joined = (plan_text(df, "simple").count("Exchange hashpartitioning") for df in (dealt, keep_members(dealt, members)))
    assert joined == alone + 1  # the members'
    assert _rows(dealt) == _rows(table(spark, SF))


def test_nesting_members_moves_the_bars_once(spark):
    members = A.members(spark, SF)
    pages = nest_history(keep_members(A.history(spark, SF, by_symbol=True), members))
    pages.write.format("noop").mode("overwrite").save()
    rows = pages.collect()
    plan = pages._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "isFinalPlan=true" in final
    # two of the line items (all columns; keys for the large symbols), two of the members, those symbols' list
    assert len(re.findall(r"(?<!Reused)Exchange hashpartitioning", final)) <= 4, final
    assert sum(len(r.stockData) for r in rows) == keep_members(A.history(spark, SF), members).count()


def _pages(df):
    items = F.array_sort("items")
    return sorted((str(r.k), r.m, r.page, str(r["items"])) for r in df.select("k", "m", "page", items.alias("items")).collect())


def test_pages_in_place_are_those_of_the_spread_path(spark, monkeypatch):
    import tickweek.operators.enrich as E

    monkeypatch.setattr(E, "CHUNK_BLOCK", 3)
    rows = [("A", m, v) for m in (1, 2) for v in range(40)] + [("A", 1, 7)] * 90 + [("B", 1, 1)] * 3 + [(None, 1, v) for v in range(9)] + [(None, 2, 5)] * 30
    df = spark.createDataFrame(rows, "k string, m int, v int")
    in_place = paged_lists(df, ["k", "m"], ["v"], "items", page_rows=4)
    spread = paged_lists(df, ["k", "m"], ["v"], "items", page_rows=4, spread_pages=1)  # A and NULL are large
    assert _pages(in_place) == _pages(spread)
    assert _rows(in_place.select("k", "m", F.explode("items.v"))) == collections.Counter(rows)


def test_inserts_read_the_bars_of_one_join(spark, monkeypatch):
    from tickweek.plans import registry_files, weekly

    insert, plans = weekly.insert_bars, []

    def seen(bars, path, batch):
        plans.append(plan_text(bars, "simple"))
        insert(bars, path, batch)

    monkeypatch.setattr(weekly, "insert_bars", seen)
    assert registry_files.merged_inserts(spark, SF).count() > 0
    assert len(plans) == 3 and not any("Join" in p for p in plans)

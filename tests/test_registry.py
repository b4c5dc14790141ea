import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from tickweek.plans import registry
from tickweek.plans.explain import explain_extended

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    return v.isoformat() if hasattr(v, "isoformat") else repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_every_query_has_oracle():
    assert set(registry.queries()) == set(registry.oracle_sql())
    assert set(registry.queries()) <= set(entry_mod.queries())


def test_entry_runs(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["sector", "periodStart", "avgLow", "avgHigh", "avgClose", "avgOpen", "avgVolume", "avgPrice"]
    assert df.count() > 0


def test_explain_is_one_plan_row(spark):
    spark.range(3).createOrReplaceTempView("three_numbers")
    rows = explain_extended(spark, "SELECT id + 1 AS next FROM three_numbers WHERE id > 0").collect()
    assert len(rows) == 1 and "Physical Plan" in rows[0].plan


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry_mod.queries()[name](spark, SF)
    rows = df.collect()
    res = duck.execute(entry_mod.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)

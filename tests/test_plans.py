"""Plan-level properties of the registered queries (checked on sf0.001)."""

import pytest

import __spark_entry__ as entry_mod
from tickweek.plans.explain import plan_text
from tickweek.sources import adapters as A
from tickweek.plans import stock

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "LocalCheckpoint"]


@pytest.mark.parametrize("name", sorted(entry_mod.queries()))
def test_no_cross_join_or_python_udf(spark, name):
    plan = plan_text(entry_mod.queries()[name](spark, SF), "extended")
    for op in FORBIDDEN:
        assert op not in plan, f"{name} plans {op}"


def test_flagship_prunes_columns_and_aggregates_partially(spark):
    plan = plan_text(entry_mod.entry(spark), "formatted")
    assert plan.count("partial_avg") >= 12  # six averages in each of the two rollups
    lineitem_schema = [line for line in plan.splitlines() if line.startswith("ReadSchema: struct<l_")][0]
    for unused in ("l_returnflag", "l_linestatus", "l_orderkey", "l_suppkey", "l_linenumber"):
        assert unused not in lineitem_schema
    assert "PushedFilters: [IsNotNull(p_partkey)" in plan or "IsNotNull(p_partkey)" in plan


def test_two_rollups_are_two_aggregation_exchanges(spark):
    bars = A.bar_rows(spark, SF)
    plan = plan_text(stock.sector_week_report(bars), "simple")
    assert "hashpartitioning(symbol" in plan and "hashpartitioning(sector" in plan


def test_key_value_sort_is_range_partitioned(spark):
    from pyspark.sql import functions as F

    df = stock.key_value_stage1(A.bar_rows(spark, SF)).orderBy("symbol", "sector", "periodStart")
    assert "rangepartitioning" in plan_text(df.select(F.lit(1)), "simple")


def test_vehicle_job_is_map_only(spark, scratch):
    from tickweek.plans.vehicles import vehicle_report
    from tickweek.sinks.files import write_delimited
    from tickweek.sources.files import read_titles

    path = scratch("titles-plan")
    write_delimited(A.titles(spark, SF), path, "\t", header=False)
    plan = plan_text(vehicle_report(read_titles(spark, path)), "simple")
    assert "Exchange" not in plan
    assert "PushedFilters: [IsNotNull(vehicleCost), IsNotNull(modelYear)" in plan
    scan = [line for line in plan.splitlines() if "FileScan csv" in line][0]
    assert scan.split("[", 1)[1].split("]", 1)[0].replace("#", " ").split(",").__len__() == 3  # pruned to 3 columns

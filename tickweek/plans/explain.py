"""Plan inspection: ``EXPLAIN EXTENDED`` as a one-row, one-column result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def explain_extended(spark: SparkSession, query: str, args: dict | None = None) -> DataFrame:
    """Parsed, analysed, optimised and physical plans of ``query`` in a
    single ``plan`` string; the query itself is not run."""
    return spark.sql(f"EXPLAIN EXTENDED {query}", args=args)


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The plan of a DataFrame as text (``simple``, ``extended``, ``formatted``, ``cost``)."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)

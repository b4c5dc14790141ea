"""DuckDB SQL for the queries of ``plans.registry_files``, over the same adapter views as ``plans.oracle``."""

from __future__ import annotations

from tickweek.fixed import AVERAGE_COLUMNS
from tickweek.plans import oracle as o

# Fields that no schema declares, per order; see ``sources.adapters``.
OPEN = """
SELECT CAST(o_orderkey AS VARCHAR) AS symbol, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS listed,
       CASE WHEN c_acctbal > 0 AND o_orderkey % 3 = 0 THEN 'G' || n_regionkey
            WHEN c_acctbal > 0 AND o_orderkey % 2 = 0 THEN NULL
            WHEN o_orderkey % 5 = 0 THEN 'none' END AS grade,
       CASE WHEN c_acctbal > 0 AND o_orderkey % 3 = 0 THEN o_orderkey % 7 END AS score,
       CASE WHEN c_acctbal > 0 THEN n_name END AS second_tag,
       'listed'
         || CASE WHEN o_orderkey % 5 = 0 OR (c_acctbal > 0 AND (o_orderkey % 2 = 0 OR o_orderkey % 3 = 0)) THEN ',rating' ELSE '' END
         || CASE WHEN c_acctbal > 0 THEN ',tags' ELSE '' END AS extra_names
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""


def oracle_sql() -> dict[str, str]:
    base = o.oracle_sql()
    companies = o._with("instruments", "members", "profile", "history", "listed", "companies")
    sized = "SELECT b.*, p_size FROM bars b JOIN part ON isin = 'US' || lpad(CAST(p_partkey AS VARCHAR), 10, '0')"
    bad_volume = "'n/a, \"x\" ' || chr(92)"
    titles = o._with("titles")
    keyed = o._symbol_week(o._stock_prepared(o.WHITESPACE, "weekday"), default=True)
    rounded = ", ".join(o.r(c, c) for c in AVERAGE_COLUMNS)
    return {
        "json_array_parallel": base["profile_left_join"],
        "json_wrapped_parallel": base["json_companies_inline"],
        "json_array_rejects": o._with("instruments")
        + """SELECT '{"symbol":"' || symbol || '","name":"' || name || '","price":"much, {or} ]"}' AS value FROM instruments WHERE price > 100000""",
        "profile_open_fields": companies
        + f"SELECT c.symbol, c.name, c.price, listed, grade, score, second_tag, extra_names FROM companies c JOIN ({OPEN}) x ON c.symbol = x.symbol",
        "open_documents_written": companies
        + f"""SELECT c.symbol, c.companyName, date, close, listed, grade, score, second_tag, extra_names
              FROM companies c JOIN ({OPEN}) x ON c.symbol = x.symbol JOIN history h ON h.symbol = c.symbol""",
        "csv_bad_cells": o._with("bars")
        + f"""SELECT symbol, date, close, 'volume' AS "column", {bad_volume} AS text FROM ({sized}) WHERE p_size = 6
              UNION ALL SELECT symbol, date, close, 'high', '12,5' FROM ({sized}) WHERE p_size = 7""",
        "tsv_bad_cells": titles
        + """SELECT vin, 'vehicleCost' AS "column", 'unknown' AS text FROM titles WHERE modelCode = 'P'
             UNION ALL SELECT vin, 'modelYear', '19x0' FROM titles WHERE makeCode = 'LOW'""",
        "csv_spoilt_rows": o._with("bars")
        + f"""SELECT symbol, sector, date, CASE WHEN p_size <> 7 THEN high END AS high, low,
                     CASE WHEN p_size <> 6 THEN volume END AS volume, p_size IN (6, 7) AS spoilt
              FROM ({sized}) WHERE symbol != 'symbol' AND sector != ''""",
        "routed_rows": base["flat_csv_export"],
        "routed_rejects": base["missing_history_rejects"],
        "routed_lines": """
            SELECT CASE WHEN l_linenumber = 7 THEN 'rejected' ELSE 'good' END AS side,
                   CASE WHEN l_linenumber = 7 THEN l_orderkey || ',' || l_returnflag || chr(9)
                        || repeat(l_linenumber || ',', 5) || l_suppkey END AS value,
                   CASE WHEN l_linenumber <> 7 THEN l_returnflag END AS sector,
                   CASE WHEN l_linenumber <> 7 THEN CAST(l_shipdate AS DATE) END AS periodStart,
                   CASE WHEN l_linenumber <> 7 THEN CAST(l_linenumber AS DOUBLE) END AS avgLow,
                   CASE WHEN l_linenumber <> 7 THEN CAST(l_suppkey AS DOUBLE) END AS avgPrice
            FROM lineitem""",
        "merged_inserts": base["sector_week_avg"],
        "merged_symbol_weeks": base["symbol_week_avg"],
        "rerun_month": base["symbol_week_avg"],
        "bucketed_sector_week": base["sector_week_avg"],
        "landing_by_file": o._with("instruments")
        + """SELECT *, CASE WHEN CAST(symbol AS BIGINT) % 5 < 2 THEN 1 ELSE 2 END AS run, 0 AS landed_last FROM instruments""",
        "indexed_lookup": o._with("bars") + f"SELECT sector, periodStart, {rounded} FROM ({keyed}) WHERE symbol = '42'",
        "indexed_files": o._with("bars")
        + f"SELECT count(*) AS lines, min(symbol) AS first, max(symbol) AS last, 0 AS unsorted FROM ({keyed})",
        "stock_renamed_date": base["sector_week_avg"],
        "stock_renamed_date_written": base["sector_week_avg"],
    }

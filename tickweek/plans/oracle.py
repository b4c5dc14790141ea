"""DuckDB SQL for every registered query, written independently of the Spark code.

The adapter views repeat, in SQL, the derivation rules documented in
``tickweek.sources.adapters``. Averages are compared rounded to ``DIGITS``
decimals on both sides. The two engines sum in different orders, so an exact
half may come out a hair below it on one side; both read the average as a
decimal of ``SNAP`` first, which puts such a value back on the half.
"""

from __future__ import annotations

from tickweek.fixed import (
    AVERAGE_COLUMNS,
    BAND_CLASSIC,
    BAND_NEW,
    BAND_OLD,
    BAR_FIELDS,
    COMPANY_COLUMNS,
    COMPANY_FIELDS,
    MIN_MODEL_YEAR,
    OLD_FROM,
    OLD_TO,
)

DIGITS = 4
SNAP = "DECIMAL(28,8)"

BAR_ROWS = """
SELECT
  CASE WHEN l_partkey = 0 THEN 'symbol' ELSE CAST(l_partkey AS VARCHAR) END AS symbol,
  p_name AS name,
  CASE WHEN p_size = 1 THEN ''
       WHEN p_size = 2 THEN NULL
       WHEN p_size = 3 THEN p_type || '  ' || p_brand
       WHEN p_size = 4 THEN p_type || chr(9) || p_brand
       ELSE p_type || ' ' || p_brand END AS sector,
  p_type AS industry,
  p_brand AS exchange,
  CASE WHEN p_size > 25 THEN 'NYSE' ELSE 'NASDAQ' END AS exchangeShortName,
  p_retailprice * 1000 AS volAvg,
  p_retailprice * p_size AS mktCap,
  p_name AS companyName,
  lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS cik,
  'US' || lpad(CAST(l_partkey AS VARCHAR), 10, '0') AS isin,
  lpad(CAST(l_partkey AS VARCHAR), 9, '0') AS cusip,
  'part-' || CAST(l_partkey AS VARCHAR) || '.example' AS website,
  p_name || ', ' || p_brand AS ceo,
  CAST(p_size * 100 AS VARCHAR) AS fullTimeEmployees,
  CAST(l_suppkey AS VARCHAR) || ' Main Street' AS address,
  p_type AS city,
  lpad(CAST(l_suppkey AS VARCHAR), 5, '0') AS zip,
  'img/' || CAST(l_partkey AS VARCHAR) || '.png' AS image,
  CASE WHEN l_discount = 0 AND l_tax = 0 THEN 'not a date'
       ELSE strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') END AS date,
  l_extendedprice * (1 - l_tax) AS open,
  l_extendedprice * (1 + l_tax) AS high,
  l_extendedprice * (1 - l_discount) AS low,
  l_extendedprice AS close,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS adjClose,
  CASE WHEN p_size = 5 THEN NULL ELSE l_quantity END AS volume,
  l_quantity AS unadjustedVolume,
  l_extendedprice * l_tax AS change,
  l_tax * 100 AS changePercent,
  (l_extendedprice * (1 + l_tax) + l_extendedprice * (1 - l_discount) + l_extendedprice) / 3 AS vwap,
  strftime(CAST(l_shipdate AS DATE), '%B %-d, %y') AS label,
  l_tax / 100 AS changeOverTime
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

TITLES = """
SELECT
  CAST(o_orderkey AS VARCHAR) AS vin,
  c_acctbal AS vehicleCost,
  c_nationkey AS odometerTypeCode,
  CAST(o_custkey AS INTEGER) AS odometerReading,
  c_mktsegment AS countyName,
  c_nationkey + 10000 AS ZIP5,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 1900
       ELSE CAST(year(CAST(o_orderdate AS DATE)) + 4 - CAST(floor(o_totalprice / 10000) AS INTEGER) AS INTEGER)
  END AS modelYear,
  substr(o_orderpriority, 3, 100) AS makeCode,
  o_orderstatus AS modelCode,
  o_orderpriority AS vehicleTypeDescription,
  CASE WHEN o_orderstatus = 'O' THEN 'N' ELSE 'U' END AS newUsedCode,
  strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS titleIssueDate,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' AND o_orderpriority = '5-LOW' THEN NULL
       WHEN c_mktsegment = 'MACHINERY' AND o_orderpriority = '5-LOW' THEN 'unknown'
       ELSE strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') END AS purchaseDate
FROM orders JOIN customer ON o_custkey = c_custkey
"""

INSTRUMENTS = """
SELECT CAST(o_orderkey AS VARCHAR) AS symbol, 'Order#' || CAST(o_orderkey AS VARCHAR) AS name,
       o_totalprice AS price, o_orderpriority AS exchange, o_orderstatus AS exchangeShortName, 'stock' AS type
FROM orders
"""

MEMBERS = """
SELECT CAST(o_orderkey AS VARCHAR) AS symbol, 'Order#' || CAST(o_orderkey AS VARCHAR) AS name
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
"""

PROFILE = """
SELECT
  CAST(o_orderkey AS VARCHAR) AS symbol,
  c_acctbal AS price,
  c_name AS companyName,
  CASE WHEN n_regionkey = 0 THEN NULL ELSE n_name || ', ' || c_mktsegment END AS name,
  c_mktsegment || ' ' || n_name AS sector,
  n_name AS industry,
  n_name AS country,
  lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS cik,
  'US' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS isin,
  lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS cusip,
  'c' || CAST(o_custkey AS VARCHAR) || '.example' AS website,
  'Chief, ' || c_name AS ceo,
  CAST(c_nationkey * 1000 AS VARCHAR) AS fullTimeEmployees,
  n_name || ' Road, ' || CAST(c_nationkey AS VARCHAR) AS address,
  n_name AS city,
  lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip,
  'img/c' || CAST(o_custkey AS VARCHAR) || '.png' AS image,
  o_custkey * 100 AS volAvg,
  o_orderkey * 1000000 AS mktCap,
  CASE WHEN n_regionkey = 1 THEN NULL ELSE n_name || ' Exchange' END AS exchange,
  CASE WHEN n_regionkey = 2 THEN NULL ELSE substr(n_name, 1, 4) END AS exchangeShortName,
  CAST(c_nationkey AS DOUBLE) / 10 AS beta,
  o_totalprice / 100 AS lastDiv,
  '1.5-' || CAST(o_custkey AS VARCHAR) AS range,
  c_acctbal / 4 AS changes,
  substr(n_name, 1, 3) AS currency,
  c_mktsegment || ' of "' || c_name || '", ' || n_name AS description,
  'tel ' || CAST(o_custkey AS VARCHAR) AS phone,
  substr(n_name, 1, 2) AS state,
  o_totalprice - c_acctbal AS dcfDiff,
  o_totalprice + c_acctbal AS dcf,
  strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS ipoDate,
  c_nationkey % 2 = 0 AS defaultImage,
  c_nationkey % 3 = 0 AS isEtf,
  c_acctbal > 100 AS isActivelyTrading,
  n_regionkey = 1 AS isAdr,
  c_nationkey % 5 = 0 AS isFund
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE c_acctbal > 0
"""

HISTORY = """
SELECT
  CAST(l_orderkey AS VARCHAR) AS symbol,
  strftime(CAST(l_shipdate AS DATE), '%Y-%m-%d') AS date,
  l_extendedprice * (1 - l_tax) AS open,
  l_extendedprice * (1 + l_tax) AS high,
  l_extendedprice * (1 - l_discount) AS low,
  l_extendedprice AS close,
  l_extendedprice * (1 - l_discount) * (1 + l_tax) AS adjClose,
  l_partkey AS volume,
  l_suppkey AS unadjustedVolume,
  l_extendedprice * l_tax AS change,
  l_tax * 100 AS changePercent,
  (l_extendedprice * (1 + l_tax) + l_extendedprice * (1 - l_discount) + l_extendedprice) / 3 AS vwap,
  strftime(CAST(l_shipdate AS DATE), '%B %-d, %y') AS label,
  l_tax / 100 AS changeOverTime
FROM lineitem
"""

# Constituent instruments merged with their profile; a field that the profile's
# body has wins: even orders spell out null fields, the others leave them out.
_MERGED = ", ".join(
    f"CASE WHEN CAST(p.symbol AS BIGINT) % 2 = 0 THEN p.{c} ELSE COALESCE(p.{c}, i.{c}) END AS {c}"
    for c in ("name", "price", "exchange", "exchangeShortName")
)
_PROFILE_ONLY = ", ".join(
    f"p.{c}" for c, _ in COMPANY_FIELDS if c not in ("symbol", "name", "price", "exchange", "exchangeShortName", "type")
)
COMPANIES = "SELECT i.symbol, i.type, " + _MERGED + ", " + _PROFILE_ONLY + " FROM {source} i LEFT JOIN profile p ON i.symbol = p.symbol"

BAR_COLUMNS = [c for c, _ in BAR_FIELDS]
STRING_COLUMNS = [c for c, kind in COMPANY_FIELDS + BAR_FIELDS if kind == "string"]


def _with(*names: str) -> str:
    views = {
        "bars": BAR_ROWS,
        "titles": TITLES,
        "instruments": INSTRUMENTS,
        "members": MEMBERS,
        "profile": PROFILE,
        "history": HISTORY,
        "listed": "SELECT * FROM instruments WHERE symbol IN (SELECT symbol FROM members)",
        "companies": COMPANIES.format(source="listed"),
        "merged": COMPANIES.format(source="instruments"),
    }
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in names) + "\n"


def r(expr: str, name: str) -> str:
    return f"CAST(round(CAST({expr} AS {SNAP}), {DIGITS}) AS DOUBLE) AS {name}"


def _week(d: str, mode: str) -> str:
    days = f"({d} - DATE '1900-01-01')"
    if mode == "pmod":
        return f"CAST({d} - CAST((({days} % 7) + 7) % 7 AS INTEGER) AS DATE)"
    if mode == "truncated":
        return f"CAST({d} - CAST({days} % 7 AS INTEGER) AS DATE)"
    if mode == "weekday":
        return f"CAST({d} - CAST(isodow({d}) - 1 AS INTEGER) AS DATE)"
    raise ValueError(mode)


def _stock_prepared(sector_expr: str, week_mode: str) -> str:
    d = "TRY_CAST(date AS DATE)"
    return f"""
    SELECT symbol, {sector_expr} AS sector, {_week(d, week_mode)} AS periodStart,
           low, high, close, open, volume, (high + low) / 2 AS mid
    FROM bars WHERE symbol != 'symbol' AND sector != ''
    """


def _symbol_week(prepared: str, default: bool = False) -> str:
    agg = (lambda c: f"coalesce(avg({c}), 0.0)") if default else (lambda c: f"avg({c})")
    return f"""
    SELECT symbol, sector, periodStart,
           {agg('low')} AS avgLow, {agg('high')} AS avgHigh, {agg('close')} AS avgClose,
           {agg('open')} AS avgOpen, {agg('volume')} AS avgVolume, {agg('mid')} AS avgPrice
    FROM ({prepared}) GROUP BY symbol, sector, periodStart
    """


def _sector_week(stage1: str, default: bool = False) -> str:
    agg = (lambda c: f"coalesce(avg({c}), 0.0)") if default else (lambda c: f"avg({c})")
    cols = ", ".join(r(agg(c), c) for c in AVERAGE_COLUMNS)
    return f"SELECT sector, periodStart, {cols} FROM ({stage1}) GROUP BY sector, periodStart"


def _rounded_symbol_week(stage1: str) -> str:
    cols = ", ".join(r(c, c) for c in AVERAGE_COLUMNS)
    return f"SELECT symbol, sector, periodStart, {cols} FROM ({stage1})"


LOWER = "lower(replace(sector, ' ', '_'))"
WHITESPACE = r"regexp_replace(sector, '\s', '_', 'g')"


def _vehicle(week_mode: str, null_band: bool) -> str:
    bought = "TRY_CAST(titles.purchaseDate AS DATE)"
    age = f"CAST(year({bought}) - titles.modelYear AS INTEGER)"
    band = f"CASE WHEN {age} < {OLD_FROM} THEN '{BAND_NEW}' WHEN {age} <= {OLD_TO} THEN '{BAND_OLD}' ELSE '{BAND_CLASSIC}' END"
    if not null_band:
        band = f"CASE WHEN {age} IS NOT NULL THEN {band} END"
    return _with("titles") + (
        f"SELECT {bought} AS purchaseDate, modelYear, {age} AS vehicleAge, {_week(bought, week_mode)} AS periodStart, "
        f"{band} AS WearAndTear FROM titles WHERE vehicleCost > 0 AND modelYear > {MIN_MODEL_YEAR}"
    )


def _flat(source: str, comma_to_dot: bool = False) -> str:
    cols = []
    for c in COMPANY_COLUMNS + BAR_COLUMNS:
        table = "h" if c in BAR_COLUMNS else "c"
        if comma_to_dot and c in STRING_COLUMNS:
            cols.append(f"replace({table}.{c}, ',', '.') AS {c}")
        else:
            cols.append(f"{table}.{c}")
    return f"SELECT {', '.join(cols)} FROM {source} c JOIN history h ON c.symbol = h.symbol"


def oracle_sql() -> dict[str, str]:
    sector_week = _with("bars") + _sector_week(_symbol_week(_stock_prepared(LOWER, "pmod")))
    flat = _with("instruments", "members", "profile", "history", "listed", "companies") + _flat("companies")
    clean = _with("bars") + "SELECT * FROM bars WHERE symbol != 'symbol' AND sector != ''"
    vehicles_filtered = _with("titles") + "SELECT * FROM titles WHERE vehicleCost > 0 AND modelYear > 1900"
    dates = """SELECT DISTINCT CASE WHEN l_discount = 0 AND l_tax = 0 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS trade_date
               FROM lineitem"""
    sectors = """SELECT CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN NULL
                             WHEN p_size = 3 THEN p_type || '  ' || p_brand
                             WHEN p_size = 4 THEN p_type || chr(9) || p_brand
                             ELSE p_type || ' ' || p_brand END AS sector
                 FROM part"""
    return {
        "sector_week_avg": sector_week,
        "symbol_week_avg": _with("bars") + _rounded_symbol_week(_symbol_week(_stock_prepared(LOWER, "pmod"))),
        "clean_bars": clean,
        "sector_normalised": f"SELECT DISTINCT sector AS sector_raw, {LOWER} AS sector FROM ({sectors})",
        "sector_whitespace": f"SELECT DISTINCT sector AS sector_raw, {WHITESPACE} AS sector FROM ({sectors})",
        "week_start_weekday": f"""SELECT trade_date, CAST(isodow(trade_date) AS INTEGER) AS dayOfWeek,
                 {_week('trade_date', 'weekday')} AS periodStart,
                 strftime({_week('trade_date', 'weekday')}, '%Y-%m-%d') AS periodStartText
              FROM ({dates})""",
        "week_start_pmod": f"""SELECT trade_date, CAST(trade_date - DATE '1900-01-01' AS INTEGER) AS daysSinceOrigin,
                 {_week('trade_date', 'pmod')} AS periodStart
              FROM ({dates})""",
        "week_start_trunc_pre1900": f"""SELECT d AS shifted_date, {_week('d', 'pmod')} AS periodStartPmod,
                 {_week('d', 'truncated')} AS periodStartTruncated
              FROM (SELECT CAST(trade_date - 36525 AS DATE) AS d FROM ({dates}))""",
        "week_start_interval": _vehicle("truncated", null_band=False),
        "mid_price": _with("bars")
        + "SELECT symbol, date, CAST(high AS DOUBLE) AS high, CAST(low AS DOUBLE) AS low, "
        "(CAST(high AS DOUBLE) + CAST(low AS DOUBLE)) / 2 AS avg FROM bars",
        "vehicles_filtered": vehicles_filtered,
        "vehicle_age_week_band": _vehicle("truncated", null_band=True),
        "constituents_semi": _with("instruments", "members") + "SELECT * FROM instruments WHERE symbol IN (SELECT symbol FROM members)",
        "profile_left_join": _with("instruments", "profile") + COMPANIES.format(source="instruments"),
        "nest_then_inline": flat,
        "missing_history_rejects": _with("instruments", "members", "profile", "history", "listed", "companies")
        + "SELECT * FROM companies WHERE symbol NOT IN (SELECT symbol FROM history)",
        "history_range": _with("history")
        + "SELECT * FROM history WHERE CAST(date AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'",
        "json_props_field": """
            SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k,
                   CAST(json_object('k', CAST(json_extract(props, '$.k') AS INTEGER)) AS VARCHAR) AS props_out
            FROM events""",
        "json_rejects": """
            SELECT '{"event": ' || event_id || ', "kind": ' || CASE WHEN event_id % 97 = 0 THEN '' ELSE '"word"}' END AS value
            FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0""",
        "json_accepted": "SELECT event_id AS event, user_id AS kind FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0",
        "json_companies_inline": _with("members") + "SELECT symbol, name FROM members",
        "json_member_symbols": _with("members") + "SELECT symbol FROM members",
        "json_instruments": _with("instruments") + "SELECT * FROM instruments WHERE price > 100000",
        "comma_to_dot": _with("instruments", "members", "profile", "history", "listed", "companies")
        + _flat("companies", comma_to_dot=True),
        "split_reparse_stage1": _with("bars")
        + _sector_week(_symbol_week(_stock_prepared(WHITESPACE, "weekday"), default=True), default=True),
        "bag_average": _with("bars") + _sector_week(_symbol_week(_stock_prepared(LOWER, "truncated"))),
        "avg_default_zero": _with("bars")
        + _rounded_symbol_week(_symbol_week(_stock_prepared(LOWER, "pmod"), default=True)),
        "csv_roundtrip": clean,
        "tsv_roundtrip": vehicles_filtered,
        "text_lines": _with("bars")
        + f"SELECT symbol, {WHITESPACE} AS sector, date, (high + low) / 2 AS avg FROM bars "
        f"WHERE symbol != 'symbol' AND {WHITESPACE} != ''",
        "json_roundtrip": flat,
        "table_ctas_insert": sector_week,
        "landing_ignore": _with("instruments") + "SELECT * FROM instruments",
        "stock_stages_written": sector_week,
        "vehicle_stages_written": _vehicle("truncated", null_band=True),
        "vehicle_tables": _vehicle("truncated", null_band=True),
        "flat_csv_export": _with("instruments", "members", "profile", "history", "listed", "companies")
        + _flat("companies", comma_to_dot=True),
    }

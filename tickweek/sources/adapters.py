"""Present the driver's Parquet tables in the input shapes of the two jobs.

Every frame here is a projection of (or a join between) the given tables,
so its size grows with them. The rules are fixed, so the DuckDB oracle can
derive the same rows on its own:

``bar_rows`` (32 columns, ``lineitem`` join ``part``)
    symbol  ``'symbol'`` for part key 0 (a header-like row), else the part key
    sector  ``''`` for size 1, NULL for size 2, type and brand joined by two
            spaces for size 3, by a tab for size 4, else by one space
    date    ship date as ISO text, ``'not a date'`` when discount and tax are 0
    prices  close = extended price, open = close x (1 - tax), high = close x
            (1 + tax), low = close x (1 - discount); volume = quantity, NULL
            (a bad cell) for parts of size 5
    label   ship date as ``'December 30, 22'`` (holds a comma)
``titles`` (13 columns, ``orders`` join ``customer``)
    vehicleCost = account balance (some are <= 0); modelYear = 1900 for urgent
    pending orders, else order year + 4 - price / 10000 (ages -4..45);
    purchaseDate = order date text, NULL for low-priority automobile
    customers, ``'unknown'`` for low-priority machinery customers
``instruments`` / ``members`` / ``profile_bodies`` / ``history``
    orders as instruments; urgent and high-priority orders as the
    constituent list; a one-record JSON array per order of a customer with a
    positive balance (customer and nation joined) as the profile response,
    with every profile field but ``type`` (some NULL: spelled out for even
    orders, left out for the others) and two fields that no schema declares,
    ``rating`` (orders divisible by 3) and ``tags``; line items as each order's bars (orders
    without lines have no history).
``instrument_lines``
    the instruments as JSON lines with the undeclared fields ``listed`` and, for
    orders divisible by 5, ``rating``.
``event_lines``
    the events as one-line JSON documents, some of them cut off, some with a
    word where a number belongs.
``bar_text`` / ``title_text``
    the bars and titles with every cell as text, some numbers spoilt: ``n/a, "x" \\``
    as the volume of parts of size 6, ``12,5`` as the high of parts of size 7;
    ``unknown`` as the cost of titles bought for cash-free status ``P``, ``19x0`` as
    the model year of low-priority titles.
``stage1_lines``
    line items as ``symbol,sector,week<TAB>values`` lines; those of line number 7
    lack the week.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweek.functions.calendar import iso_date_text


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(c: str) -> Column:
    return F.col(c).cast("string")


def _label(ts: str) -> Column:
    return F.date_format(F.col(ts).cast("date"), "MMMM d, yy")


def bar_date() -> Column:
    """The date text of a line item."""
    return F.when((F.col("l_discount") == 0) & (F.col("l_tax") == 0), F.lit("not a date")).otherwise(
        iso_date_text(F.col("l_shipdate").cast("date"))
    )


def part_sector() -> Column:
    """The sector of a part."""
    return (
        F.when(F.col("p_size") == 1, F.lit(""))
        .when(F.col("p_size") == 2, F.lit(None).cast("string"))
        .when(F.col("p_size") == 3, F.concat_ws("  ", "p_type", "p_brand"))
        .when(F.col("p_size") == 4, F.concat_ws("\t", "p_type", "p_brand"))
        .otherwise(F.concat_ws(" ", "p_type", "p_brand"))
    )


def bar_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The date texts of all line items, without the companies."""
    return table(spark, sf_dir, "lineitem").select(bar_date().alias("date"))


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sectors of all parts, without their bars."""
    return table(spark, sf_dir, "part").select(part_sector().alias("sector"))


def bar_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flattened daily bars, the 32 columns of the comma text input.

    Columns that depend on the part alone are derived on the part side, once
    per part, before the join; the line side adds dates and prices."""
    part = table(spark, sf_dir, "part")
    key = _text("p_partkey")
    companies = part.select(
        F.col("p_partkey"),
        F.col("p_size"),
        F.when(F.col("p_partkey") == 0, F.lit("symbol")).otherwise(key).alias("symbol"),
        F.col("p_name").alias("name"),
        part_sector().alias("sector"),
        F.col("p_type").alias("industry"),
        F.col("p_brand").alias("exchange"),
        F.when(F.col("p_size") > 25, F.lit("NYSE")).otherwise(F.lit("NASDAQ")).alias("exchangeShortName"),
        (F.col("p_retailprice") * 1000).alias("volAvg"),
        (F.col("p_retailprice") * F.col("p_size")).alias("mktCap"),
        F.col("p_name").alias("companyName"),
        F.lpad(key, 10, "0").alias("cik"),
        F.concat(F.lit("US"), F.lpad(key, 10, "0")).alias("isin"),
        F.lpad(key, 9, "0").alias("cusip"),
        F.concat(F.lit("part-"), key, F.lit(".example")).alias("website"),
        F.concat_ws(", ", "p_name", "p_brand").alias("ceo"),
        (F.col("p_size") * 100).cast("string").alias("fullTimeEmployees"),
        F.col("p_type").alias("city"),
        F.concat(F.lit("img/"), key, F.lit(".png")).alias("image"),
    )
    li = table(spark, sf_dir, "lineitem")
    j = li.join(companies, li.l_partkey == companies.p_partkey)
    price = F.col("l_extendedprice")
    high = price * (1 + F.col("l_tax"))
    low = price * (1 - F.col("l_discount"))
    return j.select(
        "symbol", "name", "sector", "industry", "exchange", "exchangeShortName", "volAvg", "mktCap",
        "companyName", "cik", "isin", "cusip", "website", "ceo", "fullTimeEmployees",
        F.concat(_text("l_suppkey"), F.lit(" Main Street")).alias("address"),
        "city",
        F.lpad(_text("l_suppkey"), 5, "0").alias("zip"),
        "image",
        bar_date().alias("date"),
        (price * (1 - F.col("l_tax"))).alias("open"),
        high.alias("high"),
        low.alias("low"),
        price.alias("close"),
        (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("adjClose"),
        F.when(F.col("p_size") == 5, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("volume"),
        F.col("l_quantity").alias("unadjustedVolume"),
        (price * F.col("l_tax")).alias("change"),
        (F.col("l_tax") * 100).alias("changePercent"),
        ((high + low + price) / 3).alias("vwap"),
        _label("l_shipdate").alias("label"),
        (F.col("l_tax") / 100).alias("changeOverTime"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle title records, the 13 columns of the tab text input."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    order_date = iso_date_text(F.col("o_orderdate").cast("date"))
    low_priority = F.col("o_orderpriority") == "5-LOW"
    model_year = F.when(
        (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), F.lit(1900)
    ).otherwise(F.year(F.col("o_orderdate").cast("date")) + 4 - F.floor(F.col("o_totalprice") / 10000).cast("int"))
    purchase = (
        F.when((F.col("c_mktsegment") == "AUTOMOBILE") & low_priority, F.lit(None).cast("string"))
        .when((F.col("c_mktsegment") == "MACHINERY") & low_priority, F.lit("unknown"))
        .otherwise(order_date)
    )
    return j.select(
        _text("o_orderkey").alias("vin"),
        F.col("c_acctbal").alias("vehicleCost"),
        F.col("c_nationkey").alias("odometerTypeCode"),
        F.col("o_custkey").cast("int").alias("odometerReading"),
        F.col("c_mktsegment").alias("countyName"),
        (F.col("c_nationkey") + 10000).alias("ZIP5"),
        model_year.alias("modelYear"),
        F.substring("o_orderpriority", 3, 100).alias("makeCode"),
        F.col("o_orderstatus").alias("modelCode"),
        F.col("o_orderpriority").alias("vehicleTypeDescription"),
        F.when(F.col("o_orderstatus") == "O", F.lit("N")).otherwise(F.lit("U")).alias("newUsedCode"),
        order_date.alias("titleIssueDate"),
        purchase.alias("purchaseDate"),
    )


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full instrument list: one record per order."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        _text("o_orderkey").alias("symbol"),
        F.concat(F.lit("Order#"), _text("o_orderkey")).alias("name"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("exchange"),
        F.col("o_orderstatus").alias("exchangeShortName"),
        F.lit("stock").alias("type"),
    )


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constituent list: urgent and high-priority orders."""
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        _text("o_orderkey").alias("symbol"), F.concat(F.lit("Order#"), _text("o_orderkey")).alias("name")
    )


def profile_record() -> Column:
    """The profile record of an order joined to its customer and nation."""
    key = _text("o_orderkey")
    return F.struct(
        key.alias("symbol"),
        F.col("c_acctbal").alias("price"),
        F.col("c_name").alias("companyName"),
        F.when(F.col("n_regionkey") == 0, F.lit(None).cast("string"))
        .otherwise(F.concat_ws(", ", "n_name", "c_mktsegment"))
        .alias("name"),
        F.concat_ws(" ", "c_mktsegment", "n_name").alias("sector"),
        F.col("n_name").alias("industry"),
        F.col("n_name").alias("country"),
        F.lpad(key, 10, "0").alias("cik"),
        F.concat(F.lit("US"), F.lpad(key, 10, "0")).alias("isin"),
        F.lpad(key, 9, "0").alias("cusip"),
        F.concat(F.lit("c"), _text("o_custkey"), F.lit(".example")).alias("website"),
        F.concat(F.lit("Chief, "), F.col("c_name")).alias("ceo"),
        (F.col("c_nationkey") * 1000).cast("string").alias("fullTimeEmployees"),
        F.concat(F.col("n_name"), F.lit(" Road, "), _text("c_nationkey")).alias("address"),
        F.col("n_name").alias("city"),
        F.lpad(_text("c_nationkey"), 5, "0").alias("zip"),
        F.concat(F.lit("img/c"), _text("o_custkey"), F.lit(".png")).alias("image"),
        (F.col("o_custkey") * 100).alias("volAvg"),
        (F.col("o_orderkey") * 1000000).alias("mktCap"),
        F.when(F.col("n_regionkey") == 1, F.lit(None).cast("string")).otherwise(F.concat(F.col("n_name"), F.lit(" Exchange"))).alias("exchange"),
        F.when(F.col("n_regionkey") == 2, F.lit(None).cast("string")).otherwise(F.substring("n_name", 1, 4)).alias("exchangeShortName"),
        (F.col("c_nationkey") / 10).alias("beta"),
        (F.col("o_totalprice") / 100).alias("lastDiv"),
        F.concat(F.lit("1.5-"), _text("o_custkey")).alias("range"),
        (F.col("c_acctbal") / 4).alias("changes"),
        F.substring("n_name", 1, 3).alias("currency"),
        F.concat(F.col("c_mktsegment"), F.lit(' of "'), F.col("c_name"), F.lit('", '), F.col("n_name")).alias("description"),
        F.concat(F.lit("tel "), _text("o_custkey")).alias("phone"),
        F.substring("n_name", 1, 2).alias("state"),
        (F.col("o_totalprice") - F.col("c_acctbal")).alias("dcfDiff"),
        (F.col("o_totalprice") + F.col("c_acctbal")).alias("dcf"),
        iso_date_text("o_orderdate").alias("ipoDate"),
        (F.col("c_nationkey") % 2 == 0).alias("defaultImage"),
        (F.col("c_nationkey") % 3 == 0).alias("isEtf"),
        (F.col("c_acctbal") > 100).alias("isActivelyTrading"),
        (F.col("n_regionkey") == 1).alias("isAdr"),
        (F.col("c_nationkey") % 5 == 0).alias("isFund"),
        F.when(
            F.col("o_orderkey") % 3 == 0,
            F.struct(F.concat(F.lit("G"), _text("n_regionkey")).alias("grade"), (F.col("o_orderkey") % 7).alias("score")),
        ).alias("rating"),
        F.array("c_mktsegment", "n_name").alias("tags"),
    )


def profile_bodies(spark: SparkSession, sf_dir: str, by_symbol: bool = False) -> DataFrame:
    """Profile responses ``(symbol, body)``: a JSON array holding one record,
    for orders of customers with a positive balance.

    With ``by_symbol`` the rows are dealt by symbol before the bodies are made, so
    a join or a grouping on the symbol moves the few columns, not the long text."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    n = table(spark, sf_dir, "nation")
    j = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey)
    # Bodies of even orders spell out their null fields, the others leave them out.
    record = F.array(profile_record())
    body = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(record, {"ignoreNullFields": "false"})).otherwise(F.to_json(record))
    j = j.withColumn("symbol", _text("o_orderkey"))
    return (j.repartition("symbol") if by_symbol else j).select("symbol", body.alias("body"))


def history(spark: SparkSession, sf_dir: str, start: str | None = None, end: str | None = None, by_symbol: bool = False) -> DataFrame:
    """Daily bars per symbol: one per line item of the order.

    A range of dates is asked of the table's own column, so it reaches the scan.
    With ``by_symbol`` the line items are dealt by symbol before the bars are made,
    so joins and groupings on the symbol move seven columns once, not thirteen each."""
    li = table(spark, sf_dir, "lineitem")
    if start is not None:
        li = li.where(F.col("l_shipdate") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        li = li.where(F.col("l_shipdate") < F.date_add(F.lit(end).cast("date"), 1).cast("timestamp_ntz"))
    li = li.withColumn("symbol", _text("l_orderkey"))
    if by_symbol:
        li = li.repartition("symbol")
    price = F.col("l_extendedprice")
    high = price * (1 + F.col("l_tax"))
    low = price * (1 - F.col("l_discount"))
    return li.select(
        "symbol",
        iso_date_text(F.col("l_shipdate").cast("date")).alias("date"),
        (price * (1 - F.col("l_tax"))).alias("open"),
        high.alias("high"),
        low.alias("low"),
        price.alias("close"),
        (price * (1 - F.col("l_discount")) * (1 + F.col("l_tax"))).alias("adjClose"),
        F.col("l_partkey").alias("volume"),
        F.col("l_suppkey").alias("unadjustedVolume"),
        (price * F.col("l_tax")).alias("change"),
        (F.col("l_tax") * 100).alias("changePercent"),
        ((high + low + price) / 3).alias("vwap"),
        _label("l_shipdate").alias("label"),
        (F.col("l_tax") / 100).alias("changeOverTime"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def instrument_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instruments as JSON lines with fields that no schema declares."""
    o = table(spark, sf_dir, "orders").withColumn("symbol", _text("o_orderkey"))
    rating = F.when(F.col("o_orderkey") % 5 == 0, F.struct(F.lit("none").alias("grade")))
    record = F.struct(
        "symbol",
        F.concat(F.lit("Order#"), "symbol").alias("name"),
        F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("exchange"),
        F.col("o_orderstatus").alias("exchangeShortName"),
        F.lit("stock").alias("type"),
        iso_date_text(F.col("o_orderdate").cast("date")).alias("listed"),
        rating.alias("rating"),
    )
    return o.select(F.to_json(record).alias("value"))


def _as_text(df: DataFrame, spoilt: dict[str, Column]) -> DataFrame:
    return df.select(*[spoilt.get(c, F.col(c).cast("string")).alias(c) for c in df.columns])


def bar_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bars, every cell as text, some numbers spoilt."""
    size = (F.col("fullTimeEmployees") / 100).cast("int")
    return _as_text(
        bar_rows(spark, sf_dir),
        {
            "volume": F.when(size == 6, F.lit('n/a, "x" \\')).otherwise(F.col("volume").cast("string")),
            "high": F.when(size == 7, F.lit("12,5")).otherwise(F.col("high").cast("string")),
        },
    )


def title_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The titles, every cell as text, some numbers spoilt."""
    return _as_text(
        titles(spark, sf_dir),
        {
            "vehicleCost": F.when(F.col("modelCode") == "P", F.lit("unknown")).otherwise(F.col("vehicleCost").cast("string")),
            "modelYear": F.when(F.col("makeCode") == "LOW", F.lit("19x0")).otherwise(F.col("modelYear").cast("string")),
        },
    )


def stage1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as stage-1 text lines, some of them malformed."""
    li = table(spark, sf_dir, "lineitem")
    week = F.when(F.col("l_linenumber") != 7, F.concat(F.lit(","), iso_date_text(F.col("l_shipdate").cast("date")))).otherwise("")
    key = F.concat(_text("l_orderkey"), F.lit(","), F.col("l_returnflag"), week)
    values = F.concat_ws(",", *[_text("l_linenumber")] * 5, _text("l_suppkey"))
    return li.select(F.concat(key, F.lit("\t"), values).alias("value"))


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as JSON lines: every 97th is cut off, every other 89th has a word as its ``kind``."""
    e = table(spark, sf_dir, "events")
    head = F.concat(F.lit('{"event": '), _text("event_id"), F.lit(', "kind": '))
    tail = F.when(F.col("event_id") % 97 == 0, "").when(F.col("event_id") % 89 == 0, '"word"}').otherwise(F.concat(_text("user_id"), F.lit("}")))
    return e.select(F.concat(head, tail).alias("value"))

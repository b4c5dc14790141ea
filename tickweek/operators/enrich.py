"""Joins and nesting: constituent filter, profile merge, history documents.

* ``keep_members``: left semi join on the symbol (a filter, never a
  duplication); Spark picks the join from measured sizes.
* ``merge_right_wins``: left outer join where the right record's fields
  replace equal names, field by field as the record has them.
* ``nest_history`` / ``attach_history`` / ``flatten_documents``: company
  documents with a nested array of bars, and back to one row per bar.

Nesting never gathers a whole key: a company's history is cut into pages
(calendar month, split further by a hash when the month holds more than
``page_rows`` bars), and exact copies of one bar are first counted, then
re-expanded in chunks (blocks of chunks are spread over tasks); the distinct
bars of a hot month are dealt to several parts of the page join. So no page, task
or group grows with the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

PAGE_ROWS = 4096
# Chunks one task may expand from a single counted row.
CHUNK_BLOCK = 4096
# Pages of a group whose distinct items may meet in one part of the page join.
SPREAD_PAGES = 1024


def keep_members(items: DataFrame, members: DataFrame, key: str = "symbol") -> DataFrame:
    """Rows of ``items`` whose ``key`` occurs in ``members`` (exact match, no normalising)."""
    return items.join(members.select(key), key, "left_semi")


# Names of the fields that a record's text really has (see ``merge_right_wins``).
PRESENT = "__present"


def first_record(
    bodies: DataFrame, body: str, element: StructType, key: str = "symbol", present: bool = False, text: str | None = None
) -> DataFrame:
    """Parse a JSON array text per key and keep its first record as columns.

    A body that is not JSON, an empty array, or a NULL body gives no row; a
    key with several bodies is an error. With ``present`` the column ``PRESENT``
    lists the fields the record's text has, be they null or not; ``text`` names
    a column that keeps the body itself.
    The first element is taken by exploding a one-element slice, so the
    parse runs once per row (a filter on a parsed alias would be inlined
    into the join below it and parse the text twice)."""
    repeated = F.raise_error(F.concat(F.lit("several bodies for key "), F.col(key).cast("string"))).cast("string")
    one = bodies.groupBy(key).agg(F.count("*").alias("_n"), F.first(body).alias("_body"))
    one = one.select(key, F.when(F.col("_n") == 1, F.col("_body")).otherwise(repeated).alias("_body"))
    first = F.explode(F.slice(F.from_json("_body", ArrayType(element)), 1, 1))
    fields = [f.name for f in element.fields if f.name != key]
    # The keys of the first element are read up to its end, so the rest of the array may follow it.
    array = F.ltrim("_body", F.lit(" \t\n\r"))
    names = [F.when(array.startswith("["), F.json_object_keys(F.substring(array, F.lit(2), F.length(array)))).alias(PRESENT)] if present else []
    bodies_kept = [F.col("_body").alias(text)] if text else []
    return (
        one.select(key, first.alias("_first"), *names, *bodies_kept)
        .where(F.col("_first").isNotNull())
        .select(key, *[F.col("_first").getField(f).alias(f) for f in fields], *([PRESENT] if present else []), *([text] if text else []))
    )


def one_per_key(df: DataFrame, key: str = "symbol") -> DataFrame:
    """One record per ``key``: the smallest record by its field order.

    Deterministic on every run and a map-side combined aggregate, so a key
    with very many records costs one buffer per task."""
    others = [c for c in df.columns if c != key]
    if not others:
        return df.select(key).distinct()
    smallest = F.min(F.struct(*[F.col(f"`{c}`") for c in others])).alias("_r")
    return df.groupBy(key).agg(smallest).select(key, *[F.col("_r").getField(c).alias(c) for c in others])


def merge_right_wins(left: DataFrame, right: DataFrame, key: str = "symbol") -> DataFrame:
    """Left outer join on ``key``; on equal names a field the right record has wins.

    A field that the record lacks keeps the left value. Which fields it has is
    listed in ``PRESENT`` where ``right`` has that column (then a null that is
    spelled out wins too); else its non-NULL fields count. ``right`` must be
    unique on ``key``."""
    joined = left.alias("l").join(right.alias("r"), key, "left")
    cols: list[Column] = [F.col(key)]
    for name in left.columns:
        if name == key:
            continue
        own, other = F.col(f"l.`{name}`"), F.col(f"r.`{name}`")
        if name not in right.columns:
            cols.append(own)
        elif PRESENT in right.columns:
            cols.append(F.when(F.array_contains(f"r.{PRESENT}", name), other).otherwise(own).alias(name))
        else:
            cols.append(F.coalesce(other, own).alias(name))
    cols += [F.col(f"r.`{name}`") for name in right.columns if name not in (key, PRESENT) and name not in left.columns]
    return joined.select(*cols)


def paged_lists(
    df: DataFrame, keys: list[str], items: list[str], name: str, page_rows: int = PAGE_ROWS, assume_unique: bool = False,
    spread_pages: int = SPREAD_PAGES,
) -> DataFrame:
    """Collect ``items`` per ``keys`` into arrays of about ``page_rows`` elements.

    Returns ``(*keys, page, name)``. Each input row lands in exactly one page;
    NULL keys form their own group.

    * Rows whose first key (the symbol of a history) has at most
      ``spread_pages`` pages in all are paged where a grouping by the keys, or an
      earlier one by some of them, put them: one exchange at most
      (``_paged_in_place``). The others are spread:
    * Exact copies are first counted (a map-side combined aggregate), so a
      run of identical rows travels as one row with a count.
    * A group gets ``ceil(rows / page_rows)`` pages; its row count comes from
      a separate partial aggregate of the input.
    * Copies come back in chunks of at most ``page_rows``, and the chunks of
      one item are cut into blocks of ``CHUNK_BLOCK``. The group totals are
      joined on (keys, block), replicated once per block a group can need,
      so the blocks of a huge run are spread over tasks by that join's
      shuffle and no task expands more than one block per counted row.
    * The distinct items of a group of more than ``spread_pages`` pages are dealt
      to several parts of that join by their hash (``_with_pages``).
    * The chunks of one item take consecutive pages from the item's hash;
      distinct items spread by hash.

    ``assume_unique=True`` skips the copy count (one shuffle less) for data
    whose rows are known to be distinct, such as bars keyed by (symbol,
    date). Every row still lands in exactly one page; only the page bound
    then relies on that promise.
    """
    keyed = df.select(*keys, *items)
    if not keys:  # all rows are one group, under a key that the planner cannot fold away
        keys, keyed = ["_all"], keyed.withColumn("_all", F.pmod(F.xxhash64(*items), F.lit(1)))
    # Few first keys have that many rows (4 million), so their list can be broadcast.
    sizes = keyed.groupBy(keys[0]).agg(F.count(F.lit(1)).alias("_rows"))
    large = F.broadcast(sizes.where(F.col("_rows") > spread_pages * page_rows).select(F.col(keys[0]).alias("_large")))
    in_large = keyed[keys[0]].eqNullSafe(F.col("_large"))
    item = F.struct(*[F.col(f"`{c}`") for c in items])
    few = _paged_in_place(keyed.join(large, in_large, "left_anti"), keys, items, page_rows, assume_unique)
    lists = few.groupBy(*keys, "page").agg(_items_of_page(item).alias(name))
    spread = _with_pages(keyed.join(large, in_large, "left_semi"), keys, items, page_rows, assume_unique, spread_pages)
    chunks = spread.withColumn(
        "_chunk", _ids(F.col("_block") * CHUNK_BLOCK, F.least(F.col("_chunks"), (F.col("_block") + 1) * CHUNK_BLOCK))
    ).withColumn("_n", F.least(F.lit(page_rows).cast("long"), F.col("_copies") - F.col("_chunk") * page_rows))
    start = F.pmod(F.col("_hash"), F.col("_pages"))
    pages = chunks.withColumn("page", F.pmod(start + F.col("_chunk"), F.col("_pages")).cast("int"))
    # Shuffle on the page itself, so the pages of one hot group spread over tasks.
    spread_lists = pages.repartition(*keys, "page").groupBy(*keys, "page").agg(_items_of_page(item).alias(name))
    return lists.unionByName(spread_lists).drop("_all")


def _items_of_page(item: Column) -> Column:
    return F.flatten(F.collect_list(F.array_repeat(item, F.col("_n").cast("int"))))


def _paged_in_place(df: DataFrame, keys: list[str], items: list[str], page_rows: int, assume_unique: bool) -> DataFrame:
    """Each distinct item's chunks with their ``page`` and size ``_n``, the groups counted by a window over the keys."""
    counted = df.withColumn("_pages", F.ceil(F.count(F.lit(1)).over(Window.partitionBy(*keys)) / page_rows))
    if assume_unique:
        counted = counted.withColumn("_copies", F.lit(1).cast("long"))
    else:
        counted = counted.groupBy(*keys, "_pages", *items).agg(F.count(F.lit(1)).alias("_copies"))
    chunks = counted.withColumn("_chunk", _ids(F.lit(0), F.ceil(F.col("_copies") / page_rows)))
    start = F.pmod(F.xxhash64(F.struct(*[F.col(f"`{c}`") for c in items])), F.col("_pages"))
    return chunks.withColumns(
        {
            "page": F.pmod(start + F.col("_chunk"), F.col("_pages")).cast("int"),
            "_n": F.least(F.lit(page_rows).cast("long"), F.col("_copies") - F.col("_chunk") * page_rows),
        }
    )


def _ids(lo: Column, hi: Column) -> Column:  # lo .. hi - 1
    return F.explode(F.sequence(lo.cast("long"), (hi - 1).cast("long")))


def _with_pages(df: DataFrame, keys: list[str], items: list[str], page_rows: int, assume_unique: bool, spread_pages: int) -> DataFrame:
    """Each distinct item with its copies, its blocks of chunks and the number of pages of its group.

    A group of more than ``spread_pages`` pages is joined in as many parts as
    that makes: its items are dealt to the parts by their hash, its total is
    repeated for each. Such groups are found first. They are few: each has over
    ``spread_pages * page_rows`` rows (4 million), so even a million million rows
    have fewer than 250,000 of them, and the list can be broadcast."""
    size = F.ceil(F.col("_rows") / page_rows)
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_pages", size)
    groups = groups.withColumn("_parts", F.ceil(F.col("_pages") / spread_pages))
    named = [F.col(k).alias(f"_g_{k}") for k in keys]
    hot = groups.where(F.col("_parts") > 1).select(*named, F.col("_parts").alias("_hot_parts"))
    totals = (
        groups.withColumn("_g_block", _ids(F.lit(0), F.ceil(F.col("_pages") / CHUNK_BLOCK)))
        .withColumn("_g_part", _ids(F.lit(0), F.col("_parts")))
        .select(*named, "_g_block", "_g_part", "_pages")
    )
    if assume_unique:
        counted = df.withColumn("_copies", F.lit(1).cast("long"))
    else:
        counted = df.groupBy(*keys, *items).agg(F.count(F.lit(1)).alias("_copies"))
    counted = (
        counted.withColumn("_hash", F.xxhash64(F.struct(*[F.col(f"`{c}`") for c in items])))
        .withColumn("_chunks", F.ceil(F.col("_copies") / page_rows))
        .withColumn("_block", _ids(F.lit(0), F.ceil(F.col("_chunks") / CHUNK_BLOCK)))
    )
    same = [counted[k].eqNullSafe(F.col(f"_g_{k}")) for k in keys]
    counted = counted.join(F.broadcast(hot), same, "left").drop(*[f"_g_{k}" for k in keys])
    # another hash than the one that picks the page, so parts and pages are dealt apart
    counted = counted.withColumn("_part", F.pmod(F.xxhash64("_hash"), F.coalesce("_hot_parts", F.lit(1)))).drop("_hot_parts")
    on = [counted[k].eqNullSafe(totals[f"_g_{k}"]) for k in keys] + [counted["_block"] == totals["_g_block"], counted["_part"] == totals["_g_part"]]
    return counted.join(totals, on).drop(*[f"_g_{k}" for k in keys], "_g_block", "_g_part")


def nest_history(
    history: DataFrame, key: str = "symbol", date: str = "date", page_rows: int = PAGE_ROWS, assume_unique: bool = False, by_month: bool = True
) -> DataFrame:
    """Nest bars into pages ``(key, page_month, page, stockData)``.

    ``stockData`` holds the bar structs (all columns but ``key``) of one
    calendar month of one key, newest first; a month with more than
    ``page_rows`` bars is split over several pages. Without ``by_month`` a page
    holds bars of all months of its key (and its ``page_month`` is NULL), so a key of
    up to ``page_rows`` bars is one page.
    """
    bar_cols = [c for c in history.columns if c != key]
    month = F.substring(F.col(date).cast("string"), 1, 7)
    keys = [key, "page_month"] if by_month else [key]
    pages = paged_lists(history.withColumn("page_month", month), keys, bar_cols, "stockData", page_rows, assume_unique)
    if not by_month:
        pages = pages.select(key, F.lit(None).cast("string").alias("page_month"), "page", "stockData")
    return pages.withColumn("stockData", F.sort_array("stockData", asc=False))


def attach_history(
    companies: DataFrame, pages: DataFrame, key: str = "symbol", history: DataFrame | None = None, keys: DataFrame | None = None
) -> DataFrame:
    """Company documents: one per (company, page), and one with a NULL
    ``stockData`` for each company without history.

    The inner join lets AQE split a company with very many pages; the
    companies without history come from an anti join against the distinct
    keys (of ``history`` when given, which spares the nesting work), so a
    hot key never buffers its rows there. ``stockData`` of a page is never
    NULL, so a filter for documents without bars prunes the inner join.

    ``keys`` may name rows that hold the key of every company, none of them NULL (the
    list they were chosen by): then those without history join as an empty page, and
    the companies, however much work they are, are made once.
    """
    pages = pages.select(key, "page_month", "page", "stockData")
    present = (history if history is not None else pages).select(key).distinct()
    listed = companies if keys is None else keys.select(key).distinct()
    without = (
        listed.join(present, key, "left_anti")
        .withColumn("page_month", F.lit(None).cast("string"))
        .withColumn("page", F.lit(None).cast("int"))
        .withColumn("stockData", F.lit(None).cast(pages.schema["stockData"].dataType))
    )
    if keys is not None:
        return companies.join(pages.unionByName(without), key, "inner")
    return companies.join(pages, key, "inner").unionByName(without)


def documents_with_bars(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("stockData").isNotNull())


def documents_without_bars(docs: DataFrame) -> DataFrame:
    """The rejects of flattening: documents that carry no ``stockData``."""
    return docs.where(F.col("stockData").isNull())


def flatten_documents(docs: DataFrame, company_columns: list[str], bar_columns: list[str] | None = None) -> DataFrame:
    """One row per (document, bar): company columns repeated, then the bar
    fields by name. Documents without bars produce no row."""
    exploded = docs.select(*[F.col(f"`{c}`") for c in company_columns], F.explode("stockData").alias("_bar"))
    if bar_columns is None:
        return exploded.select(*company_columns, "_bar.*")
    return exploded.select(*company_columns, *[F.col("_bar").getField(c).alias(c) for c in bar_columns])

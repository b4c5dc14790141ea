"""Order MinHash fingerprints of whole texts, in built-in functions only (native).

A text's tokens are its runs without white space; a run of more than
``WHOLE_RUN`` characters (unspaced scripts, encoded data) gives its overlapping
``GRAM`` characters instead, so that an inserted character changes the tokens
around it and no others. A k-mer is a token with its successor; the n-th occurrence
of a k-mer in a text counts as an item of its own. One hash deals the items into
``BINS`` bins and orders them there; the ``PER_BIN`` smallest of a bin, put back
into text order, are hashed as one tuple. Two texts agree in a bin when they
share those items and their order, which edits and moves both destroy.

Items live as sorted arrays of 64-bit numbers: hash above, place in the text
below, so sorting them is a sort of plain numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweek.llm.common import documents
from tickweek.session import stored

WHOLE_RUN = 24
GRAM = 4
BINS = 64
PER_BIN = 2
_PLACE = 30  # bits of a place
_HIGH = -(1 << _PLACE)  # mask of the bits above it


def tokens(text: Column) -> Column:
    """The tokens of ``text`` in order; both patterns pass over it once."""
    runs = F.regexp_extract_all(text, F.lit(r"\S+"), F.lit(0))
    grams = F.lit(r"(?s)(?=(.{%d}))." % GRAM)
    cut = F.flatten(
        F.transform(
            runs, lambda x: F.when(F.char_length(x) > WHOLE_RUN, F.regexp_extract_all(x, grams, F.lit(1))).otherwise(F.array(x))
        )
    )
    return F.when(text.rlike(r"\S{%d}" % (WHOLE_RUN + 1)), cut).otherwise(runs)


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the array column ``name``: per filled bin its number (above 32 bits) and tuple hash.

    An empty text has an empty array. Each step is a column of its own that the
    next one uses more than once, so that no step is worked out again inside
    another's lambda.
    """
    kept = df.columns

    def same(a: Column, b: Column) -> Column:
        return a.bitwiseAND(F.lit(_HIGH)) == b.bitwiseAND(F.lit(_HIGH))

    def occurrence(value: Column, i: Column) -> Column:
        """Equal k-mers before place ``i`` of the sorted array: a binary search, only where there are any."""
        count = F.aggregate(
            F.array(*[F.lit(1 << b) for b in range(_PLACE - 1, -1, -1)]),
            F.lit(0),
            lambda n, step: F.when((i - n - step >= 0) & same(F.get(F.col("_s"), i - n - step), value), n + step).otherwise(n),
        )
        return F.when((i > 0) & same(F.get(F.col("_s"), i - 1), value), count).otherwise(F.lit(0))

    def item(value: Column, i: Column) -> Column:
        """bin (6 bits), hash (27 bits), place (30 bits)"""
        h = F.xxhash64(value.bitwiseAND(F.lit(_HIGH)), F.coalesce(occurrence(value, i), F.lit(0)))
        place = value.bitwiseAND(F.lit((1 << _PLACE) - 1))
        return (
            F.shiftleft(h.bitwiseAND(F.lit(BINS - 1).cast("long")), 57)
            .bitwiseOR(F.shiftleft(F.shiftrightunsigned(h, 37), _PLACE))
            .bitwiseOR(place)
        )

    def bin_of(value: Column) -> Column:
        return F.shiftright(value, 57)

    def component(value: Column, i: Column) -> Column:
        """Of a bin's first item: the hash of the bin's items in text order."""
        other = F.get(F.col("_v"), i + 1)
        low = F.lit((1 << _PLACE) - 1)
        a, b = F.shiftright(value, _PLACE), F.shiftright(other, _PLACE)
        pair = F.when(value.bitwiseAND(low) < other.bitwiseAND(low), F.xxhash64(a, b)).otherwise(F.xxhash64(b, a))
        found = F.when(bin_of(value) == bin_of(other), pair).otherwise(F.xxhash64(a))
        packed = F.shiftleft(bin_of(value), 32).bitwiseOR(found.bitwiseAND(F.lit(0xFFFFFFFF)))
        starts = (i == 0) | (bin_of(F.get(F.col("_v"), i - 1)) != bin_of(value))
        return F.when(starts, packed)

    out = df.withColumn("_t", tokens(F.col(text)))
    out = out.withColumn(
        "_s",
        F.sort_array(
            F.transform("_t", lambda x, i: F.xxhash64(x, F.get(F.col("_t"), i + 1)).bitwiseAND(F.lit(_HIGH)).bitwiseOR(i.cast("long")))
        ),
    )
    out = out.withColumn("_u", F.sort_array(F.transform("_s", item)))
    out = out.withColumn("_v", F.filter("_u", lambda x, i: (i < PER_BIN) | (bin_of(F.get(F.col("_u"), i - PER_BIN)) != bin_of(x))))
    return out.withColumn(name, F.filter(F.transform("_v", component), lambda x: x.isNotNull())).select(*kept, name)


def likeness(a: str, b: str) -> Column:
    """Share of the bins filled in either text in which both agree; 1 for two empty texts."""
    bins = F.size(F.array_distinct(F.transform(F.concat(a, b), lambda x: F.shiftright(x, 32))))
    return F.when(bins == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / bins)


def as_text(a: str) -> Column:
    """Ten hexadecimal digits a bin: two for its number, eight for its hash."""
    return F.array_join(F.transform(a, lambda x: F.lower(F.lpad(F.hex(x), 10, "0"))), "")


def successors(keys: DataFrame) -> DataFrame:
    """``id0, h`` of each distinct key, ``id1, h1`` of the next one in order (after the last: the first), ``n_chars``.

    The order is that of (NULL ids first, id, hash). Range partitioning makes
    stretches of it; within one the next row is a window's lead, between them it
    is the next stretch's first row, of which there is one per partition.
    """
    parts = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("no_id").desc(), F.col("id0"), F.col("h")]
    placed = stored(keys.distinct().repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()), "fingerprint-order")
    firsts = placed.groupBy("part").agg(F.min(F.struct((~F.col("no_id")).alias("o"), "id0", "h")).alias("first"))
    whole = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nexts = firsts.select("part", F.coalesce(F.lead("first").over(Window.orderBy("part")), F.first("first").over(whole)).alias("after"))
    own = Window.partitionBy("part").orderBy(*order)
    led = placed.select("*", F.lead("id0").over(own).alias("id_next"), F.lead("h").over(own).alias("h_next"))
    joined = led.join(F.broadcast(nexts), "part")  # one row per partition
    return joined.select(
        "id0", "h", "n_chars", F.coalesce("id_next", "after.id0").alias("id1"), F.coalesce("h_next", "after.h").alias("h1")
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text of ``docs`` and of its edited text, and how alike they are.

    The edited text is the text with its last floor(n / 2) characters replaced
    by the first as many (or all there are) of the next document's. NULL texts
    count as empty. Documents are ordered by id, NULL ids first, those of one id
    by a hash of the text; wholly equal rows are one document in that order and
    get the same result each. An empty table gives no rows; only ``doc_id`` and
    ``text`` are read.
    """
    no_id = F.col("doc_id").isNull()
    text = F.coalesce("text", F.lit(""))
    # A NULL id is part of the hash, so that joins need no null-safe keys.
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id0"),
        F.concat(F.md5(text.cast("binary")), F.when(no_id, "-").otherwise("")).alias("h"),
        text.alias("text"),
    )
    order = successors(
        keyed.select(F.col("h").endswith("-").alias("no_id"), "id0", "h", F.char_length("text").cast("long").alias("n_chars"))
    )
    half = F.floor(F.col("n_chars") / 2).cast("int")
    # Beside its successor relation a text is fingerprinted once. Its start and
    # fingerprint go to the document before it, its fingerprint also to itself;
    # both joins read one shuffle of the plain texts.
    named = keyed.withColumnsRenamed({"id0": "id1", "h": "h1"}).join(order, ["id1", "h1"])
    start = F.substring(F.col("text"), F.lit(1), half)
    to_before = F.struct("id0", "h", "n_chars", start.alias("start"), F.col("fp").alias("fp_next"), F.lit(None).cast("array<bigint>").alias("fp"))
    to_self = F.struct(
        F.col("id1").alias("id0"), F.col("h1").alias("h"), F.lit(None).cast("long").alias("n_chars"),
        F.lit(None).cast("string").alias("start"), F.lit(None).cast("array<bigint>").alias("fp_next"), F.col("fp").alias("fp"),
    )
    handed = with_fingerprint(named, "text", "fp").select(F.inline(F.array(to_before, to_self)))
    handed = handed.groupBy("id0", "h").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n_chars", "start", "fp_next", "fp")])
    met = keyed.join(handed, ["id0", "h"]).withColumn(
        "edited", F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")), "start")
    )
    both = met.select("id0", "h", "n_chars", "fp", "fp_next", "edited")
    return with_fingerprint(both, "edited", "fp_edited").select(
        F.when(F.col("h").endswith("-"), F.lit(None)).otherwise(F.col("id0")).cast("long").alias("doc_id"),
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("fp").alias("fingerprint"),
        as_text("fp_edited").alias("edited_fingerprint"),
        likeness("fp", "fp_edited").alias("near_edited"),
        likeness("fp", "fp_next").alias("near_next"),
    )


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))

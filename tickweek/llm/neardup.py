"""MinHash near-duplicates with sequential Bayesian verification.

Texts of equal shingle sets are one class from the start, so copies cost
nothing later. Bands of the classes' MinHash signatures give buckets; pairs
within a bucket are compared signature batch by batch and dropped as soon as
the posterior chance that they reach the threshold is below ``MISS``; survivors
are verified on their full shingle sets. Verified links join components.

A bucket's members are compared with one of them, its centre, so a bucket of n
members makes n - 1 pairs. The centre is the member with most company over all
its buckets: of a group of near copies the one most like the rest, so that few
of them stay apart. Further rounds take other centres. Buckets that then
still hold several components may hide a link between two members that no
centre shares. Their classes go through an exact search that forms no pairs by
bucket: shingles are put in one order, rare ones first, and two sets that are
similar enough must share a shingle among the first few of both (prefix filter),
so texts that only have a common passage in common never meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweek.llm.common import SLICE_BYTES, documents, lean, no_nulls, slices, spread, without_empty
from tickweek.session import drop_stored, stored

SHINGLE = 5
NUMERATOR, DENOMINATOR = 75, 100  # a link: DENOMINATOR * shared >= NUMERATOR * all
BANDS, ROWS = 32, 4  # at 0.75 a pair meets in some band with probability 1 - 5e-6
HASHES = BANDS * ROWS
BATCH = 16  # signature values compared before each look at the posterior
MISS = 1e-4  # chance of a true pair below which comparing stops
CENTRES = 1  # rounds with one centre per bucket before the exact search; any number gives the same links
COUNTERS = 1 << 20  # hashed counters of how common shingles are; any values keep the search exact
BLOCKS = 16  # the counters travel in so many blocks

_P = np.uint64(0x9E3779B97F4A7C15)


def _mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    out = h >> np.uint64(30)
    out ^= h
    out *= np.uint64(0xBF58476D1CE4E5B9)
    out ^= out >> np.uint64(27)
    out *= np.uint64(0x94D049BB133111EB)
    out ^= out >> np.uint64(31)
    return out


_random = np.random.default_rng(17)
HASH_A = _random.integers(1, 1 << 63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
HASH_B = _random.integers(0, 1 << 63, HASHES, dtype=np.uint64)


def runs(w: np.ndarray, k: int) -> np.ndarray:
    """A hash of every ``k`` values in a row."""
    out = np.zeros(max(len(w) - k + 1, 0) if k else 0, np.uint64)
    first = np.uint64(k * int(_P) & 0xFFFFFFFFFFFFFFFF)
    for at in range(0, len(out), 1 << 14):  # a block stays in the cache
        n = min(1 << 14, len(out) - at)
        h = _mix(w[at : at + n] + first)
        for j in range(1, k):
            h *= _P
            h += w[at + j : at + j + n]
            h = _mix(h)
        out[at : at + n] = h
    return out


def shingle_rows(texts: list[str | None] | pa.Array, size: int = SHINGLE, exact: bool = False) -> tuple[list[np.ndarray], list[int]]:
    """Each text's word shingles as 64-bit hashes in text order, and its number of words if that is below ``size``, else 0.

    Words are runs of characters other than ASCII white space, A-Z in lower
    case. A text of fewer than ``size`` words is one shingle, or none if
    ``exact``; a text without words has none.
    """
    split = pc.ascii_split_whitespace(pc.ascii_lower(no_nulls(texts)))
    flat, ends = without_empty(split)
    coded = flat.dictionary_encode()
    codes, unique = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False)
    hashes = _mix(pd.util.hash_array(unique, categorize=False))[codes] if len(codes) else np.zeros(0, np.uint64)

    whole = runs(hashes, size)  # of all texts in a row; those across two texts are left out below
    out, shorter = [], []
    for start, end in zip(ends.tolist(), ends[1:].tolist()):
        n = end - start
        out.append(whole[start : end - size + 1] if n >= size else runs(hashes[start:end], size if exact else n))
        shorter.append(n if n < size else 0)
    return out, shorter


def distinct(values: np.ndarray) -> np.ndarray:
    """The distinct values, sorted."""
    x = np.sort(values)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def shingle_sets(texts: list[str | None] | pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """Each text's distinct word shingles, sorted."""
    return [distinct(h) for h in shingle_rows(texts, size)[0]]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of each of ``HASHES`` hash functions over the set."""
    out = np.full(HASHES, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for k in range(0, len(shingles), 256):  # a block stays in the cache
        h = shingles[k : k + 256, None] * HASH_A
        h += HASH_B
        np.minimum(out, h.min(0), out=out)
    return (out >> np.uint64(32)).astype(np.uint32)


def set_keys(sets: list[np.ndarray]) -> list[bytes | None]:
    """Of each set 128 bits that two sets share only if they are equal (but for chance); None for an empty one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    filled = np.flatnonzero(sizes)
    out: list[bytes | None] = [None] * len(sets)
    if len(filled):
        flat = np.concatenate([sets[i] for i in filled])
        start = np.cumsum(sizes[filled]) - sizes[filled]
        both = np.stack([np.add.reduceat(_mix(flat), start), np.add.reduceat(_mix(flat ^ _P), start)], 1)
        for i, key in zip(filled.tolist(), both):
            out[i] = key.tobytes()
    return out


def needed_matches(threshold: float, miss: float = MISS) -> dict[int, int]:
    """After n compared values, the fewest matches with which a pair goes on.

    Uniform prior: with m of n matches, P(similarity >= t) = P(Binomial(n + 1, t) <= m).
    """
    need = {}
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, 0
        while m <= n:
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        need[n] = m
    return need


def features(docs: DataFrame) -> DataFrame:
    """Each row (struct ``row``) with its number ``rid``, set size, set key and signature; stored."""
    packed = docs.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("rid"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            flat = pa.RecordBatch.from_arrays([whole["row"].field("text"), *whole.columns], ["text", "row", "rid"])
            for batch in slices([flat], most=SLICE_BYTES):
                sets = shingle_sets(batch["text"])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["row"],
                        batch["rid"],
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(set_keys(sets), pa.binary()),
                        pa.array([signature(s).astype("<u4").tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    ["row", "rid", "n_shingles", "key", "sig"],
                )

    fields = [packed.schema["row"], T.StructField("rid", T.LongType()), T.StructField("n_shingles", T.LongType())]
    fields += [T.StructField("key", T.BinaryType()), T.StructField("sig", T.BinaryType())]
    return stored(packed.mapInArrow(lean(run), T.StructType(fields)), "neardup-features")


def prune(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """The pairs ``a, b`` that signature batches do not rule out."""
    need = needed_matches(threshold)
    sigs = classes.select("c", "sig")
    both = pairs.join(sigs.toDF("a", "sig_a"), "a").join(sigs.toDF("b", "sig_b"), "b").select("a", "b", "sig_a", "sig_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch[c].to_pylist()), "<u4").reshape(-1, HASHES) for c in ("sig_a", "sig_b"))
            alive, matches = np.arange(batch.num_rows), np.zeros(batch.num_rows, np.int64)
            for n, least in need.items():
                matches[alive] += (a[alive, n - BATCH : n] == b[alive, n - BATCH : n]).sum(1)
                alive = alive[matches[alive] >= least]
            yield batch.select(["a", "b"]).take(pa.array(alive))

    return both.mapInArrow(lean(run), "a bigint, b bigint")


def verify(pairs: DataFrame, texts: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """The pairs whose full shingle sets are similar enough; ``texts`` has ``c, text``."""
    both = pairs.join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b").select("a", "b", "text_a", "text_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for half in slices([whole], "text_a"):
                for batch in slices([half], "text_b"):
                    # a centre's text comes once per member
                    place = {t: i for i, t in enumerate(dict.fromkeys(batch["text_a"].to_pylist()))}
                    left = shingle_sets(list(place))
                    right = shingle_sets(batch["text_b"].to_pylist())
                    keep = []
                    for t, y in zip(batch["text_a"].to_pylist(), right):
                        x = left[place[t]]
                        shared = len(np.intersect1d(x, y, assume_unique=True))
                        keep.append(denominator * shared >= numerator * (len(x) + len(y) - shared))
                    yield batch.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(lean(run), "a bigint, b bigint")


def are_stars(edges: DataFrame) -> bool:
    """Whether each ``u`` has one ``v`` and no ``v`` is itself a ``u``."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1))).groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or (up = 1 and down = 1)").isEmpty()


def no_components(spark: SparkSession) -> DataFrame:
    """``c, comp`` without rows; rows that Python makes, even none, would start Python workers of another kind on each executor."""
    return spark.range(0).select(F.col("id").alias("c"), F.col("id").alias("comp"))


def components(links: DataFrame) -> DataFrame:
    """``c, comp`` of every class in a link: the smallest class it is connected with.

    Alternating large-star and small-star steps until only stars are left; each
    is two aggregations and joins on class numbers, so no task holds a component.
    """
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while not are_stars(edges):
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select("u", "v", "m")
        small = small.select("u", F.col("m").alias("v")).union(small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges, old = stored(small.distinct(), "edges"), edges
        drop_stored(old)
    roots = edges.select(F.col("v").alias("c"), F.col("v").alias("comp")).distinct()
    return edges.select(F.col("u").alias("c"), F.col("v").alias("comp")).union(roots)


def common_counts(texts: DataFrame) -> np.ndarray:
    """About how many of ``texts`` hold a shingle, by ``shingle % COUNTERS``; a fixed number of counters."""
    kind = "block int, counts binary"

    def rows(counts: dict[int, np.ndarray]) -> pa.RecordBatch:
        values = [x.astype("<i8").tobytes() for x in counts.values()]
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int32()), pa.array(values, pa.binary())], ["block", "counts"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches, most=SLICE_BYTES):
            sets = shingle_sets(batch["text"].to_pylist())
            total += np.bincount(np.concatenate(sets) % np.uint64(COUNTERS), minlength=COUNTERS)
        yield rows(dict(enumerate(total.reshape(BLOCKS, -1))))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, counts in zip(batch["block"].to_pylist(), batch["counts"].to_pylist()):
                total[block] = total.get(block, 0) + np.frombuffer(counts, "<i8")
        yield rows(total)

    found = texts.select("text").mapInArrow(lean(count), kind).repartition("block").mapInArrow(lean(add), kind).collect()  # BLOCKS rows
    out = np.zeros((BLOCKS, COUNTERS // BLOCKS), np.int64)
    for r in found:
        out[r.block] = np.frombuffer(r.counts, "<i8")
    return out.reshape(-1)


def prefix_pairs(texts: DataFrame, numerator: int, denominator: int) -> DataFrame:
    """All pairs ``a < b`` of ``texts`` (c, comp, text) of different components that may be similar enough.

    Of a set x, in the common order, the first |x| - ceil(t |x|) + 1 shingles probe
    and the first |x| - ceil(2 t / (1 + t) |x|) + 1 are found; a pair that reaches
    t has its first shared shingle among those that probe in the larger and
    those found in the smaller set, with enough shingles behind it in both.
    """
    shared = texts.sparkSession.sparkContext.broadcast(common_counts(texts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES):
            out: list[list[np.ndarray]] = [[], [], [], [], [], []]
            for c, comp, x in zip(batch["c"].to_pylist(), batch["comp"].to_pylist(), shingle_sets(batch["text"].to_pylist())):
                n = len(x)
                probe = n - -(-numerator * n // denominator) + 1
                index = n - -(-2 * numerator * n // (numerator + denominator)) + 1
                first = x[np.lexsort((x, shared.value[x % np.uint64(COUNTERS)]))[:probe]].view(np.int64)
                place = np.arange(len(first), dtype=np.int32)
                same = np.full(len(first), 1, np.int64)
                for column, values in zip(out, (first, c * same, comp * same, n * same, place, place < index)):
                    column.append(values)
            names = ["token", "c", "comp", "size", "place", "found"]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names)

    rows = texts.mapInArrow(lean(run), "token bigint, c bigint, comp bigint, size bigint, place int, found boolean")
    rows = stored(rows, "neardup-prefixes")
    shared.destroy()
    x, y = rows.alias("x"), rows.where("found").alias("y")
    behind = F.least(F.col("x.size") - F.col("x.place"), F.col("y.size") - F.col("y.place"))
    met = x.join(
        y,
        (F.col("x.token") == F.col("y.token"))
        & (F.col("x.comp") != F.col("y.comp"))
        & (F.col("y.size") <= F.col("x.size"))
        & (F.col("y.size") * denominator >= F.col("x.size") * numerator)
        & (behind * (numerator + denominator) >= (F.col("x.size") + F.col("y.size")) * numerator),
    )
    return met.select(F.least("x.c", "y.c").alias("a"), F.greatest("x.c", "y.c").alias("b")).distinct()


def bucket_members(classes: DataFrame) -> DataFrame:
    """``bucket, c, n, company``: the classes of every bucket with more than one, its size, the sizes of all the class's buckets; stored."""
    band = F.explode(F.sequence(F.lit(0), F.lit(BANDS - 1))).alias("band")
    keyed = classes.select("c", "sig", band).select(
        F.xxhash64("band", F.substring("sig", F.col("band") * (4 * ROWS) + 1, F.lit(4 * ROWS))).alias("bucket"), "c"
    )
    sizes = keyed.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    company = F.sum("n").over(Window.partitionBy("c"))  # at most BANDS rows
    return stored(keyed.join(sizes, "bucket").select("bucket", "c", "n", company.alias("company")), "neardup-members")


def centre_pairs(of: DataFrame, step: int) -> DataFrame:
    """Each member (bucket, c, company, comp) with its bucket's centre, if that is of another component.

    First the centre is the member with most company, at every later ``step`` one by a hash that differs between buckets."""
    rank = F.xxhash64("c", "bucket", F.lit(step)) if step else -F.col("company")
    order = F.struct(rank.alias("o"), "c", "comp")
    centres = of.groupBy("bucket").agg(F.min(order).alias("x")).select("bucket", F.col("x.c").alias("a"), F.col("x.comp").alias("comp_a"))
    near = of.join(centres, "bucket").where("comp != comp_a")
    return near.select(F.least("a", "c").alias("a"), F.greatest("a", "c").alias("b")).distinct()


def open_buckets(members: DataFrame, comps: DataFrame) -> DataFrame:
    """``bucket, c, company, comp`` of the buckets that still hold several components; stored."""
    of = members.where("n > 2").join(comps, "c", "left").select("bucket", "c", "company", F.coalesce("comp", "c").alias("comp"))
    split = of.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("bucket")
    return stored(of.join(split, "bucket"), "neardup-open")


def signature_classes(docs: DataFrame, rounds: int = 1, numerator: int = NUMERATOR, denominator: int = DENOMINATOR, apart: str = "") -> DataFrame:
    """``doc_id, class`` of the rows of ``docs`` that have words, by signatures alone.

    Each character of the class ``apart`` (as a regular expression has it) is a word of its own.

    Documents are one class when their signatures do not rule out that they are
    near-duplicates and the centre of one of their ``BANDS`` buckets joins them
    (``rounds`` centres of each). No texts are compared, so
    a class may hold documents a little less alike than near-duplicates; what
    counts independent documents errs on the side of fewer."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, most=SLICE_BYTES):
            texts = batch["text"]
            sets = shingle_sets(spread(texts, apart) if apart else texts)
            keep = [i for i, x in enumerate(sets) if len(x)]
            columns = [set_keys([sets[i] for i in keep]), [signature(sets[i]).astype("<u4").tobytes() for i in keep]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(keep, pa.int64())), *[pa.array(c, pa.binary()) for c in columns]], ["doc_id", "key", "sig"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    found = stored(docs.select("doc_id", "text").mapInArrow(lean(run), f"doc_id {kind}, key binary, sig binary"), "signatures")
    classes = stored(found.groupBy("key").agg(F.any_value("sig").alias("sig")).withColumn("c", F.monotonically_increasing_id()), "signature-classes")
    members = bucket_members(classes)
    links, of = None, members.select("bucket", "c", "company", F.col("c").alias("comp"))
    comps = no_components(docs.sparkSession)
    for step in range(rounds):
        if step:
            of = open_buckets(members, comps)
        new = stored(prune(centre_pairs(of, step), classes, numerator / denominator), "signature-links")
        if new.isEmpty():
            break
        links = new if links is None else links.union(new)
        comps = components(links)
    drop_stored(members)
    return found.select("doc_id", "key").join(classes.select("key", "c"), "key").join(comps, "c", "left").select("doc_id", F.coalesce("comp", "c").alias("class"))


def near_duplicates(docs: DataFrame, numerator: int = NUMERATOR, denominator: int = DENOMINATOR) -> DataFrame:
    """Rows of ``docs`` (struct ``row``) with ``rid, n_shingles, component_id, keeper``.

    ``component_id`` is the smallest ``doc_id`` of the row's component (NULL ids
    only where it has no other), ``keeper`` the one row that stands for it: the
    first by ``doc_id`` (NULL last), then by scan order, also among repeated
    rows. Rows without words (NULL, empty, white space) are components of their
    own and kept. An empty table gives no rows.
    """
    found = features(docs)
    some = found.where(F.col("key").isNotNull())
    first = F.struct(F.col("row.doc_id").isNull().alias("no_id"), F.col("row.doc_id").alias("doc_id"), F.col("rid").alias("rid"))
    grouped = some.groupBy("key").agg(F.min(first).alias("first"), F.any_value("sig").alias("sig"))
    classes = stored(grouped.withColumn("c", F.monotonically_increasing_id()), "neardup-classes")
    threshold = numerator / denominator

    members = bucket_members(classes)

    wanted = classes.join(members.select("c").distinct(), "c").select("c", F.col("first.rid").alias("rid"))
    texts = stored(found.select("rid", F.col("row.text").alias("text")).join(wanted, "rid").select("c", "text"), "neardup-texts")

    tested = None
    comps = no_components(docs.sparkSession)
    of = members.select("bucket", "c", "company", F.col("c").alias("comp"))
    for step in range(CENTRES + 1):
        if step:
            of = open_buckets(members, comps)
        if step < CENTRES:
            pairs = centre_pairs(of, step)
        else:
            left = of.select("c", "comp").distinct()
            pairs = prefix_pairs(stored(texts.join(left, "c").select("c", "comp", "text"), "neardup-left"), numerator, denominator)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "neardup-pairs")
        if pairs.isEmpty():
            continue
        alive = stored(prune(pairs, classes, threshold), "neardup-alive")
        new = stored(verify(alive, texts, numerator, denominator), "neardup-links")
        drop_stored(alive)
        tested = pairs if tested is None else tested.union(pairs)
        # what earlier rounds joined stays joined: a star for each of their components
        comps, old = components(comps.where("c != comp").toDF("a", "b").union(new)), comps
        drop_stored(old)
        drop_stored(new)
    drop_stored(members)
    drop_stored(texts)
    placed = classes.select("c", "key", "first").join(comps, "c", "left").withColumn("comp", F.coalesce("comp", "c"))
    heads = placed.groupBy("comp").agg(F.min("first").alias("head"))
    placed = placed.join(heads, "comp").select("key", F.col("head.doc_id").alias("component_id"), F.col("head.rid").alias("head"))
    base = ("row", "rid", "n_shingles")
    joined = some.select(*base, "key").join(placed, "key").select(*base, "component_id", (F.col("rid") == F.col("head")).alias("keeper"))
    alone = found.where(F.col("key").isNull()).select(*base, F.col("row.doc_id").alias("component_id"), F.lit(True).alias("keeper"))
    return joined.union(alone)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))
    doc_id = F.col("row.doc_id")
    return found.select(doc_id.alias("doc_id"), "n_shingles", "component_id", doc_id.eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component; columns as they were."""
    return near_duplicates(docs).where("keeper").select("row.*")

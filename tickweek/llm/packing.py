"""Best-fit packing by a configuration linear program over the length histogram.

A configuration is a multiset of piece lengths that fits into one sequence. The
program "fewest configurations that cover the histogram" is solved by
multiplicative weights: every length has a weight, a bounded knapsack dynamic
program finds the configuration of the largest weight, a fractional number of
copies of it is taken, and the weights of the lengths it covers shrink. The
fractions are rounded down and what is left is packed by best fit, decreasing,
in whole patterns at once. All of this sees only the histogram (at most
``capacity`` numbers), so its cost does not depend on the number of documents.

Every configuration owns a range of places for each of its lengths. A piece
finds its place by its rank among the pieces of its length, which needs only
per-partition counts: no piece is moved or sorted for it.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickweek.llm.common import documents, lean, slices
from tickweek.llm.tokens import SEPARATOR, Encoder
from tickweek.session import stored

CAPACITY = 2048
ROUNDS = 600  # multiplicative-weight steps
STEP = 0.5  # share of the scarcest length's open demand that one step covers
RATE = 0.5  # a length's weight falls to exp(-RATE) as it becomes covered
PRICE = 1.25  # a length starts with the weight (length / capacity) ** PRICE: longer pieces first

Pattern = tuple[int, tuple[tuple[int, int], ...]]  # copies, ((length, times), ...)


def best_configuration(lengths: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of the largest value that fits: index -> times, at most ``most`` of each.

    Knapsack dynamic program; ``most`` copies of an item are offered as 1, 2, 4, ... of them.
    """
    best = np.zeros(capacity + 1)
    offers: list[tuple[int, int, np.ndarray]] = []
    for i, (length, value) in enumerate(zip(lengths.tolist(), values.tolist())):
        left, k = min(int(most[i]), capacity // length), 1
        while left > 0:
            k = min(k, left)
            size = k * length
            with_it = best[: capacity + 1 - size] + k * value
            better = with_it > best[size:]
            offers.append((i, k, better))
            np.maximum(best[size:], with_it, out=best[size:])
            left, k = left - k, 2 * k
    room, chosen = capacity, {}
    for i, k, better in reversed(offers):
        size = k * int(lengths[i])
        if size <= room and better[room - size]:
            chosen[i] = chosen.get(i, 0) + k
            room -= size
    return chosen


def solve(histogram: dict[int, int], capacity: int = CAPACITY, rounds: int = ROUNDS) -> list[Pattern]:
    """Patterns that hold exactly the pieces of ``histogram`` (length -> number)."""
    out: list[Pattern] = []
    lengths = np.array(sorted(n for n in histogram if n < capacity), np.int64)
    if capacity in histogram:
        out.append((histogram[capacity], ((capacity, 1),)))
    if not len(lengths):
        return out
    demand = np.array([histogram[n] for n in lengths.tolist()], np.float64)
    open_ = demand.copy()
    weight = (lengths / capacity) ** PRICE
    taken: dict[tuple[tuple[int, int], ...], float] = {}
    for _ in range(rounds):
        chosen = best_configuration(lengths, weight, np.floor(open_ + 1e-9).astype(np.int64), capacity)
        if not chosen:
            break
        at, times = np.array(list(chosen)), np.array(list(chosen.values()), np.float64)
        copies = (open_[at] / times).min()
        copies = max(min(copies, 1.0), STEP * copies)
        open_[at] = np.maximum(open_[at] - copies * times, 0)
        weight[at] *= np.exp(-RATE * copies * times / demand[at])
        key = tuple(sorted(zip(lengths[at].tolist(), times.astype(int).tolist()), reverse=True))
        taken[key] = taken.get(key, 0.0) + copies
    left = dict(zip(lengths.tolist(), demand.astype(np.int64).tolist()))
    for key, copies in sorted(taken.items(), key=lambda x: (-x[1], x[0])):
        whole = min(int(copies + 1e-6), *(left[n] // k for n, k in key))
        if whole:
            out.append((whole, key))
            for n, k in key:
                left[n] -= whole * k
    out += best_fit_decreasing({n: k for n, k in left.items() if k}, capacity)
    return out


def best_fit_decreasing(left: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns for what rounding left: the longest piece, then each time the longest that fits."""
    out: list[Pattern] = []
    lengths = sorted(left)
    while lengths:
        room, pattern = capacity, {}
        end = len(lengths)
        while end:
            end = bisect_right(lengths, room, 0, end)
            if not end:
                break
            n = lengths[end - 1]
            k = min(room // n, left[n])
            pattern[n] = k
            room -= k * n
            end -= 1
        whole = min(left[n] // k for n, k in pattern.items())
        out.append((whole, tuple(pattern.items())))
        for n, k in pattern.items():
            left[n] -= whole * k
        lengths = [n for n in lengths if left[n]]
    return out


class Places:
    """For each length the ranges of ranks that the patterns give to it."""

    def __init__(self, patterns: list[Pattern]) -> None:
        rows: dict[int, list[tuple[int, int, int, int]]] = {}
        used: dict[int, int] = {}
        sequence = 0
        for copies, pattern in patterns:
            offset = 0
            for n, k in pattern:
                rank = used.get(n, 0)
                rows.setdefault(n, []).append((rank, k, sequence, offset))
                used[n] = rank + copies * k
                offset += k * n
            sequence += copies
        self.sequences = sequence
        self.rows = {n: np.array(x, np.int64) for n, x in rows.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces that have these ranks among their length's."""
        sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
        for n in np.unique(length).tolist():
            here = np.flatnonzero(length == n)
            table = self.rows[n]
            row = table[np.searchsorted(table[:, 0], rank[here], "right") - 1]
            place = rank[here] - row[:, 0]
            sequence[here] = row[:, 2] + place // row[:, 1]
            offset[here] = row[:, 3] + place % row[:, 1] * n
        return sequence, offset


_PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, rank bigint"


def pieces(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of every document's ids, each with its rank among its task's pieces of that length.

    A document's ids end with the separator 0; NULL and empty texts have just
    that one. Only documents of more than ``capacity`` ids are cut: full pieces
    at the end, the rest before them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder()
        part = TaskContext.get().partitionId()
        seen = [0] * (capacity + 1)
        end = np.array([SEPARATOR], np.uint32)
        for batch in slices(batches):
            rows: list[tuple] = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                ids = np.concatenate([encoder.ids(text), end]).astype("<u4", copy=False)
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)] if len(ids) > capacity else [0, len(ids)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), part, seen[b - a]))
                    seen[b - a] += 1
            columns = zip(*rows)
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "rank"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(lean(run), _PIECES)


def pack(docs: DataFrame, capacity: int = CAPACITY, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece.

    Every row of ``docs`` is packed, also NULL ids, NULL texts and repeated
    rows, each as a document of its own; an empty table gives no rows. Only
    ``doc_id`` and ``text`` are read.
    """
    spark = docs.sparkSession
    cut = stored(pieces(docs, capacity), "pieces")
    counts = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= capacity rows
    places = spark.sparkContext.broadcast(Places(solve(histogram, capacity, rounds)))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank0"))
    ranked = cut.join(offsets, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank0") + F.col("rank")).alias("rank")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                length = batch.column("length").to_numpy(zero_copy_only=False)
                sequence, offset = places.value.find(length, batch.column("rank").to_numpy(zero_copy_only=False))
                kept = [batch.column(i) for i in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [*kept, pa.array(sequence), pa.array(offset)],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
                )

    return ranked.mapInArrow(
        lean(run), "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    )


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))

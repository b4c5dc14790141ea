"""Periodic runs of words by internal pattern matching.

A batch of documents is one sequence of word numbers with a mark of its own
after each document. Prefix doubling names the blocks of every dyadic length
``L`` and orders the suffixes; a block's name is an interval of the suffix
array. For each aligned block (starts ``L / 2`` apart) a wavelet tree over the
suffix array answers the range successor: where does this block occur next? An
occurrence at a distance ``d`` of at most ``L`` starts an arithmetic
progression, and ``d`` is a candidate period. Its stretch is then extended word by
word to the maximal run.

No run is missed: a run of period ``q`` and length ``4 q`` or more holds an
aligned block of the length ``L`` with ``q <= L < 2 q``, and the next ``L + q``
words belong to it too, so the block occurs again at distance ``q`` and, as ``q``
is the smallest period, no earlier.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweek.llm.common import documents, ranges, slices

POWER = 4  # a run has at least so many periods (the block lengths above rely on four or more)
LEAST = 6  # and at least so many words
# Texts that are searched together; a single longer text is searched alone.
SEARCH_BYTES = 2 << 20

Rewrite = Callable[[object, list[bytes]], list[bytes]]


class WaveletTree:
    """A sequence of numbers below ``2 ** bits``, level by level, one packed bit each (a wavelet matrix)."""

    def __init__(self, values: np.ndarray) -> None:
        self.bits = max(1, int(values.max()).bit_length()) if len(values) else 1
        self.levels: list[tuple[np.ndarray, np.ndarray, int]] = []
        for shift in range(self.bits - 1, -1, -1):
            bit = ((values >> shift) & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, bool)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words))[:-1]]).astype(np.int64)
            self.levels.append((words, before, int(len(bit) - bit.sum())))
            values = np.concatenate([values[~bit], values[bit]])

    @staticmethod
    def _ones(words: np.ndarray, before: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return before[word] + np.bitwise_count(words[word] & mask)

    def below(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """How many values of places ``low .. high - 1`` lie below ``bound`` (itself below ``2 ** bits``)."""
        found = np.zeros(len(low), np.int64)
        for shift, (words, before, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            ones_low, ones_high = self._ones(words, before, low), self._ones(words, before, high)
            up = (bound >> shift) & 1 == 1
            found += np.where(up, (high - ones_high) - (low - ones_low), 0)
            low = np.where(up, zeros + ones_low, low - ones_low)
            high = np.where(up, zeros + ones_high, high - ones_high)
        return found

    def smallest(self, low: np.ndarray, high: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The value of this rank (from 0) among places ``low .. high - 1``."""
        value = np.zeros(len(low), np.int64)
        for shift, (words, before, zeros) in zip(range(self.bits - 1, -1, -1), self.levels):
            ones_low, ones_high = self._ones(words, before, low), self._ones(words, before, high)
            n = (high - ones_high) - (low - ones_low)
            up = rank >= n
            rank = np.where(up, rank - n, rank)
            value |= np.where(up, 1 << shift, 0)
            low = np.where(up, zeros + ones_low, low - ones_low)
            high = np.where(up, zeros + ones_high, high - ones_high)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, above: np.ndarray) -> np.ndarray:
        """The smallest value greater than ``above`` in each range, -1 where there is none."""
        rank = self.below(low, high, np.minimum(above + 1, (1 << self.bits) - 1))
        there = (rank < high - low) & (above + 1 < 1 << self.bits)
        out = np.full(len(low), -1, np.int64)
        out[there] = self.smallest(low[there], high[there], rank[there])
        return out


def next_equal(codes: np.ndarray) -> np.ndarray:
    """Distance from each place to the next one of the same code (the length where there is none)."""
    order = np.argsort(codes, kind="stable")
    out = np.full(len(codes), len(codes), np.int64)
    same = codes[order[1:]] == codes[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def blocks(codes: np.ndarray, longest: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]]:
    """Suffixes in order, and per dyadic length: ``(length, starts, low, high)`` of the aligned blocks that can recur.

    ``low .. high - 1`` are the places of the block's occurrences in the order. Only
    blocks that occur at least twice, and whose first word comes again within
    their length, are listed. The order goes as deep as runs in texts of
    ``longest`` words need.
    """
    n = len(codes)
    order = np.argsort(codes, kind="stable")
    head = np.concatenate([[True], codes[order[1:]] != codes[order[:-1]]])
    again = next_equal(codes)
    rank = np.empty(n, np.int64)
    out = []
    length = 1
    while True:
        heads = np.flatnonzero(head)
        size = np.zeros(n, np.int64)
        size[heads] = np.diff(np.append(heads, n))
        rank[order] = np.repeat(heads, size[heads])
        starts = np.arange(0, n, max(1, length // 2))
        starts = starts[(again[starts] <= length) & (size[rank[starts]] > 1)]
        if len(starts):
            out.append((length, starts, rank[starts], rank[starts] + size[rank[starts]]))
        places = np.flatnonzero(np.repeat(size[heads] > 1, size[heads]))
        if 4 * length > longest or not len(places):
            return order, out
        # Longer prefixes reorder a group only within its own places.
        suffix = order[places]
        tail = suffix + length
        key = rank[suffix] * (n + 1) + np.where(tail < n, rank[np.minimum(tail, n - 1)] + 1, 0)
        by = np.argsort(key, kind="stable")
        order[places], key = suffix[by], key[by]
        head[places] = np.concatenate([[True], key[1:] != key[:-1]])
        length *= 2


def extension(codes: np.ndarray, left: np.ndarray, right: np.ndarray, step: int) -> np.ndarray:
    """For each pair of places the number of equal words on from them, in direction ``step``.

    The sequence begins and ends with codes of their own, so no pair goes past an end."""
    out = np.zeros(len(left), np.int64)
    active, width = np.arange(len(left)), 4
    while len(active):
        at = ranges(np.zeros(len(active), np.int64), np.full(len(active), width))
        a = np.clip(np.repeat(left[active] + step * out[active], width) + step * at, 0, len(codes) - 1)
        b = np.clip(np.repeat(right[active] + step * out[active], width) + step * at, 0, len(codes) - 1)
        differ = (codes[a] != codes[b]).reshape(len(active), width)
        first = np.where(differ.any(1), differ.argmax(1), width)
        out[active] += first
        active = active[first == width]
        width = min(2 * width, max(4, 4_000_000 // max(1, len(active))))
    return out


def runs_of(codes: np.ndarray, longest: int, power: int = POWER, least: int = LEAST) -> np.ndarray:
    """All runs ``(start, length, period)`` of a sequence that begins and ends with codes of their own, by start, then period."""
    none = np.zeros((0, 3), np.int64)
    order, listed = blocks(codes, longest)
    if not listed:
        return none
    tree = WaveletTree(order)
    found = []
    for length, starts, low, high in listed:
        apart = tree.successor(low, high, starts) - starts
        hit = (apart > 0) & (apart <= length)
        found.append(np.stack([apart[hit], starts[hit], starts[hit] + length], 1))
    candidates = np.concatenate(found)
    if not len(candidates):
        return none
    # Stretches of one period that share that many words are parts of one run.
    candidates = candidates[np.lexsort((candidates[:, 1], candidates[:, 0]))]
    period, start, reach = candidates.T
    group = np.cumsum(np.concatenate([[0], period[1:] != period[:-1]])) * (2 * len(codes))
    far = np.maximum.accumulate(reach + group)
    new = np.concatenate([[True], start[1:] + group[1:] > far[:-1]])
    at = np.flatnonzero(new)
    period, start, group = period[at], start[at], group[at]
    reach = far[np.append(at[1:], len(new)) - 1] - group
    start = start - extension(codes, start - 1, start - 1 + period, -1)
    end = reach + period + extension(codes, reach, reach + period, 1)
    kept = end - start >= np.maximum(least, power * period)
    return np.unique(np.stack([start, end - start, period], 1)[kept], axis=0)[:, [0, 1, 2]] if kept.any() else none


def search(texts: list[list[bytes]], power: int = POWER, least: int = LEAST) -> tuple[np.ndarray, np.ndarray]:
    """Runs of several word lists, ``(start, length, period)`` by start and period, and the number of runs of each list."""
    sizes = np.array([len(t) for t in texts], np.int64)
    words = np.empty(int(sizes.sum()), object)
    at = 0
    for t in texts:
        words[at : at + len(t)] = t
        at += len(t)
    numbers, known = pd.factorize(words)
    # word codes, and before the first text and after each one a code of its own
    first = np.cumsum(sizes + 1) - sizes
    codes = np.arange(len(known), len(known) + len(words) + len(texts) + 1, dtype=np.int64)
    codes[ranges(first, sizes)] = numbers
    runs = runs_of(codes, int(sizes.max(initial=0)), power, least)
    owner = np.searchsorted(first, runs[:, 0], "right") - 1
    by = np.lexsort((runs[:, 2], runs[:, 0]))
    runs, owner = runs[by], owner[by]
    runs[:, 0] -= first[owner]
    return runs, np.bincount(owner, minlength=len(texts))


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words left once every run keeps its first period only, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    step = np.zeros(len(words) + 1, np.int64)
    np.add.at(step, runs[:, 0] + runs[:, 2], 1)
    np.add.at(step, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(step)[:-1] == 0
    return b" ".join(w for w, k in zip(words, keep.tolist()) if k)


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(
    docs: DataFrame, rewrite: Rewrite | None = None, key: str = "doc_id", power: int = POWER, least: int = LEAST
) -> DataFrame:
    """The rows of ``docs`` in the struct ``row``, their ``runs`` and the ``collapsed`` text.

    Words are what ASCII white space leaves of the whole ``text``, numbered from
    0. ``runs`` is an array of ``(start, length, period)`` by start, then period:
    maximal stretches of smallest period ``period``, at least ``least`` words and
    ``power`` periods long. ``collapsed`` joins the words that no run drops.
    ``rewrite`` may replace a row's words first, given the value of ``key``.
    A NULL, empty or blank text has no runs and the empty text; equal texts and
    repeated rows are each searched alike; an empty table gives no rows; other
    columns, whatever their names, stay inside ``row``. A text is searched in
    one task, with about 200 bytes of memory a word.
    """
    if power < POWER:
        raise ValueError(f"runs of fewer than {POWER} periods are not all found")
    packed = docs.select(F.struct("*").alias("row"))
    runs_type = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
    schema = T.StructType([packed.schema["row"], T.StructField("runs", runs_type), T.StructField("collapsed", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            flat = pa.RecordBatch.from_arrays([whole["row"].field("text"), whole["row"]], ["text", "row"])
            for batch in slices([flat], most=SEARCH_BYTES):
                texts = [t.split() if t else [] for t in batch["text"].cast(pa.binary()).to_pylist()]
                if rewrite is not None:
                    texts = [rewrite(k, t) for k, t in zip(batch["row"].field(key).to_pylist(), texts)]
                runs, counts = search(texts, power, least)
                ends = np.concatenate([[0], np.cumsum(counts)])
                short = [collapsed(t, runs[a:b]) for t, a, b in zip(texts, ends[:-1].tolist(), ends[1:].tolist())]
                parts = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(c)) for c in runs.T], fields=list(_RUNS.value_type))
                column = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), parts)
                yield pa.RecordBatch.from_arrays([batch["row"], column, pa.array(short, pa.binary()).cast(pa.string())], schema.names)

    return packed.mapInArrow(run, schema)


def repeated_tail(doc_id: object, words: list[bytes]) -> list[bytes]:
    """Every tenth document (by crc32 of its id) made periodic from some word on; a NULL id counts as the empty text."""
    h = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def op12_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(documents(spark, sf_dir).select("doc_id", "text"), repeated_tail)
    # greatest length first, then smallest start, then smallest period
    best = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    line = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.select(F.col("row.doc_id").alias("doc_id"), "runs", "collapsed", best.alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.less")).alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(-best.less * 1000) div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )

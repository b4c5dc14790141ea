"""Helpers shared by the corpus operators: table access, batches and exact text rules."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BATCH_BYTES = 4 << 20
SLICE_BYTES = 1 << 20  # where the work on a text takes many times its size

Task = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def bounded_batches(spark: SparkSession) -> None:
    """From now on Spark sends Python about ``BATCH_BYTES`` at once instead of up to 10,000 rows, however long, unless the submitter set a bound.

    Both sides hold several copies of a batch beside the executor's heap."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo ``folds``; NULL ids count as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` bytes of ``column`` (one row at least)."""
    for batch in batches:
        sizes = np.asarray(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False))
        ends, start, total = [], 0, 0
        for i, n in enumerate(sizes.tolist()):
            if i > start and total + n > most:
                ends.append(i)
                start, total = i, 0
            total += n
        start = 0
        for end in [*ends, batch.num_rows]:
            if end > start:
                yield batch.slice(start, end - start)
            start = end


def give_back() -> None:
    """Memory that this process no longer uses goes back to the system (where its C library can do that)."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def lean(run: Task) -> Task:
    """``run`` for ``mapInArrow``, giving back what Arrow holds unused after each batch and everything unused at the end.

    Spark's Python workers live on between tasks; what they keep lies idle beside the executor's heap."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def fed() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch
                del batch
                pa.default_memory_pool().release_unused()

        yield from run(fed())
        give_back()

    return task


def no_nulls(texts: list[str | None] | pa.Array) -> pa.Array:
    """The texts as one Arrow array, NULL as empty."""
    if isinstance(texts, pa.Array):
        whole = pa.concat_arrays([texts, texts[:0]])  # kernels go wrong on a slice that was cast
        return pc.fill_null(whole, "").cast(pa.large_string())
    return pa.array([t or "" for t in texts], pa.large_string())


def replaced(texts: pa.Array, pattern: str, by: str) -> pa.Array:
    """``pc.replace_substring_regex``; only texts with a match are rewritten, which costs far more than the search."""
    met = pc.match_substring_regex(texts, pattern)
    if not pc.any(met).as_py():
        return texts
    return pc.replace_with_mask(texts, met, pc.replace_substring_regex(texts.filter(met), pattern, by))


def spread(texts: list[str | None] | pa.Array, characters: str) -> pa.Array:
    """The texts with a blank on both sides of each of ``characters`` (a class beyond ASCII)."""
    wide = pc.invert(pc.string_is_ascii(texts := no_nulls(texts)))
    if not pc.any(wide).as_py():
        return texts
    return pc.replace_with_mask(texts, wide, replaced(texts.filter(wide), f"([{characters}])", r" \1 "))


def without_empty(split: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The values of all lists in a row but the empty ones (white space at an end leaves one), and where each list starts and the last ends."""
    flat, offsets = split.flatten(), np.asarray(split.offsets)
    real = pc.greater(pc.binary_length(flat), 0)
    filled = real.to_numpy(zero_copy_only=False)
    if filled.all():
        return flat, offsets - offsets[0]
    return flat.filter(real), np.concatenate([[0], np.cumsum(filled)])[offsets - offsets[0]]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices of all ranges ``start .. start + length - 1``, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
